"""State of a stream in parts, one a batch, merged by levels.

Batch n writes a part. When ``fan_in`` parts of a level are complete, they are merged into one part of the next, so
each row is written again once a level, and at most ``fan_in - 1`` parts of each level count. Which parts
count after a batch follows from its number: a replayed batch overwrites its part and its merges with the same
rows. A merge that is not there, because its batch had nothing to write, is read as the parts below it. Merged parts go
away with the next batch, when their merge is sure to be committed.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_if_there(spark: SparkSession, path: str, schema: str | StructType, kind: str = "parquet") -> DataFrame:
    """The rows under a path; none if it is not there yet."""
    try:
        return spark.read.schema(schema).format(kind).load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


@dataclass(frozen=True)
class Levels:
    """``merge`` makes the rows of several parts into those of one, of the same schema.

    Batches that write nothing have no part and change nothing.
    """

    spark: SparkSession
    root: str
    merge: Callable[[DataFrame], DataFrame]
    fan_in: int = 8

    def __post_init__(self) -> None:
        if self.fan_in < 2:
            raise ValueError("at least two parts are merged into one")

    def _path(self, level: int, number: int) -> str:
        return f"{self.root}/batch={number}" if level == 0 else f"{self.root}/level={level}/part={number}"

    def parts(self, batch: int) -> list[tuple[int, int]]:
        """Level and number of the parts that count after a batch, the digits of the number of batches."""
        found, level, left = [], 0, batch + 1
        while left:
            whole = left // self.fan_in
            found += [(level, n) for n in range(whole * self.fan_in, left)]
            level, left = level + 1, whole
        return found

    def _folder(self, level: int, number: int):
        """The folder of a part, and its file system."""
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self._path(level, number))
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _is_there(self, level: int, number: int) -> bool:
        path, files = self._folder(level, number)
        return files.exists(path)

    def _present(self, parts: list[tuple[int, int]]) -> list[str]:
        """Folders of the parts, or of the parts below those that were not merged."""
        found = []
        for part in parts:
            if self._is_there(*part):
                found.append(self._path(*part))
            elif part[0]:
                found += self._present(self._below(*part))
        return found

    def _read(self, parts: list[tuple[int, int]], schema: StructType) -> DataFrame:
        paths = self._present(parts)
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _merges(self, batch: int) -> list[tuple[int, int]]:
        """The parts that a batch completes, lower levels first."""
        done, found, level = batch + 1, [], 1
        while done % self.fan_in == 0:
            done //= self.fan_in
            found.append((level, done - 1))
            level += 1
        return found

    def _below(self, level: int, number: int) -> list[tuple[int, int]]:
        return [(level - 1, n) for n in range(number * self.fan_in, (number + 1) * self.fan_in)]

    def add(self, rows: DataFrame, batch: int) -> DataFrame:
        """Add the part of a batch, and return the rows of all parts that count."""
        schema = rows.schema
        rows.write.mode("overwrite").parquet(self._path(0, batch))
        for part in self._merges(batch):
            merged = self.merge(self._read(self._below(*part), schema))
            merged.write.mode("overwrite").parquet(self._path(*part))
        for part in self._merges(batch - 1) if batch else []:
            if self._is_there(*part):
                for below in self._below(*part):
                    path, files = self._folder(*below)
                    files.delete(path, True)
        return self._read(self.parts(batch), schema)
