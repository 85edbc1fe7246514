"""Raw tables and files that the queries read, written once per application and input.

The loader stores raw rows once and the models read them many times; so do the queries. The
fingerprint covers name, size and modification time of the input files, so changed input lands
again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from arenalake.storage import fresh_path

_landed: dict[tuple[str, str, str, str], str] = {}


def _fingerprint(spark: SparkSession, sf_dir: str, tables: tuple[str, ...]) -> str:
    """Only file metadata is looked at, through the file system that Spark reads from."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    marks = []
    for table in tables:
        path = hadoop.Path(f"{sf_dir}/{table}.parquet")
        files = path.getFileSystem(conf).listFiles(path, True)
        while files.hasNext():
            file = files.next()
            marks.append(f"{file.getPath()} {file.getLen()} {file.getModificationTime()}")
    return hashlib.sha256("\n".join(sorted(marks)).encode()).hexdigest()


def landed(
    spark: SparkSession,
    sf_dir: str,
    name: str,
    tables: tuple[str, ...],
    write: Callable[[str], None],
) -> str:
    """Path of the landed data ``name``; ``write`` is called with a new path when there is none."""
    mark = _fingerprint(spark, sf_dir, tables)
    key = (spark.sparkContext.applicationId, sf_dir, name, mark)
    path = _landed.get(key)
    if path is not None and _exists(spark, path):
        return path
    path = fresh_path(spark, name)
    write(path)
    _landed[key] = path
    return path


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.text(path).limit(0)
    except AnalysisException:
        return False
    return True


def landed_table(
    spark: SparkSession,
    sf_dir: str,
    name: str,
    tables: tuple[str, ...],
    build: Callable[[SparkSession, str], DataFrame],
    schema: str | None = None,
) -> DataFrame:
    def write(path: str) -> None:
        build(spark, sf_dir).write.parquet(path)

    path = landed(spark, sf_dir, name, tables, write)
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def landed_lines(
    spark: SparkSession,
    sf_dir: str,
    name: str,
    tables: tuple[str, ...],
    build: Callable[[SparkSession, str], DataFrame],
    lines_per_file: int = 0,
) -> str:
    """Path of text files. With ``lines_per_file`` they are compressed, so a reader's task takes whole files."""

    def write(path: str) -> None:
        writer = build(spark, sf_dir).write
        if lines_per_file:
            writer = writer.option("maxRecordsPerFile", lines_per_file).option("compression", "gzip")
        writer.text(path)

    return landed(spark, sf_dir, name, tables, write)
