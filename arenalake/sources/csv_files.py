"""CSV scans: manifests (typed by column name) and mart exports (text)."""

from __future__ import annotations

from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from arenalake.sources.csv_records import read_split_csv
from arenalake.sources.schemas import MANIFEST, MANIFEST_COLUMNS


def _whole_number(text: Column) -> Column:
    """The number in the text; other text fails the query, blank is null."""
    number = text.try_cast("bigint")
    wrong = F.raise_error(F.concat(F.lit("not a whole number: "), text)).cast("bigint")
    return F.when(text.isNotNull() & number.isNull(), wrong).otherwise(number)


def _manifest_columns(rows: DataFrame) -> list[Column]:
    """The manifest columns by header name, in any order; a missing column is null."""
    columns = []
    for name in MANIFEST_COLUMNS:
        text = F.col(name) if name in rows.columns else F.lit(None).cast("string")
        number = name in ("match_id", "start_time")
        columns.append((_whole_number(text) if number else text).alias(name))
    return columns


def _text(spark: SparkSession, path: str | list[str]) -> list[DataFrame]:
    """All columns as text, named by the header of their own file: one frame for each header.

    The header of a file is its line with the column ``match_id``; one line a file comes to the
    driver, for the files' names.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    cells = F.split(F.regexp_replace("value", '[" \\uFEFF]', ""), ",")
    headers = lines.where(F.array_contains(cells, "match_id")).groupBy("file").agg(F.min("value").alias("header"))
    by_header: dict[str, list[str]] = {}
    for row in headers.orderBy("file").collect():
        by_header.setdefault(row["header"], []).append(unquote(row["file"]))
    if len(by_header) < 2:
        return [spark.read.option("header", True).option("escape", '"').csv(path)]
    return [spark.read.option("header", True).option("escape", '"').csv(files) for files in by_header.values()]


def read_manifest(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Manifest rows, columns by name in each file; a missing file is an empty manifest."""
    try:
        parts = _text(spark, path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST)
    return reduce(DataFrame.unionByName, [rows.select(*_manifest_columns(rows)) for rows in parts])


def split_paths(paths: str) -> list[str]:
    """``"a.csv, b.csv"`` as a list; blank parts are ignored."""
    return [part.strip() for part in paths.split(",") if part.strip()]


def read_manifests(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Several manifests in the given order, each row with its place ``seen_at``.

    ``seen_at`` orders rows by path, file, split and line. It only breaks ties, so nothing is
    sorted here.
    """
    listed = split_paths(paths) if isinstance(paths, str) else paths
    parts = []
    for order, path in enumerate(listed):
        place = F.struct(
            F.lit(order).alias("path_no"),
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("split"),
            F.monotonically_increasing_id().alias("line"),
        )
        parts += [rows.select(*_manifest_columns(rows), place.alias("seen_at")) for rows in _text(spark, path)]
    return reduce(DataFrame.unionByName, parts)


def read_export(spark: SparkSession, path: str) -> DataFrame:
    """A mart export as text columns, named by its header; text may have line breaks."""
    return read_split_csv(spark, path)
