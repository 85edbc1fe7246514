"""Text that Spark splits anywhere, with the place of each piece and sums over all pieces before it.

A split is a part of a file that one task reads. Sums within a split need its pieces only; sums over the
splits of a file need one row a split. So the state in which a piece begins is known without reading a file in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec, functions as F

SPLIT = ("file", "block")


def placed_text(spark: SparkSession, path: str | list[str], line_sep: str) -> DataFrame:
    """``file, block, line, value``: the text between separators, ordered by ``line`` within a split."""
    return spark.read.option("lineSep", line_sep).text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
        "value",
    )


def in_split() -> WindowSpec:
    return Window.partitionBy(*SPLIT).orderBy("line")


def in_file() -> WindowSpec:
    """Over rows of which there is one a split."""
    return Window.partitionBy("file").orderBy("block")


def sum_before(column: Column, window: WindowSpec) -> Column:
    """The sum over all earlier rows."""
    return F.coalesce(F.sum(column).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def last_before(column: Column, window: WindowSpec) -> Column:
    """The last value of the earlier rows that have one."""
    return F.last(column, ignorenulls=True).over(window.rowsBetween(Window.unboundedPreceding, -1))


def joined_text(parts: DataFrame, element: str, separator: str) -> DataFrame:
    """The texts of the pieces of each element, put together; an element is as long as a record."""
    pieces = F.array_sort(F.collect_list(F.struct("block", "number", "text")))
    whole = F.array_join(F.transform(pieces, lambda p: p["text"]), separator)
    return parts.groupBy("file", element).agg(whole.alias("text"))
