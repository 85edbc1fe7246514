"""CSV with line breaks in quoted text, read by as many tasks as the files have splits.

A line alone does not know whether it begins inside quotes. The number of quotes before it says so: even is
outside. Counts within a split and a running sum over the splits of a file give each line its state (``splits``). A record
begins with each line that begins outside of quotes; lines that begin inside belong to the record before. Records
of one line stay where they are, and only the lines of longer ones meet by a shuffle.

Quotes in text are doubled and text with quotes is quoted, as the sinks write it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from arenalake.sources.splits import SPLIT, in_file, in_split, joined_text, last_before, placed_text, sum_before

OPTIONS = {"escape": '"', "multiLine": "true", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def _states(lines: DataFrame) -> DataFrame:
    """Lines with their number and the quotes before them in the split, odd or even."""
    return lines.withColumn("turned", sum_before(F.col("turns"), in_split()) % 2).withColumn(
        "number", F.row_number().over(in_split())
    )


def _starts(lines: DataFrame) -> DataFrame:
    """One row a split: the state it begins with, and the last record that began before it."""
    states = _states(lines.drop("value"))
    splits = states.groupBy(*SPLIT).agg(
        (F.sum("turns") % 2).alias("turns"),
        F.max(F.when(F.col("turned") == 0, F.col("number"))).alias("last_outside"),
        F.max(F.when(F.col("turned") == 1, F.col("number"))).alias("last_inside"),
    )
    known = splits.withColumn("state", sum_before(F.col("turns"), in_file()) % 2)
    last = F.when(F.col("state") == 0, F.col("last_outside")).otherwise(F.col("last_inside"))
    opener = F.when(last.isNotNull(), F.struct("block", last.alias("number")))
    return known.select(*SPLIT, F.col("state").alias("split_state"), last_before(opener, in_file()).alias("opener"))


def split_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``text, is_first``: the records of the files, and whether a record is the first of its file."""
    lines = placed_text(spark, path, "\n").withColumn("turns", F.regexp_count("value", F.lit('"')) % 2)
    begins = (F.col("split_state") + F.col("turned")) % 2 == 0
    placed = _states(lines).join(_starts(lines), list(SPLIT)).select(
        *SPLIT, "number", "opener", begins.alias("begins"), (begins == (F.col("turns") == 0)).alias("ends"), F.col("value").alias("text")
    )
    first = (F.col("block") == 0) & (F.col("number") == 1)
    alone = placed.where("begins AND ends").select("text", first.alias("is_first"))
    own = F.when(F.col("begins"), F.struct("block", "number"))
    opened = F.last(own, ignorenulls=True).over(Window.partitionBy(*SPLIT).orderBy("number"))
    parts = placed.withColumn("record", F.coalesce(opened, F.col("opener"))).where("NOT (begins AND ends)")
    joined = joined_text(parts, "record", "\n").select(
        "text", ((F.col("record.block") == 0) & (F.col("record.number") == 1)).alias("is_first")
    )
    records = alone.unionByName(joined)
    # A record ends before the carriage return of its line end.
    return records.select(F.regexp_replace("text", "\r$", "").alias("text"), "is_first")


def read_split_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """All columns as text, named by the header; each file has one. Blank lines are no records."""
    named = spark.read.option("header", True).option("escape", '"').csv(path)
    names = named.columns
    if not names:
        return named  # files without a header have no columns and no rows
    schema = ", ".join(f"`{n}` string" for n in names)
    rows = split_records(spark, path).where(~F.col("is_first") & (F.col("text") != ""))
    return rows.select(F.from_csv("text", schema, OPTIONS).alias("r")).select("r.*")
