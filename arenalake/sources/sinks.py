"""Sinks: JSON lines, manifest CSV, ordered mart exports, reports, raw and model tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from arenalake.sources.schemas import MANIFEST_COLUMNS, RAW_TABLES


def write_json_lines(rows: DataFrame, path: str, lines_per_file: int = 0) -> None:
    """With ``lines_per_file`` they are compressed, in files of so many lines: a reader's task takes whole files."""
    writer = rows.write.mode("overwrite")
    if lines_per_file:
        writer = writer.option("maxRecordsPerFile", lines_per_file).option("compression", "gzip")
    writer.json(path)


def write_records(records: DataFrame, path: str) -> None:
    """Raw VARIANT records as they came, one JSON line each; nothing is filtered."""
    records.select(F.to_json("record").alias("value")).write.mode("overwrite").text(path)


def write_progress(progress: DataFrame, path: str) -> None:
    """The one-row backfill progress, null values included."""
    progress.write.mode("overwrite").option("ignoreNullFields", False).json(path)


# Text stays as it is: outer spaces, quotes and line breaks survive.
EXACT_CSV = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def write_manifest(manifest: DataFrame, path: str) -> None:
    """Manifest rows as JSON lines under ``path/json`` and, read back from there, as CSV under ``path/csv``."""
    rows = manifest.select(*MANIFEST_COLUMNS)
    rows.write.mode("overwrite").json(f"{path}/json")
    stored = manifest.sparkSession.read.schema(rows.schema).json(f"{path}/json")
    stored.write.mode("overwrite").options(**EXACT_CSV).csv(f"{path}/csv")


def write_snapshot_csv(rows: DataFrame, path: str) -> None:
    """Analytical snapshot with a header, also when there are no rows."""
    rows.write.mode("overwrite").options(**EXACT_CSV).csv(path)


# The order of each mart export.
EXPORT_ORDER = {
    "mart_liveops_summary": ("recency_window",),
    "mart_hero_meta_shift": ("hero_id", "recency_window"),
    "mart_returning_player_proxy": ("recency_window",),
}


def export_rows(mart: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """Mart rows in export order under upper-case names; nulls sort last."""
    ordered = mart.orderBy(*[F.col(name).asc_nulls_last() for name in order])
    return ordered.select(*[F.col(name).alias(name.upper()) for name in mart.columns])


def export_mart(mart: DataFrame, name: str, directory: str) -> str:
    """Write one mart as CSV and return its path.

    The sort is a range partitioning, so part files follow the order and no task holds the
    whole mart. Each part has a header; quotes are doubled.
    """
    path = f"{directory}/{name}.csv"
    rows = export_rows(mart, EXPORT_ORDER[name])
    rows.write.mode("overwrite").options(**EXACT_CSV).csv(path)
    return path


def write_report(report: DataFrame, path: str) -> bool:
    """Write the one-row validation report and return its verdict."""
    report.write.mode("overwrite").json(path)
    return report.sparkSession.read.json(path).first()["is_valid"]


def ensure_raw_tables(spark: SparkSession, schema: str) -> None:
    """Create the schema and the raw tables where they do not exist yet."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")
    for name, columns in RAW_TABLES.items():
        spark.sql(f"CREATE TABLE IF NOT EXISTS {schema}.{name} ({columns}) USING parquet")


def append_raw(rows: DataFrame, schema: str, name: str, *, replace: bool = False) -> dict[str, int]:
    """Add rows to a raw table, or replace its content, in one distributed write.

    Returns what the write itself has counted: its ``rows``, and for each column its nulls.
    """
    counted = Observation()
    nulls = [F.count_if(F.col(c).isNull()).alias(f"null {c}") for c in rows.columns]
    seen = rows.observe(counted, F.count(F.lit(1)).alias("rows"), *nulls)
    seen.write.insertInto(f"{schema}.{name}", overwrite=replace)
    return counted.get


def truncate_raw_tables(spark: SparkSession, schema: str) -> None:
    for name in RAW_TABLES:
        if spark.catalog.tableExists(f"{schema}.{name}"):
            spark.sql(f"TRUNCATE TABLE {schema}.{name}")


def save_model(
    model: DataFrame,
    table: str,
    *,
    bucket_by: str | None = None,
    buckets: int = 200,
    partition_by: str | None = None,
) -> DataFrame:
    """Materialize a model as a table.

    Facts bucketed and sorted by ``match_id`` join each other without a shuffle, and a partition
    column lets window filters skip files. Rows are brought together per bucket first, instead of
    every task writing a small file to each bucket. A multiple of the buckets, as near to the number of
    shuffle partitions as it gets, makes the tasks: each has a share of one bucket, so that few buckets
    do not mean large tasks.
    """
    rows = model
    if bucket_by:
        shares = int(model.sparkSession.conf.get("spark.sql.shuffle.partitions")) // buckets
        rows = model.repartition(buckets * max(1, shares), bucket_by)
    writer = rows.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    if bucket_by:
        writer = writer.bucketBy(buckets, bucket_by).sortBy(bucket_by)
    writer.saveAsTable(table)
    return model.sparkSession.table(table).select(*model.columns)
