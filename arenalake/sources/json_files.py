"""JSON scans: envelope lines, free-form lines, array documents and page files."""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from arenalake.config import DEFAULTS, Settings
from arenalake.functions.windows import calendar_window
from arenalake.sources.json_arrays import read_split_arrays
from arenalake.sources.schemas import ENTRY, ENVELOPE, MANIFEST_COLUMNS, RAW_TABLES


def utc_now() -> Column:
    """One zoneless UTC timestamp per query, so all rows of a load share it."""
    return F.convert_timezone(None, F.lit("UTC"), F.localtimestamp())


def load_time(loaded_at: datetime | str | None) -> Column:
    return utc_now() if loaded_at is None else F.lit(str(loaded_at)).cast("timestamp_ntz")


def _or_empty(spark: SparkSession, schema: str, read) -> DataFrame:
    """A path that does not exist is an empty input."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_json_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One VARIANT column ``record`` per non-blank line. Lines split across tasks."""
    reader = spark.read.option("singleVariantColumn", "record").option("mode", "FAILFAST")
    return reader.json(path)


def read_json_array(
    spark: SparkSession, path: str | list[str], *, one_array_per_line: bool = False
) -> DataFrame:
    """One VARIANT column ``record`` per array element.

    Here a whole-file array is read by one task per file; ``json_arrays.read_split_arrays`` reads
    files of any size.
    """
    reader = spark.read.option("singleVariantColumn", "doc").option("mode", "FAILFAST")
    documents = reader.option("multiLine", not one_array_per_line).json(path)
    return documents.select(
        F.explode(F.variant_get("doc", "$", "array<variant>")).alias("record")
    )


def read_records(spark: SparkSession, path: str | list[str], one_array_per_line: bool) -> DataFrame:
    """Elements of arrays; lines of arrays split at line ends, other files anywhere."""
    if one_array_per_line:
        return read_json_array(spark, path, one_array_per_line=True)
    return read_split_arrays(spark, path)


def read_snapshot(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Records of an earlier raw snapshot, as ``write_records`` stores them; empty if missing."""
    return _or_empty(spark, "record variant", lambda: read_json_lines(spark, path))


def read_cursor(spark: SparkSession, progress_path: str) -> int | None:
    """The cursor that the last progress report saved, to resume a backfill."""
    row = _or_empty(
        spark,
        "next_less_than_match_id bigint",
        lambda: spark.read.schema("next_less_than_match_id bigint").json(progress_path),
    ).first()
    return row and row[0]


def read_envelopes(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Envelope lines; a line without one of the required keys fails the query."""
    rows = spark.read.schema(ENVELOPE).option("mode", "FAILFAST").json(path)
    return require_values(rows, (*MANIFEST_COLUMNS, "payload"))


def require_values(rows: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """Rows as they are; reading a null in one of the columns fails the query."""
    checked = {}
    for name in names:
        missing = F.raise_error(F.lit(f"envelope without {name}"))
        kept = F.when(F.col(name).isNull(), missing.cast(rows.schema[name].dataType))
        checked[name] = kept.otherwise(F.col(name))
    return rows.withColumns(checked)


def load_raw_matches(
    spark: SparkSession, path: str | list[str], loaded_at: datetime | str | None = None
) -> DataFrame:
    """Envelope lines as rows of ``raw_matches``."""

    def read() -> DataFrame:
        return read_envelopes(spark, path).select(
            *MANIFEST_COLUMNS,
            F.col("payload").alias("raw_payload"),
            load_time(loaded_at).alias("loaded_at"),
        )

    return _or_empty(spark, RAW_TABLES["raw_matches"], read)


def load_raw_hero_stats(
    spark: SparkSession,
    path: str | list[str],
    loaded_at: datetime | str | None = None,
    *,
    one_array_per_line: bool = False,
) -> DataFrame:
    """Hero snapshot arrays as rows of ``raw_hero_stats``; heroes without an id are dropped."""

    def read() -> DataFrame:
        heroes = read_records(spark, path, one_array_per_line)
        return heroes.select(
            F.variant_get("record", "$.id", "bigint").alias("hero_id"),
            F.col("record").alias("raw_payload"),
            load_time(loaded_at).alias("loaded_at"),
        ).where(F.col("hero_id").isNotNull())

    return _or_empty(spark, RAW_TABLES["raw_hero_stats"], read)


def load_raw_pro_matches(
    spark: SparkSession,
    path: str | list[str],
    loaded_at: datetime | str | None = None,
    *,
    one_array_per_line: bool = False,
    settings: Settings = DEFAULTS,
) -> DataFrame:
    """Pro match arrays as rows of ``raw_pro_matches``; the label comes from the calendar year."""

    def read() -> DataFrame:
        matches = read_records(spark, path, one_array_per_line)
        typed = matches.select(
            F.variant_get("record", "$.match_id", "bigint").alias("match_id"),
            F.variant_get("record", "$.start_time", "bigint").alias("start_time"),
            F.col("record").alias("raw_payload"),
        ).where(F.col("match_id").isNotNull() & F.col("start_time").isNotNull())
        return typed.select(
            "match_id",
            "start_time",
            calendar_window(F.col("start_time"), settings).alias("recency_window"),
            "raw_payload",
            load_time(loaded_at).alias("loaded_at"),
        )

    return _or_empty(spark, RAW_TABLES["raw_pro_matches"], read)


def read_pages(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Landed pages, one JSON object ``{page_no, entries}`` per line."""
    schema = "page_no bigint, entries variant"
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def typed_pages(pages: DataFrame) -> DataFrame:
    """Pages with their entries as typed structs; a page is bounded by the API's page size."""
    return pages.select(
        "page_no", F.variant_get("entries", "$", f"array<{ENTRY}>").alias("entries")
    )


def explode_pages(pages: DataFrame) -> DataFrame:
    """One row per page entry with its place; repeated entries are kept."""
    placed = typed_pages(pages).select("page_no", F.posexplode("entries").alias("pos", "entry"))
    return placed.select(
        "page_no",
        "pos",
        F.col("entry.match_id").cast("bigint").alias("match_id"),
        F.col("entry.start_time").cast("bigint").alias("start_time"),
    )
