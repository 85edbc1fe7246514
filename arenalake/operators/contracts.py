"""Contract of the exported marts: columns, windows, populated deltas, and the report."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from arenalake.config import DEFAULTS, Settings
from arenalake.sources.csv_files import read_export

# Export names and the columns a dashboard needs.
REQUIRED_COLUMNS = {
    "mart_liveops_summary": (
        "RECENCY_WINDOW",
        "MATCH_COUNT",
        "PLAYER_ROW_COUNT",
        "KNOWN_ACCOUNT_COUNT",
        "DISTINCT_HERO_COUNT",
        "AVG_MATCH_DURATION_MINUTES",
        "RADIANT_WIN_RATE",
        "PATCH_COUNT",
        "LEAGUE_COUNT",
    ),
    "mart_returning_player_proxy": (
        "RECENCY_WINDOW",
        "KNOWN_ACCOUNT_COUNT",
        "RETURNING_ACCOUNT_COUNT",
        "NET_NEW_ACCOUNT_COUNT",
        "RETURNING_ACCOUNT_RATE",
    ),
    "mart_hero_meta_shift": (
        "HERO_WINDOW_KEY",
        "RECENCY_WINDOW",
        "HERO_ID",
        "HERO_NAME",
        "PRIMARY_ATTRIBUTE",
        "ATTACK_TYPE",
        "ROLE_LIST",
        "HERO_PICKS",
        "WIN_RATE",
        "PICK_RATE",
        "PREVIOUS_WINDOW_PICK_RATE",
        "CURRENT_WINDOW_PICK_RATE",
        "PREVIOUS_WINDOW_WIN_RATE",
        "CURRENT_WINDOW_WIN_RATE",
        "PICK_RATE_DELTA_VS_PRIOR_WINDOW",
        "WIN_RATE_DELTA_VS_PRIOR_WINDOW",
        "VOLATILITY_SCORE",
        "STABILITY_SEGMENT",
    ),
}
WINDOW_COLUMN = "RECENCY_WINDOW"
DELTA_COLUMNS = REQUIRED_COLUMNS["mart_hero_meta_shift"][10:]
HERO_MART = "mart_hero_meta_shift"


def _text(export: DataFrame, name: str) -> Column:
    """Trimmed text of a column; empty for null and for a column that is not there."""
    if name not in export.columns:
        return F.lit("")
    return F.trim(F.coalesce(F.col(name), F.lit("")))


def missing_columns(export: DataFrame, name: str) -> list[str]:
    """Required columns that the header lacks; only the header is looked at."""
    return [c for c in REQUIRED_COLUMNS[name] if c not in export.columns]


def missing_windows(export: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """One row with the target windows that have no row, in window order."""
    window = _text(export, WINDOW_COLUMN)
    seen = F.collect_set(F.when(window.isin(settings.labels), window))
    wanted = F.array(*[F.lit(label) for label in settings.labels])
    return export.agg(F.array_except(wanted, seen).alias("missing_windows"))


def complete_deltas(export: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """One row: does any current-window hero have all its delta values?"""
    filled = _text(export, WINDOW_COLUMN) == settings.current_window
    for name in DELTA_COLUMNS:
        filled = filled & (_text(export, name) != "")
    return export.agg(F.coalesce(F.bool_or(filled), F.lit(False)).alias("has_complete_deltas"))


def _error_rows(rows: DataFrame, order: int, condition: Column, message: Column) -> DataFrame:
    return rows.where(condition).select(F.lit(order).alias("position"), message.alias("error"))


def export_errors(
    spark: SparkSession, directory: str, name: str, settings: Settings = DEFAULTS
) -> list[DataFrame]:
    """Errors of one export, in report order."""
    file_name = f"{name}.csv"
    path = f"{directory}/{file_name}"
    first = list(REQUIRED_COLUMNS).index(name) * 10
    one = spark.range(1)
    try:
        export = read_export(spark, path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return [_error_rows(one, first, F.lit(True), F.lit(f"Missing exported mart: {path}"))]
    absent = missing_columns(export, name)
    columns = F.lit(f"{file_name} is missing required columns: {', '.join(absent)}")
    gaps = missing_windows(export, settings)
    windows = F.concat(
        F.lit(f"{file_name} is missing target windows: "), F.array_join("missing_windows", ", ")
    )
    errors = [
        _error_rows(one, first, F.lit(bool(absent)), columns),
        _error_rows(gaps, first + 1, F.size("missing_windows") > 0, windows),
    ]
    if name == HERO_MART:
        deltas = F.lit(
            f"{file_name} does not contain a {settings.current_window} hero row with populated "
            "prior/current delta fields."
        )
        errors.append(
            _error_rows(
                complete_deltas(export, settings), first + 2, ~F.col("has_complete_deltas"), deltas
            )
        )
    return errors


def validation_report(
    spark: SparkSession, directory: str, settings: Settings = DEFAULTS
) -> DataFrame:
    """One row: directory, target windows, verdict, errors. A mart adds at most three errors."""
    found = [e for name in REQUIRED_COLUMNS for e in export_errors(spark, directory, name, settings)]
    rows = reduce(DataFrame.unionByName, found)
    listed = F.transform(
        F.sort_array(F.collect_list(F.struct("position", "error"))), lambda item: item["error"]
    )
    return rows.agg(listed.alias("errors")).select(
        F.lit(directory).alias("output_directory"),
        F.array(*[F.lit(label) for label in settings.labels]).alias("target_windows"),
        (F.size("errors") == 0).alias("is_valid"),
        "errors",
    )
