"""Data-quality checks. Each check is a query for violating rows; the suite counts them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from arenalake.config import DEFAULTS, Settings

# What must hold for each model.
NOT_NULL = {
    "stg_matches": ("match_id", "source_stream", "recency_window"),
    "stg_hero_stats": ("hero_id", "hero_name"),
    "dim_heroes": ("hero_id",),
    "fct_match": ("match_id", "recency_window"),
    "fct_player_match": ("player_match_key", "match_id", "hero_id"),
    "mart_liveops_summary": ("recency_window",),
    "mart_hero_meta_shift": ("hero_window_key", "hero_id", "recency_window"),
    "mart_returning_player_proxy": ("recency_window",),
}
UNIQUE = {
    "dim_heroes": "hero_id",
    "fct_match": "match_id",
    "fct_player_match": "player_match_key",
    "mart_liveops_summary": "recency_window",
    "mart_hero_meta_shift": "hero_window_key",
    "mart_returning_player_proxy": "recency_window",
}
RELATIONSHIPS = (
    ("fct_player_match", "match_id", "fct_match", "match_id"),
    ("fct_player_match", "hero_id", "dim_heroes", "hero_id"),
    ("mart_hero_meta_shift", "hero_id", "dim_heroes", "hero_id"),
)
SEGMENTS = ("stable", "watchlist", "volatile")


def accepted_values(settings: Settings = DEFAULTS) -> tuple[tuple[str, str, tuple[str, ...]], ...]:
    labels = tuple(settings.labels)
    return (
        ("mart_liveops_summary", "recency_window", labels),
        ("mart_hero_meta_shift", "recency_window", labels),
        ("mart_hero_meta_shift", "stability_segment", SEGMENTS),
        ("mart_returning_player_proxy", "recency_window", labels),
    )


# Violating rows


def null_rows(rows: DataFrame, column: str) -> DataFrame:
    return rows.where(F.col(column).isNull())


def duplicate_keys(rows: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their count; nulls are ignored."""
    counts = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    return counts.where(F.col("n") > 1)


def orphan_keys(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child keys without a parent, with their row count; nulls are ignored.

    Children are counted per key first, so a key that holds much of the data joins as one row.
    """
    counts = child.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    parents = parent.select(F.col(parent_key).alias(key))
    return counts.join(parents, key, "left_anti")


def unexpected_rows(rows: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Rows with a value outside the list; null passes."""
    return rows.where(~F.col(column).isin(list(values)))


# Counts


def _result(check: str, model: str, column: str, failures: DataFrame) -> DataFrame:
    return failures.select(
        F.lit(check).alias("check_name"),
        F.lit(model).alias("model"),
        F.lit(column).alias("column_name"),
        F.col("failures").cast("bigint").alias("failures"),
    )


def check_not_null(models: Mapping[str, DataFrame], columns=NOT_NULL) -> DataFrame:
    """All columns of a model are counted in one pass."""
    results = []
    for model, names in columns.items():
        counts = models[model].agg(*[F.count_if(F.col(n).isNull()).alias(n) for n in names])
        spans = [
            F.struct(F.lit(n).alias("column_name"), F.col(n).alias("failures")) for n in names
        ]
        results.append(
            counts.select(
                F.lit("not_null").alias("check_name"),
                F.lit(model).alias("model"),
                F.inline(F.array(*spans)),
            )
        )
    return reduce(DataFrame.unionByName, results)


def check_unique(models: Mapping[str, DataFrame], keys=UNIQUE) -> DataFrame:
    """Failures are keys, not rows."""
    return reduce(
        DataFrame.unionByName,
        [
            _result(
                "unique",
                model,
                key,
                duplicate_keys(models[model], key).agg(F.count("*").alias("failures")),
            )
            for model, key in keys.items()
        ],
    )


def check_relationships(models: Mapping[str, DataFrame], relations=RELATIONSHIPS) -> DataFrame:
    return reduce(
        DataFrame.unionByName,
        [
            _result(
                f"relationships_{parent}",
                child,
                key,
                orphan_keys(models[child], key, models[parent], parent_key).agg(
                    F.coalesce(F.sum("n"), F.lit(0)).alias("failures")
                ),
            )
            for child, key, parent, parent_key in relations
        ],
    )


def check_accepted_values(models: Mapping[str, DataFrame], rules=None) -> DataFrame:
    return reduce(
        DataFrame.unionByName,
        [
            _result(
                "accepted_values",
                model,
                column,
                unexpected_rows(models[model], column, values).agg(F.count("*").alias("failures")),
            )
            for model, column, values in (accepted_values() if rules is None else rules)
        ],
    )


def run_checks(models: Mapping[str, DataFrame]) -> DataFrame:
    """Every check with its number of failures."""
    parts = [
        check_not_null(models),
        check_unique(models),
        check_relationships(models),
        check_accepted_values(models),
    ]
    return reduce(DataFrame.unionByName, parts)
