"""Staging: typed columns out of the raw payloads."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from arenalake.functions.payload import HERO_FIELDS, MATCH_FIELDS, read_fields
from arenalake.functions.windows import epoch_to_ntz


def stg_matches(raw_matches: DataFrame) -> DataFrame:
    """One row per raw row that has a match id in its payload; stream and label from outside."""
    typed = raw_matches.select(
        "source_stream",
        "recency_window",
        *read_fields(F.col("raw_payload"), MATCH_FIELDS),
        "loaded_at",
    ).where(F.col("match_id").isNotNull())
    started = epoch_to_ntz(F.col("start_time"))
    rest = [name for name, _, _ in MATCH_FIELDS if name not in ("match_id", "start_time")]
    return typed.select(
        "match_id",
        "source_stream",
        "recency_window",
        "start_time",
        started.alias("match_started_at_utc"),
        F.to_date(started).alias("match_date"),
        *rest,
        "loaded_at",
    )


def stg_hero_stats(raw_hero_stats: DataFrame) -> DataFrame:
    """One row per hero and snapshot; roles stay JSON text."""
    return raw_hero_stats.select(
        *read_fields(F.col("raw_payload"), HERO_FIELDS), "loaded_at"
    ).where(F.col("hero_id").isNotNull())
