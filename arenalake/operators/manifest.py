"""Manifests: one row per match to process."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from arenalake.config import DEFAULTS, Settings
from arenalake.functions.rules import stream_rank
from arenalake.functions.windows import is_target_window, recency_window
from arenalake.operators.selection import first_per_key
from arenalake.sources.schemas import MANIFEST_COLUMNS


def manifest_rows(
    entries: DataFrame, stream: str, *, targets_only: bool = True, settings: Settings = DEFAULTS
) -> DataFrame:
    """Page entries as manifest rows; entries without id or start are dropped."""
    rows = entries.where(F.col("match_id").isNotNull() & F.col("start_time").isNotNull())
    rows = rows.withColumn("source_stream", F.lit(stream)).withColumn(
        "recency_window", recency_window(F.col("start_time"), settings)
    )
    if targets_only:
        rows = rows.where(is_target_window(F.col("recency_window"), settings))
    placed = [c for c in ("page_no", "pos") if c in entries.columns]
    return rows.select(*MANIFEST_COLUMNS, *placed)


def page_place() -> Column:
    """Place of an entry in page order as one number."""
    return F.shiftleft(F.col("page_no"), 32) + F.col("pos")


def dedupe_matches(entries: DataFrame) -> DataFrame:
    """One row per match with its newest start time."""
    return (
        entries.where(F.col("match_id").isNotNull() & F.col("start_time").isNotNull())
        .groupBy("match_id")
        .agg(F.max("start_time").alias("start_time"))
    )


def dedupe_limit(entries: DataFrame, limit: int | None) -> DataFrame:
    """The first ``limit`` matches in order of first appearance, each with its newest start."""
    if limit is None:
        return dedupe_matches(entries)
    return (
        entries.where(F.col("match_id").isNotNull() & F.col("start_time").isNotNull())
        .groupBy("match_id")
        .agg(
            F.max("start_time").alias("start_time"),
            # One long instead of a struct keeps the aggregation hash-based.
            F.min(page_place()).alias("seen_at"),
        )
        .orderBy("seen_at", "match_id")
        .limit(limit)
        .select("match_id", "start_time")
    )


def public_manifest(entries: DataFrame, limit: int | None = None, settings: Settings = DEFAULTS) -> DataFrame:
    """Public slice: deduplicated, limited if asked for, and labelled, outside windows included."""
    kept = dedupe_limit(entries, limit)
    return manifest_rows(kept, "public_matches", targets_only=False, settings=settings)


def concat_manifests(manifests: list[DataFrame]) -> DataFrame:
    """Manifests one after the other; ``seen_at`` keeps the list order for ties."""
    ordered = [
        m.select(*MANIFEST_COLUMNS, F.lit(i).alias("seen_at")) for i, m in enumerate(manifests)
    ]
    return reduce(DataFrame.unionByName, ordered)


def merge_manifests(rows: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """One row per match: preferred stream, then newest start, then the later input.

    Rows that lack one of the four values are dropped. The result is not sorted; see
    ``newest_first`` and ``newest_manifest``.
    """
    complete = rows.dropna(subset=list(MANIFEST_COLUMNS))
    order = [
        stream_rank(F.col("source_stream"), settings).asc(),
        F.col("start_time").desc(),
        F.col("seen_at").desc(),
        F.col("source_stream").asc(),
        F.col("recency_window").asc(),
    ]
    return first_per_key(complete, ["match_id"], order).select(*MANIFEST_COLUMNS)


def newest_first(manifest: DataFrame) -> DataFrame:
    return manifest.orderBy(F.col("start_time").desc(), F.col("match_id").desc())


def newest_manifest(manifest: DataFrame, limit: int) -> DataFrame:
    """The ``limit`` newest matches; each task keeps its own top rows first."""
    return newest_first(manifest).limit(limit)


def admit_resources(
    resources: DataFrame, size_column: str, max_bytes: int = DEFAULTS.max_resource_bytes
) -> DataFrame:
    """Resources that may be read: of unknown size, or not above the bound."""
    size = F.col(size_column)
    return resources.where(size.isNull() | (size <= max_bytes))
