"""Envelopes around match payloads, and snapshots out of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from arenalake.config import DEFAULTS, Settings
from arenalake.functions.payload import (
    MATCH_FIELDS,
    PLAYER_FIELDS,
    has_key,
    player_columns,
    players,
    read_fields,
)
from arenalake.functions.rules import is_radiant
from arenalake.functions.windows import recency_window
from arenalake.operators.selection import first_per_key
from arenalake.sources.schemas import MANIFEST_COLUMNS


def build_envelopes(
    manifest: DataFrame, payloads: DataFrame, ingested_at: Column, order: list[Column] = ()
) -> DataFrame:
    """One envelope per manifest row; rows whose payload is missing are skipped.

    Of several payloads of a match the first by ``order`` is taken, ties by content. Payloads of
    matches outside the manifest are left out before that, and each task keeps one payload per
    match, so that no id is a hot key and few documents are moved.
    """
    wanted = payloads.join(manifest.select("match_id").distinct(), "match_id", "left_semi")
    one = first_per_key(wanted, ["match_id"], [*order, F.xxhash64(F.to_json("payload"))])
    return manifest.join(one.select("match_id", "payload"), "match_id").select(
        *MANIFEST_COLUMNS, ingested_at.alias("ingested_at"), "payload"
    )


def missing_payloads(manifest: DataFrame, payloads: DataFrame) -> DataFrame:
    """Manifest rows without a payload. Ids are made distinct first, so no id is a hot key."""
    return manifest.join(payloads.select("match_id").distinct(), "match_id", "left_anti")


def normalize_envelopes(records: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Envelope and bare-payload records in one shape: stream, window, payload.

    A bare payload has an unknown stream. A missing label comes from the payload's start time,
    where a missing start counts as epoch 0.
    """
    record = F.col("record")
    enveloped = has_key(record, "payload")
    rows = records.select(
        F.when(enveloped, F.variant_get(record, "$.payload", "variant"))
        .otherwise(record)
        .alias("payload"),
        F.when(enveloped, F.variant_get(record, "$.source_stream", "string")).alias("stream"),
        F.when(enveloped, F.variant_get(record, "$.recency_window", "string")).alias("label"),
    )
    start = F.coalesce(F.variant_get("payload", "$.start_time", "bigint"), F.lit(0))
    return rows.select(
        F.coalesce("stream", F.lit(settings.unknown_stream)).alias("source_stream"),
        F.coalesce("label", recency_window(start, settings)).alias("recency_window"),
        "payload",
    )


def match_snapshot(normalized: DataFrame) -> DataFrame:
    """One row per record."""
    return normalized.select(
        "source_stream", "recency_window", *read_fields(F.col("payload"), MATCH_FIELDS)
    )


def player_snapshot(normalized: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """One row per player. Keeps players without hero or slot; a missing slot counts as radiant."""
    exploded = normalized.select(
        "source_stream",
        "recency_window",
        F.variant_get("payload", "$.match_id", "bigint").alias("match_id"),
        F.explode(players(F.col("payload"))).alias("player"),
    )
    rows = exploded.select(
        "source_stream", "recency_window", "match_id", *player_columns(F.col("player"))
    )
    rows = rows.withColumn(
        "is_radiant", is_radiant(F.coalesce("player_slot", F.lit(0)), settings)
    )
    at = PLAYER_FIELDS.index("assists") + 1
    ordered = [*PLAYER_FIELDS[:at], "is_radiant", *PLAYER_FIELDS[at:]]
    return rows.select("source_stream", "recency_window", "match_id", *ordered)


def hero_rows(records: DataFrame) -> DataFrame:
    """Hero check rows; heroes without id or name are dropped."""
    record = F.col("record")
    return records.select(
        F.variant_get(record, "$.id", "bigint").alias("hero_id"),
        F.variant_get(record, "$.localized_name", "string").alias("hero_name"),
        F.variant_get(record, "$.primary_attr", "string").alias("primary_attribute"),
        F.variant_get(record, "$.attack_type", "string").alias("attack_type"),
        F.variant_get(record, "$.pro_pick", "bigint").alias("pro_pick"),
        F.variant_get(record, "$.pro_win", "bigint").alias("pro_win"),
    ).where(F.col("hero_id").isNotNull() & F.col("hero_name").isNotNull())
