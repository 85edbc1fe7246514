"""Core: hero dimension, match fact, player fact.

Rankings end in the content that is read, so that rows loaded at the same time always rank the
same way; the newest load comes first, an unknown load time before all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from arenalake.config import DEFAULTS, Settings
from arenalake.functions.payload import PLAYER_FIELDS, player_columns, players
from arenalake.functions.rules import is_radiant, stream_rank
from arenalake.operators.selection import first_per_key


def dim_heroes(stg_hero_stats: DataFrame) -> DataFrame:
    """The latest snapshot of each hero."""
    content = [c for c in stg_hero_stats.columns if c not in ("hero_id", "loaded_at")]
    order = [F.col("loaded_at").desc_nulls_first(), *[F.col(c).asc() for c in content]]
    return first_per_key(stg_hero_stats, ["hero_id"], order)


def fct_match(
    stg_matches: DataFrame, settings: Settings = DEFAULTS, keys: tuple[str, ...] = ("match_id",)
) -> DataFrame:
    """One row per match: preferred stream, then latest load."""
    content = [
        c
        for c in stg_matches.columns
        if c not in (*keys, "loaded_at", "match_started_at_utc", "match_date")
    ]
    order = [
        stream_rank(F.col("source_stream"), settings).asc(),
        F.col("loaded_at").desc_nulls_first(),
        *[F.col(c).desc() for c in content],
    ]
    return first_per_key(stg_matches, keys, order)


def selected_payloads(
    raw_matches: DataFrame,
    settings: Settings = DEFAULTS,
    fields: tuple[str, ...] = PLAYER_FIELDS,
) -> DataFrame:
    """The preferred raw row of each match, ranked by the outer id, with its typed players.

    The players are read before the ranking: the shuffle carries a few numbers per player
    instead of whole documents.
    """
    return preferred_payloads(typed_payloads(raw_matches, fields), settings)


def typed_payloads(raw_matches: DataFrame, fields: tuple[str, ...] = PLAYER_FIELDS) -> DataFrame:
    return raw_matches.where(F.col("match_id").isNotNull()).select(
        "match_id",
        "source_stream",
        "recency_window",
        "start_time",
        "loaded_at",
        players(F.col("raw_payload"), fields).alias("players"),
    )


def preferred_payloads(
    rows: DataFrame, settings: Settings = DEFAULTS, keys: tuple[str, ...] = ("match_id",)
) -> DataFrame:
    """The preferred one of typed rows; also of winners of earlier rankings and new rows."""
    order = [
        stream_rank(F.col("source_stream"), settings).asc(),
        F.col("loaded_at").desc_nulls_first(),
        F.col("source_stream").desc(),
        F.col("recency_window").desc(),
        F.col("start_time").desc(),
        F.col("players").desc(),
    ]
    return first_per_key(rows, keys, order)


def needed_fields(fields: tuple[str, ...]) -> tuple[str, ...]:
    """The player fields to read: the wanted ones, and slot and hero, which decide validity."""
    return tuple(f for f in PLAYER_FIELDS if f in fields or f in ("player_slot", "hero_id"))


def explode_players(
    payloads: DataFrame, carried: tuple[str, ...], fields: tuple[str, ...]
) -> DataFrame:
    """One row per player that has a slot and a hero, with the ``carried`` match columns."""
    exploded = payloads.select(*carried, F.explode("players").alias("player"))
    rows = exploded.select(*carried, *player_columns(F.col("player"), fields))
    return rows.where(F.col("player_slot").isNotNull() & (F.col("hero_id") > 0))


def fct_player_match(
    raw_matches: DataFrame,
    settings: Settings = DEFAULTS,
    fields: tuple[str, ...] = PLAYER_FIELDS,
) -> DataFrame:
    """One row per match and player slot; players without slot or hero are dropped.

    ``fields`` narrows the payload reads for a consumer that needs a few attributes only.
    """
    needed = needed_fields(fields)
    return player_fact(selected_payloads(raw_matches, settings, needed), needed, settings)


def player_fact(payloads: DataFrame, needed: tuple[str, ...] = PLAYER_FIELDS, settings: Settings = DEFAULTS) -> DataFrame:
    """The player fact from preferred payloads."""
    rows = explode_players(payloads, ("match_id", "source_stream", "recency_window"), needed)
    rows = rows.withColumn(
        "player_match_key",
        F.concat(F.col("match_id").cast("string"), F.lit("-"), F.col("player_slot").cast("string")),
    ).withColumn("is_radiant", is_radiant(F.col("player_slot"), settings))
    at = needed.index("assists") + 1 if "assists" in needed else len(needed)
    ordered = [*needed[:at], "is_radiant", *needed[at:]]
    return rows.select("player_match_key", "match_id", "source_stream", "recency_window", *ordered)
