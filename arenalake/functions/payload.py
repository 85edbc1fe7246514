"""Typed reads out of VARIANT payloads. A value of the wrong type is an error, an absent key is null."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Column name, payload key, type.
MATCH_FIELDS = (
    ("match_id", "match_id", "bigint"),
    ("start_time", "start_time", "bigint"),
    ("duration_seconds", "duration", "bigint"),
    ("radiant_win", "radiant_win", "boolean"),
    ("lobby_type", "lobby_type", "bigint"),
    ("game_mode", "game_mode", "bigint"),
    ("patch", "patch", "bigint"),
    ("region", "region", "bigint"),
    ("radiant_score", "radiant_score", "bigint"),
    ("dire_score", "dire_score", "bigint"),
    ("league_id", "leagueid", "bigint"),
    ("league_name", "league_name", "string"),
)
HERO_FIELDS = (
    ("hero_id", "id", "bigint"),
    ("hero_name", "localized_name", "string"),
    ("primary_attribute", "primary_attr", "string"),
    ("attack_type", "attack_type", "string"),
    ("role_list", "roles", "string"),
    ("pro_pick", "pro_pick", "bigint"),
    ("pro_win", "pro_win", "bigint"),
    ("pro_ban", "pro_ban", "bigint"),
    ("turbo_picks", "turbo_picks", "bigint"),
    ("turbo_wins", "turbo_wins", "bigint"),
)
PLAYER_FIELDS = (
    "account_id",
    "player_slot",
    "hero_id",
    "kills",
    "deaths",
    "assists",
    "win",
    "lane_role",
    "rank_tier",
    "leaver_status",
    "total_gold",
    "total_xp",
)

# Whole numbers: reading through a decimal rounds 1.5 to 2 as a warehouse does; a bigint read cuts it to 1.
_INTEGER = "decimal(18,0)"


def _read(payload: Column, key: str, kind: str) -> Column:
    if kind == "bigint":
        return F.variant_get(payload, f"$.{key}", _INTEGER).cast("bigint")
    return F.variant_get(payload, f"$.{key}", kind)


def read_fields(payload: Column, fields: tuple[tuple[str, str, str], ...]) -> list[Column]:
    """One column per field, so that Catalyst drops the reads that a query does not use."""
    return [_read(payload, key, kind).alias(name) for name, key, kind in fields]


def has_key(record: Column, key: str) -> Column:
    """Whether the key is there, even with a JSON null."""
    return F.variant_get(record, f"$.{key}", "variant").isNotNull()


def players(payload: Column, fields: tuple[str, ...] = PLAYER_FIELDS) -> Column:
    """The players as an array of narrow structs: no copy of the document per player."""
    shape = ",".join(f"{name}:{_INTEGER}" for name in fields)
    return F.variant_get(payload, "$.players", f"array<struct<{shape}>>")


def player_columns(player: Column, fields: tuple[str, ...] = PLAYER_FIELDS) -> list[Column]:
    return [player[name].cast("bigint").alias(name) for name in fields]
