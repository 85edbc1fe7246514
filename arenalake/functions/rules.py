"""Business rules: source preference, team side, stability segment, recommended action."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from arenalake.config import DEFAULTS, Settings


def stream_rank(stream: Column, settings: Settings = DEFAULTS) -> Column:
    """1 for the preferred stream, 2 for the next, and one shared last rank for all others."""
    rank = F.lit(len(settings.streams) + 1)
    for position, name in reversed(list(enumerate(settings.streams, start=1))):
        rank = F.when(stream == name, position).otherwise(rank)
    return rank


def is_radiant(slot: Column, settings: Settings = DEFAULTS) -> Column:
    return F.coalesce(slot < settings.dire_from_slot, F.lit(False))


def stability_segment(pick_delta: Column, win_delta: Column, settings: Settings = DEFAULTS) -> Column:
    """Null while either delta is unknown (hero seen in one window only)."""
    pick, win = F.abs(pick_delta), F.abs(win_delta)
    calm = F.lit(settings.stable_below)
    wild = F.lit(settings.volatile_from)
    known = pick.isNotNull() & win.isNotNull()
    return F.when(
        known,
        F.when((pick < calm) & (win < calm), "stable")
        .when((pick >= wild) | (win >= wild), "volatile")
        .otherwise("watchlist"),
    )


def recommended_action(segment: Column) -> Column:
    return (
        F.when(segment == "stable", "monitor")
        .when(segment == "watchlist", "targeted investigation")
        .when(segment == "volatile", "balance review")
    )


def action_focus(
    segment: Column, pick_delta: Column, pick_rate: Column, high_usage_from: Column
) -> Column:
    """Refines the action: stable high-usage, volatile rising and volatile declining heroes."""
    return (
        F.when((segment == "stable") & (pick_rate >= high_usage_from), "centralization risk")
        .when((segment == "volatile") & (pick_delta > 0), "rising: overperformance")
        .when((segment == "volatile") & (pick_delta < 0), "declining: underuse")
    )
