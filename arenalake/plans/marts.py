"""Marts: activity summary, hero shift between windows, returning players.

Marts take player rows: players with the window and start time of their match, target windows
only. Each mart shuffles them once, on the hero or the account, after map-side partial sums. Both
windows of a hero or an account then meet in one row, so no self-joins are needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from arenalake.config import DEFAULTS, Settings
from arenalake.functions.numeric import flag, mean, minutes, ratio
from arenalake.functions.rules import stability_segment
from arenalake.functions.windows import epoch_to_ntz, is_target_window, window_start
from arenalake.operators.distinct import count_different, estimate, key_sketches, merge_sketches
from arenalake.plans import core


def in_target_windows(rows: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    return rows.where(is_target_window(F.col("recency_window"), settings))


def player_match_rows(
    fct_player_match: DataFrame,
    fct_match: DataFrame,
    columns: tuple[str, ...],
    settings: Settings = DEFAULTS,
) -> DataFrame:
    """Player columns with the window and start time of their match, target windows only.

    Both facts come partitioned by match, from their ranking or from buckets, so a merge join
    shuffles nothing. A broadcast would move a fact through the driver for no gain.
    """
    matches = in_target_windows(fct_match, settings).select(
        "match_id", "recency_window", "start_time"
    )
    return fct_player_match.select("match_id", *columns).join(matches.hint("merge"), "match_id")


def player_rows_from_raw(
    raw_matches: DataFrame,
    fct_match: DataFrame,
    columns: tuple[str, ...],
    *,
    own_window: bool = False,
    settings: Settings = DEFAULTS,
) -> DataFrame:
    """The rows of ``player_match_rows`` when the player fact is not stored.

    Matches are joined before their players are exploded: the join sees a tenth of the rows, both
    sides arrive sorted from their ranking, and players of other windows are never exploded.
    ``own_window`` also asks for a target label on the player's own raw row.
    """
    needed = core.needed_fields(columns)
    payloads = core.selected_payloads(raw_matches, settings, needed)
    if own_window:
        payloads = in_target_windows(payloads, settings)
    matches = in_target_windows(fct_match, settings).select(
        "match_id", "recency_window", "start_time"
    )
    joined = payloads.select("match_id", "players").join(matches.hint("merge"), "match_id")
    carried = ("match_id", "recency_window", "start_time")
    return core.explode_players(joined, carried, needed).select(*carried, *columns)


# Hero shift


def window_totals(player_rows: DataFrame) -> DataFrame:
    return player_rows.groupBy("recency_window").agg(F.count("*").alias("total_player_rows"))


def hero_window_metrics(player_rows: DataFrame) -> DataFrame:
    """Picks and win rate per window and hero; an unknown result is a loss."""
    return player_rows.groupBy("recency_window", "hero_id").agg(
        F.count("*").alias("hero_picks"), mean(flag(F.col("win") == 1)).alias("win_rate")
    )


def hero_counts(player_rows: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Picks and wins of each hero, a column per window."""
    counted = []
    for label in settings.labels:
        here = F.col("recency_window") == label
        counted.append(F.sum(flag(here)).alias(f"picks {label}"))
        counted.append(F.sum(flag(here & (F.col("win") == 1))).alias(f"wins {label}"))
    return player_rows.groupBy("hero_id").agg(*counted)


def _hero_rates(player_rows: DataFrame, settings: Settings) -> DataFrame:
    return _rates_of(hero_counts(player_rows, settings), settings)


def _rates_of(counts: DataFrame, settings: Settings) -> DataFrame:
    """One row per hero: struct column per window with picks, win rate, total and pick rate.

    The struct is null for a window without picks. The totals are a scalar subquery over the
    same shuffled counts: one pass over the player rows, and nothing depends on how many heroes
    there are.
    """
    # The filter is always true. It keeps the columns of both uses equal, which lets Spark reuse
    # the exchange.
    used = F.greatest(*[F.col(f"`wins {label}`") for label in settings.labels]) >= 0
    totals = counts.where(used).agg(
        F.struct(*[F.sum(f"`picks {label}`").alias(label) for label in settings.labels])
    )
    rows = counts.withColumn("totals", totals.scalar())
    metrics = []
    for label in settings.labels:
        picks, total = F.col(f"`picks {label}`"), F.col("totals")[label]
        metrics.append(
            F.when(
                picks > 0,
                F.struct(
                    picks.alias("hero_picks"),
                    ratio(F.col(f"`wins {label}`"), picks).alias("win_rate"),
                    total.alias("total_player_rows"),
                    ratio(picks, total).alias("pick_rate"),
                ),
            ).alias(label)
        )
    return rows.select("hero_id", *metrics)


def _per_window(rates: DataFrame, carried: tuple[str, ...], settings: Settings) -> DataFrame:
    """Hero rows turned into one row per hero and window with picks."""
    metrics = ("hero_picks", "win_rate", "total_player_rows", "pick_rate")
    spans = F.array(
        *[
            F.struct(
                F.lit(label).alias("recency_window"),
                *[F.col(f"`{label}`.{m}").alias(m) for m in metrics],
            )
            for label in settings.labels
        ]
    )
    rows = rates.select("hero_id", F.explode(spans).alias("span"), *carried)
    return rows.where(F.col("span.hero_picks").isNotNull()).select("span.*", "hero_id", *carried)


def hero_pick_rates(player_rows: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Hero metrics per window with the share of the window's picks."""
    return _per_window(_hero_rates(player_rows, settings), (), settings)


PIVOT_MEASURES = ("hero_picks", "pick_rate", "win_rate")


def _side(side: str, label: str, measure: str) -> Column:
    return F.col(f"`{label}`.{measure}").alias(f"{side}_window_{measure}")


def _with_pivot(rates: DataFrame, settings: Settings) -> DataFrame:
    sides = (("previous", settings.previous_window), ("current", settings.current_window))
    return rates.select("*", *[_side(s, w, m) for m in PIVOT_MEASURES for s, w in sides])


def hero_window_pivot(player_rows: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """One row per hero, previous and current metrics side by side; null where unseen."""
    rates = _hero_rates(player_rows, settings)
    return _with_pivot(rates, settings).select("hero_id", *PIVOT_COLUMNS)


PIVOT_COLUMNS = tuple(f"{side}_window_{m}" for m in PIVOT_MEASURES for side in ("previous", "current"))
DELTA_COLUMNS = (
    "pick_rate_delta_vs_prior_window",
    "win_rate_delta_vs_prior_window",
    "volatility_score",
    "stability_segment",
)


def with_deltas(pivot: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Adds the movement from the previous to the current window; null for a one-window hero."""
    pick = F.col("current_window_pick_rate") - F.col("previous_window_pick_rate")
    win = F.col("current_window_win_rate") - F.col("previous_window_win_rate")
    return pivot.select(
        "*",
        pick.alias("pick_rate_delta_vs_prior_window"),
        win.alias("win_rate_delta_vs_prior_window"),
        (F.abs(pick) + F.abs(win)).alias("volatility_score"),
        stability_segment(pick, win, settings).alias("stability_segment"),
    )


def _in_both_windows() -> Column:
    return (
        F.col("current_window_hero_picks").isNotNull()
        & F.col("previous_window_hero_picks").isNotNull()
    )


def hero_deltas(player_rows: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Movement of the heroes that were picked in both windows."""
    return with_deltas(hero_window_pivot(player_rows, settings).where(_in_both_windows()), settings)


HERO_ATTRIBUTES = ("hero_name", "primary_attribute", "attack_type", "role_list")


def mart_hero_meta_shift(
    player_rows: DataFrame, dim_heroes: DataFrame, settings: Settings = DEFAULTS
) -> DataFrame:
    """One row per hero and window; both rows of a hero carry the same deltas.

    Heroes of one window only have null pivot and delta columns, heroes outside the dimension
    null attributes.
    """
    return meta_shift_of(hero_counts(player_rows, settings), dim_heroes, settings)


def meta_shift_of(counts: DataFrame, dim_heroes: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """The hero mart from the counts of ``hero_counts``."""
    pivot = _with_pivot(_rates_of(counts, settings), settings)
    moved = with_deltas(pivot, settings).withColumns(
        {name: F.when(_in_both_windows(), F.col(name)) for name in PIVOT_COLUMNS}
    )
    described = moved.join(dim_heroes.select("hero_id", *HERO_ATTRIBUTES), "hero_id", "left")
    carried = (*HERO_ATTRIBUTES, *PIVOT_COLUMNS, *DELTA_COLUMNS)
    rows = _per_window(described, carried, settings)
    key = F.concat(F.col("hero_id").cast("string"), F.lit("-"), F.col("recency_window"))
    return rows.select(
        key.alias("hero_window_key"),
        "recency_window",
        "hero_id",
        *HERO_ATTRIBUTES,
        "hero_picks",
        "win_rate",
        "total_player_rows",
        "pick_rate",
        *PIVOT_COLUMNS,
        *DELTA_COLUMNS,
    )


# Activity summary


DISTINCT_COUNTS = {"account_id": "known_account_count", "hero_id": "distinct_hero_count"}


def distinct_counts(player_rows: DataFrame) -> DataFrame:
    """Player rows, known accounts and heroes per window; exact."""
    return count_different(player_rows, ("recency_window",), DISTINCT_COUNTS, "player_row_count")


SKETCHED = ("account_id", "hero_id")


def usage_sketches(player_rows: DataFrame, lg_size: int = 12) -> DataFrame:
    """Sketches of accounts and heroes per window and day, to be stored and merged for any set of days."""
    day = F.to_date(epoch_to_ntz(F.col("start_time"))).alias("match_date")
    return key_sketches(player_rows.select("recency_window", day, *SKETCHED), ("recency_window", "match_date"), SKETCHED, lg_size)


def approximate_counts(sketches: DataFrame, group: tuple[str, ...] = ("recency_window",)) -> DataFrame:
    """Estimated accounts and heroes of each group of stored sketches, within ``sketch_error`` of the exact counts."""
    merged = merge_sketches(sketches, group, SKETCHED)
    return merged.select(
        *group,
        estimate("account_id").alias("known_account_estimate"),
        estimate("hero_id").alias("hero_estimate"),
        F.greatest(*(F.octet_length(c) for c in SKETCHED)).alias("sketch_bytes"),
    )


def match_metrics(matches: DataFrame) -> DataFrame:
    """Match count, mean duration, radiant win rate, patches and leagues per window.

    Matches are summed per patch and league first, so the distinct counts expand a few groups
    and not every match.
    """
    return match_metrics_of(match_groups(matches))


MATCH_GROUP = ("recency_window", "patch", "league_id")


def match_groups(matches: DataFrame) -> DataFrame:
    """Sums of the matches of each window, patch and league."""
    duration = F.col("duration_seconds")
    return matches.groupBy(*MATCH_GROUP).agg(
        F.count("*").alias("matches"),
        F.sum(duration).alias("seconds"),
        F.count(duration).alias("timed"),
        F.sum(flag(F.col("radiant_win"))).alias("radiant"),
    )


def match_metrics_of(groups: DataFrame) -> DataFrame:
    mean_seconds = ratio(F.sum("seconds"), F.sum("timed"))
    return groups.groupBy("recency_window").agg(
        F.sum("matches").alias("match_count"),
        minutes(mean_seconds).alias("avg_match_duration_minutes"),
        ratio(F.sum("radiant"), F.sum("matches")).alias("radiant_win_rate"),
        F.count_distinct("patch").alias("patch_count"),
        F.count_distinct("league_id").alias("league_count"),
    )


def mart_liveops_summary(
    player_rows: DataFrame, fct_match: DataFrame, settings: Settings = DEFAULTS
) -> DataFrame:
    """One row per window that has both matches and players.

    The player rows must have a target label on their own raw row, too.
    """
    return summary_of(distinct_counts(player_rows), match_metrics(in_target_windows(fct_match, settings)))


def summary_of(players: DataFrame, metrics: DataFrame) -> DataFrame:
    """The activity mart from the counts of players and of matches per window."""
    matches = F.broadcast(metrics)  # at most one row per target window
    return players.join(matches, "recency_window").select(
        "recency_window",
        "match_count",
        "player_row_count",
        "known_account_count",
        "distinct_hero_count",
        "avg_match_duration_minutes",
        "radiant_win_rate",
        "patch_count",
        "league_count",
    )


# Returning players


def first_seen(player_rows: DataFrame) -> DataFrame:
    """Earliest start time of each known account."""
    known = player_rows.where(F.col("account_id").isNotNull())
    return known.groupBy("account_id").agg(F.min("start_time").alias("first_seen_start_time"))


def account_window_status(player_rows: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """One row per window and known account: was the account first seen before the window?"""
    known = player_rows.where(F.col("account_id").isNotNull())
    seen = [
        F.max(flag(F.col("recency_window") == label)).alias(f"seen {label}")
        for label in settings.labels
    ]
    return status_of(known.groupBy("account_id").agg(F.min("start_time").alias("first_seen"), *seen), settings)


def status_of(accounts: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """The status rows from a row per account: ``first_seen`` and a flag for each window."""
    present = [F.when(F.col(f"`seen {label}`") == 1, label) for label in settings.labels]
    status = accounts.select(
        "account_id", "first_seen", F.explode(F.array(*present)).alias("recency_window")
    ).where(F.col("recency_window").isNotNull())
    returning = epoch_to_ntz(F.col("first_seen")) < window_start(F.col("recency_window"), settings)
    return status.select("recency_window", "account_id", flag(returning).alias("is_returning_account"))


def mart_returning_player_proxy(
    player_rows: DataFrame, settings: Settings = DEFAULTS
) -> DataFrame:
    """Known, returning and new accounts per window.

    A status row is already unique per window and account, so plain counts are distinct counts.
    """
    return returning_of(account_window_status(player_rows, settings))


def returning_of(status: DataFrame) -> DataFrame:
    """The returning-player mart from its status rows."""
    counts = status.groupBy("recency_window").agg(
        F.count("*").alias("known_account_count"),
        F.sum("is_returning_account").alias("returning_account_count"),
    )
    known, back = F.col("known_account_count"), F.col("returning_account_count")
    return counts.select(
        "recency_window",
        known,
        back,
        (known - back).alias("net_new_account_count"),
        ratio(back, known).alias("returning_account_rate"),
    )
