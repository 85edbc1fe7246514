"""Hand-built payloads through staging, facts and marts."""

import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from arenalake.plans import core, marts
from arenalake.plans.models import Models
from arenalake.plans.staging import stg_hero_stats, stg_matches
from tests.conftest import initial_plan, ranks_before_the_shuffle

OLD, NEW = 1680000000, 1740000000
DAY1, DAY2 = "2026-01-01 00:00:00", "2026-01-02 00:00:00"


def raw(spark, rows):
    """Rows: match id, stream, window, payload, load time."""
    texts = [(m, 0, s, w, json.dumps(p), t) for m, s, w, p, t in rows]
    schema = "match_id bigint, start_time bigint, source_stream string, recency_window string, t string, l string"
    return spark.createDataFrame(texts, schema).select(
        "match_id",
        "start_time",
        "source_stream",
        "recency_window",
        F.parse_json("t").alias("raw_payload"),
        F.col("l").cast("timestamp_ntz").alias("loaded_at"),
    )


def heroes(spark, rows):
    texts = [(p.get("id"), json.dumps(p), t) for p, t in rows]
    return spark.createDataFrame(texts, "hero_id bigint, t string, l string").select(
        "hero_id",
        F.parse_json("t").alias("raw_payload"),
        F.col("l").cast("timestamp_ntz").alias("loaded_at"),
    )


def payload(match_id, start, players=None, **more):
    body = {"match_id": match_id, "start_time": start, "duration": 1800, "radiant_win": True, **more}
    if players is not None:
        body["players"] = players
    return body


def player(slot, hero, **more):
    return {"player_slot": slot, "hero_id": hero, **more}


def test_staging_types_and_order(spark):
    rows = raw(spark, [(1, "pro_matches", "2025_2026", payload(1, NEW, patch=57, leagueid=9), DAY1)])
    staged = stg_matches(rows)
    assert staged.columns == [
        "match_id", "source_stream", "recency_window", "start_time", "match_started_at_utc",
        "match_date", "duration_seconds", "radiant_win", "lobby_type", "game_mode", "patch",
        "region", "radiant_score", "dire_score", "league_id", "league_name", "loaded_at",
    ]
    kinds = dict(staged.dtypes)
    assert kinds["match_started_at_utc"] == "timestamp_ntz" and kinds["match_date"] == "date"
    row = staged.first()
    assert str(row.match_started_at_utc) == "2025-02-19 21:20:00"
    assert (row.patch, row.league_id, row.region) == (57, 9, None)


def test_staging_takes_the_id_from_the_payload(spark):
    rows = raw(
        spark,
        [(1, "a", "w", payload(7, NEW), DAY1), (2, "a", "w", {"start_time": NEW}, DAY1)],
    )
    assert [r.match_id for r in stg_matches(rows).collect()] == [7]


def test_a_wrong_type_is_an_error(spark):
    rows = raw(spark, [(1, "a", "w", payload(1, "soon"), DAY1)])
    with pytest.raises(Exception, match="INVALID_VARIANT_CAST|CAST_INVALID_INPUT"):
        stg_matches(rows).collect()


def test_fractions_round_half_up(spark):
    rows = raw(spark, [(1, "a", "w", payload(1, NEW, region=1.5, patch="57"), DAY1)])
    row = stg_matches(rows).first()
    assert (row.region, row.patch) == (2, 57)


def test_hero_snapshots(spark):
    rows = heroes(
        spark,
        [
            ({"id": 1, "localized_name": "old", "roles": ["Carry", "Escape"]}, DAY1),
            ({"id": 1, "localized_name": "new", "roles": ["Carry", "Escape"]}, DAY2),
            ({"localized_name": "nobody"}, DAY2),
        ],
    )
    staged = stg_hero_stats(rows)
    assert staged.count() == 2
    dim = core.dim_heroes(staged)
    assert [(r.hero_name, r.role_list) for r in dim.collect()] == [("new", '["Carry","Escape"]')]
    assert ranks_before_the_shuffle(dim, "hero_id")


def test_pro_row_wins_over_a_later_public_row(spark):
    rows = raw(
        spark,
        [
            (1, "public_matches", "w", payload(1, NEW, [player(0, 5)], duration=2), DAY2),
            (1, "pro_matches", "w", payload(1, NEW, [player(0, 6)], duration=1), DAY1),
            (2, "unknown", "w", payload(2, NEW, [player(0, 5)], duration=3), DAY1),
            (2, "odd", "w", payload(2, NEW, [player(0, 6)], duration=4), DAY2),
        ],
    )
    facts = core.fct_match(stg_matches(rows))
    assert sorted((r.match_id, r.duration_seconds) for r in facts.collect()) == [(1, 1), (2, 4)]
    players = core.fct_player_match(rows)
    assert sorted((r.match_id, r.hero_id) for r in players.collect()) == [(1, 6), (2, 6)]
    assert ranks_before_the_shuffle(facts, "match_id")
    assert ranks_before_the_shuffle(players, "match_id")


def test_ties_do_not_depend_on_the_input_order(spark):
    one = (1, "a", "w", payload(1, NEW, [player(0, 5)], duration=1), DAY1)
    two = (1, "a", "w", payload(1, NEW, [player(0, 6)], duration=2), DAY1)
    results = set()
    for rows in ([one, two], [two, one]):
        table = raw(spark, rows)
        match = core.fct_match(stg_matches(table)).first()
        results.add((match.duration_seconds, core.fct_player_match(table).first().hero_id))
    assert len(results) == 1


def test_players_without_slot_or_hero_are_dropped(spark):
    players = [
        player(0, 5, account_id=1, win=1),
        player(127, 6),
        player(128, 7),
        player(None, 8),
        player(1, None),
        player(2, 0),
        {"hero_id": 3},
    ]
    rows = raw(spark, [(1, "a", "w", payload(1, NEW, players), DAY1)])
    facts = core.fct_player_match(rows)
    assert facts.columns == [
        "player_match_key", "match_id", "source_stream", "recency_window", "account_id",
        "player_slot", "hero_id", "kills", "deaths", "assists", "is_radiant", "win", "lane_role",
        "rank_tier", "leaver_status", "total_gold", "total_xp",
    ]
    got = sorted((r.player_match_key, r.is_radiant) for r in facts.collect())
    assert got == [("1-0", True), ("1-127", True), ("1-128", False)]


def test_no_players_no_rows(spark):
    bodies = [payload(1, NEW), payload(2, NEW, []), {**payload(3, NEW), "players": None}]
    rows = raw(spark, [(b["match_id"], "a", "w", b, DAY1) for b in bodies])
    assert core.fct_player_match(rows).count() == 0
    assert core.fct_match(stg_matches(rows)).count() == 3


def test_narrow_player_fact(spark):
    rows = raw(spark, [(1, "a", "w", payload(1, NEW, [player(0, 5, win=1)]), DAY1)])
    narrow = core.fct_player_match(rows, fields=("win",))
    assert narrow.columns[4:] == ["player_slot", "hero_id", "win", "is_radiant"]


@pytest.fixture(scope="module")
def built(spark):
    """Two windows. Hero 1 in both, 2 only now, 3 only before; hero 2 has no dimension row."""
    rows = [
        (1, "pro_matches", "2023_2024", payload(1, OLD, [player(0, 1, account_id=10, win=1), player(1, 3, account_id=11)], patch=53, leagueid=1), DAY1),
        (2, "pro_matches", "2023_2024", payload(2, OLD + 5, [player(0, 1, account_id=10, win=0)], patch=54), DAY1),
        (3, "pro_matches", "2025_2026", payload(3, NEW, [player(0, 1, account_id=10), player(1, 2), player(2, 2, account_id=12, win=1)], radiant_win=None), DAY1),
        (4, "pro_matches", "outside_target_windows", payload(4, 5, [player(0, 9, account_id=12)]), DAY1),
    ]
    dims = [({"id": 1, "localized_name": "One"}, DAY1), ({"id": 3, "localized_name": "Three"}, DAY1)]
    return Models(raw(spark, rows), heroes(spark, dims))


def test_liveops_summary(built):
    rows = {r.recency_window: r for r in built.mart_liveops_summary.collect()}
    assert set(rows) == {"2023_2024", "2025_2026"}
    old, new = rows["2023_2024"], rows["2025_2026"]
    assert (old.match_count, old.player_row_count, old.known_account_count) == (2, 3, 2)
    assert (old.distinct_hero_count, old.patch_count, old.league_count) == (2, 2, 1)
    assert old.avg_match_duration_minutes == Decimal(30) and old.radiant_win_rate == 1
    assert (new.known_account_count, new.distinct_hero_count, new.radiant_win_rate) == (2, 2, 0)


def test_window_without_players_is_absent(spark):
    rows = raw(
        spark,
        [
            (1, "a", "2023_2024", payload(1, OLD), DAY1),
            (2, "a", "2025_2026", payload(2, NEW, [player(0, 1)]), DAY1),
        ],
    )
    summary = Models(rows, heroes(spark, [({"id": 1}, DAY1)])).mart_liveops_summary
    assert [r.recency_window for r in summary.collect()] == ["2025_2026"]


def test_hero_shift(built):
    mart = built.mart_hero_meta_shift
    assert len(mart.columns) == 21
    rows = {r.hero_window_key: r for r in mart.collect()}
    assert set(rows) == {"1-2023_2024", "1-2025_2026", "2-2025_2026", "3-2023_2024"}
    one = rows["1-2025_2026"]
    assert (one.hero_name, one.hero_picks, one.total_player_rows) == ("One", 1, 3)
    assert one.pick_rate == Decimal("0.333333") and one.win_rate == 0
    assert one.previous_window_pick_rate == Decimal("0.666667")
    assert one.pick_rate_delta_vs_prior_window == Decimal("-0.333334")
    assert one.volatility_score == Decimal("0.833334")
    assert one.stability_segment == "volatile"
    before = rows["1-2023_2024"].asDict()
    carried = (*marts.PIVOT_COLUMNS, *marts.DELTA_COLUMNS)
    assert all(before[c] == one[c] for c in carried)
    assert all(rows["3-2023_2024"][c] is None for c in carried)
    assert rows["2-2025_2026"].hero_name is None


def test_returning_players(built):
    rows = {r.recency_window: r for r in built.mart_returning_player_proxy.collect()}
    old, new = rows["2023_2024"], rows["2025_2026"]
    assert tuple(old)[1:] == (2, 0, 2, Decimal(0))
    # Account 12 was seen before only outside the windows, so it is new.
    assert tuple(new)[1:] == (2, 1, 1, Decimal("0.5"))


def test_facts_may_pick_different_rows(spark):
    """Without an id in the pro payload, the match comes from the public row, its players do not.

    The summary asks for a target label on both rows, the hero mart on the match only.
    """
    nameless = {"start_time": NEW, "players": [player(0, 1, win=1)]}
    rows = [
        (1, "pro_matches", "outside_target_windows", nameless, DAY1),
        (1, "public_matches", "2025_2026", payload(1, NEW, [player(0, 2), player(1, 3)]), DAY1),
    ]
    lazy = Models(raw(spark, rows), heroes(spark, [({"id": 1}, DAY1)]))
    stored = lazy.with_core(lazy.dim_heroes, lazy.fct_match, lazy.fct_player_match)
    for models in (lazy, stored):
        assert models.mart_liveops_summary.count() == 0
        got = [(r.hero_window_key, r.hero_picks) for r in models.mart_hero_meta_shift.collect()]
        assert got == [("1-2025_2026", 1)]


def test_views(spark, built):
    built.register_views()
    assert spark.sql("select count(*) from fct_player_match").first()[0] == 7


def test_materialized_facts_join_without_a_shuffle(spark, built):
    saved = built.materialize_core("marts_test", buckets=4)
    rows = marts.player_match_rows(saved.fct_player_match, saved.fct_match, ("hero_id", "win"))
    plan = initial_plan(rows)
    assert "Exchange" not in plan
    assert "PartitionFilters: [recency_window IN" in plan
    for name in ("mart_hero_meta_shift", "mart_liveops_summary", "mart_returning_player_proxy"):
        lazy, stored = getattr(built, name), getattr(saved, name)
        assert sorted(map(str, lazy.collect())) == sorted(map(str, stored.collect()))


def test_facts_of_one_lineage_join_without_another_shuffle(built):
    """Raw rows are shuffled once per fact for the ranking; the join reuses that partitioning."""
    rows = marts.player_match_rows(built.fct_player_match, built.fct_match, ("hero_id",))
    plan = initial_plan(rows)
    assert plan.count("Exchange hashpartitioning(match_id") == 2
    assert "SortMergeJoin" in plan and "BroadcastExchange" not in plan


def test_matches_join_before_players_explode(built):
    """The rows are those of the fact join; the ranking's order serves the merge join."""
    columns = ("hero_id", "win")
    early = built.player_rows(*columns)
    late = marts.player_match_rows(built.fct_player_match, built.fct_match, columns)
    names = early.columns
    assert sorted(map(tuple, early.collect()), key=repr) == sorted(
        map(tuple, late.select(*names).collect()), key=repr
    )
    plan = initial_plan(early)
    assert plan.index("Generate explode(players)") < plan.index("SortMergeJoin")
    assert plan.count("Sort [") == 4  # two per ranking, none for the join


def test_heroes_are_counted_once(built):
    """Totals and metrics read the same shuffled counts."""
    mart = built.mart_hero_meta_shift
    mart.collect()
    final = mart._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange [hero_id" in final


def test_other_windows(spark):
    """Windows are parameters, whatever their labels look like."""
    from arenalake.config import Settings, Window
    from arenalake.operators.backfill import plan_backfill
    from arenalake.sources.schemas import MANIFEST

    settings = Settings(
        windows=(Window("2021.first", 1, 9), Window("2022-second half", 10, None)),
        previous_window="2021.first",
        current_window="2022-second half",
        quotas={"2021.first": 1, "2022-second half": 1},
        fill_order=("2022-second half", "2021.first"),
    )
    rows = [
        (1, "a", "2021.first", payload(1, 5, [player(0, 1, account_id=1, win=1)]), DAY1),
        (2, "a", "2022-second half", payload(2, 15, [player(0, 1, account_id=1)]), DAY1),
        (3, "a", "2023_2024", payload(3, OLD, [player(0, 1)]), DAY1),
    ]
    models = Models(raw(spark, rows), heroes(spark, [({"id": 1}, DAY1)]), settings)
    assert models.mart_hero_meta_shift.first().win_rate_delta_vs_prior_window == -1
    assert models.mart_liveops_summary.count() == 2
    accounts = {r.recency_window: r.returning_account_count for r in models.mart_returning_player_proxy.collect()}
    assert accounts == {"2021.first": 0, "2022-second half": 1}
    pages = spark.sql(
        """select 1L as page_no, parse_json('[{"match_id":1,"start_time":5},{"match_id":2,"start_time":6},
        {"match_id":3,"start_time":70}]') as entries"""
    )
    plan = plan_backfill(pages, spark.createDataFrame([], MANIFEST), settings=settings)
    assert sorted(r.match_id for r in plan.added.collect()) == [1, 3]
