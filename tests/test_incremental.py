"""Facts and marts kept up load by load equal a rebuild."""

import json

import pytest
from pyspark.sql import functions as F

from arenalake.plans import core
from arenalake.plans.models import Models
from arenalake.registry import queries as q
from arenalake.sources.schemas import RAW_TABLES
from arenalake.streaming import incremental
from arenalake.streaming.incremental import Store, stream_core
from tests.conftest import SMALL, initial_plan


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


def assert_equals_rebuild(store, raw, heroes):
    models = Models(raw, heroes)
    pairs = {
        "matches": (store.matches(), models.fct_match),
        "players": (store.players(), models.fct_player_match),
        "hero": (store.hero_meta_shift(models.dim_heroes), models.mart_hero_meta_shift),
        "liveops": (store.liveops_summary(), models.mart_liveops_summary),
        "returning": (store.returning_players(), models.mart_returning_player_proxy),
    }
    for name, (found, expected) in pairs.items():
        assert found.columns == expected.columns, name
        assert rows_of(found) == rows_of(expected), name


def test_loads_in_any_order_equal_a_rebuild(spark, tmp_path):
    raw, heroes = q.raw_matches(spark, SMALL), q.raw_hero_stats(spark, SMALL)
    part = F.pmod(F.xxhash64("match_id", "loaded_at", "source_stream"), F.lit(2))
    loads = [raw.where(part == k) for k in (1, 0)]
    store = Store(spark, str(tmp_path / "a"), span=500, buckets=4)
    for batch, load in enumerate(loads):
        assert store.apply(load, batch)
    # A replay, and the rows of a load that come again under another number, change nothing.
    before = rows_of(store.liveops_summary())
    assert not store.apply(loads[0], 1)
    assert store.apply(loads[1], 3)
    assert rows_of(store.liveops_summary()) == before
    assert store.vacuum() > 0 and store.vacuum() == 0
    assert_equals_rebuild(store, raw, heroes)


def match(match_id, loaded, stream="public_matches", window="2025_2026", start=1740000000, players=((1, 10, 1),), payload_id=True):
    listed = [{"player_slot": k, "hero_id": h, "account_id": a, "win": w} for k, (h, a, w) in enumerate(players)]
    payload = {"start_time": start, "duration": 1800, "radiant_win": True, "patch": 50, "players": listed}
    if payload_id:
        payload["match_id"] = match_id
    return match_id, start, stream, window, json.dumps(payload), f"2026-01-0{loaded} 00:00:00"


def raw_of(spark, rows):
    frame = spark.createDataFrame(rows, "match_id long, start_time long, source_stream string, recency_window string, p string, at string")
    columns = F.parse_json("p").alias("raw_payload"), F.col("at").cast("timestamp_ntz").alias("loaded_at")
    return frame.select("match_id", "start_time", "source_stream", "recency_window", *columns)


def test_changed_winners_are_taken_back(spark, tmp_path):
    """The first appearance of an account goes with the row it came from; a window loses all its keys."""
    early = 1680000000
    loads = [
        [match(1, 1, window="2023_2024", start=early, players=[(1, 10, 1), (2, 11, 0)]), match(2, 1, players=[(1, 10, 0), (3, None, 1)])],
        [match(1, 2, window="outside_target_windows", start=early - 9**9, players=[(1, 10, 1)]), match(3, 2, payload_id=False)],
        [match(1, 1, stream="pro_matches", window="2025_2026", players=[(5, 12, 1)]), match(2, 3, players=[])],
        [match(4, 1, window=None), match(5, 1, window="2023_2024", start=early + 5, players=[(1, 12, 1)])],
    ]
    heroes = spark.createDataFrame([], RAW_TABLES["raw_hero_stats"])
    store = Store(spark, str(tmp_path / "a"), span=2, buckets=2)
    for batch in range(len(loads)):
        store.apply(raw_of(spark, loads[batch]), batch)
        assert_equals_rebuild(store, raw_of(spark, [r for load in loads[: batch + 1] for r in load]), heroes)
    empty = Store(spark, str(tmp_path / "b"))
    assert empty.matches().count() == 0 and empty.liveops_summary().count() == 0
    assert empty.apply(raw_of(spark, []), 0) and not empty.apply(raw_of(spark, []), 0)


def test_a_load_reads_the_ranges_it_touches(spark, tmp_path):
    store = Store(spark, str(tmp_path / "a"), span=10, buckets=2)
    store.apply(raw_of(spark, [match(k, 1) for k in range(100)]), 0)
    store.apply(raw_of(spark, [match(995, 1), match(7, 2)]), 1)
    log = {(r["table"], r["bucket"], r["batch"]) for r in store._log().collect()}
    assert {b for t, b, n in log if t == "matches" and n == 1} == {0, 99}
    plan = store.rows("matches", "match_id bigint", [0])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_stream_into_the_store(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()

    def land(name, rows):
        lines = []
        for match_id, start, stream, window, payload, _ in rows:
            lines.append(json.dumps({"match_id": match_id, "start_time": start, "source_stream": stream, "recency_window": window, "ingested_at": "x", "payload": json.loads(payload)}))
        (landing / name).write_text("\n".join(lines))

    store = Store(spark, str(tmp_path / "store"))
    rows = [match(1, 1), match(2, 1, players=[(3, 9, 1)]), match(1, 1, stream="pro_matches", players=[(4, 8, 0)])]
    for k, row in enumerate(rows):
        land(f"{k}.json", [row])
    options = {"loaded_at": "2026-01-01 00:00:00", "max_files_per_batch": 1}
    stream_core(store, str(landing), str(tmp_path / "checkpoint"), **options).awaitTermination()
    heroes = spark.createDataFrame([], RAW_TABLES["raw_hero_stats"])
    assert_equals_rebuild(store, raw_of(spark, rows), heroes)
    rows.append(match(3, 1, players=[(4, 9, 1)]))
    land("more.json", rows[-1:])
    stream_core(store, str(landing), str(tmp_path / "checkpoint"), **options).awaitTermination()
    assert_equals_rebuild(store, raw_of(spark, rows), heroes)


def test_a_load_ranks_in_one_shuffle_and_stores_what_changed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(incremental, "CROWDED", 1)  # ids with two rows in a load are ranked first
    store = Store(spark, str(tmp_path / "a"), span=10, buckets=2)
    first = [match(k, 1, window="2025_2026") for k in range(5)] + [match(2, 2, window="2025_2026")]
    second = [match(3, 1, window="2025_2026"), match(7, 1, window="2025_2026", players=[(1, 12, 1)])]
    store.apply(raw_of(spark, first), 0)
    store.apply(raw_of(spark, second), 1)
    changed = spark.read.parquet(f"{store.root}/changed/batch=1")
    assert [tuple(r) for r in changed.select("match_id", "sign").collect()] == [(7, 1)]
    models = Models(raw_of(spark, first + second), spark.createDataFrame([], RAW_TABLES["raw_hero_stats"]))
    assert rows_of(store.matches()) == rows_of(models.fct_match)
    assert rows_of(store.players()) == rows_of(models.fct_player_match)
    load = core.typed_payloads(raw_of(spark, first))
    plan = initial_plan(store._chosen(store.payloads([0]), load, core.preferred_payloads))
    before_write = plan[: plan.index("Union")]
    assert before_write.count("Exchange") == 1 and "Exchange hashpartitioning(bucket" in before_write
