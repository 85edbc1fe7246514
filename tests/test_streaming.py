import json
import random

import pytest
from pyspark.sql import functions as F

from arenalake.operators.backfill import candidates, choose, nth_places
from arenalake.sources.schemas import MANIFEST
from arenalake.streaming.backfill import read_backfill_manifest, stream_backfill
from arenalake.streaming.levels import Levels
from arenalake.streaming.raw_ingest import stream_raw_matches


def envelope(match_id):
    return json.dumps(
        {
            "match_id": match_id,
            "start_time": 1740000000,
            "source_stream": "pro_matches",
            "recency_window": "2025_2026",
            "ingested_at": "2026-01-01T00:00:00+00:00",
            "payload": {"match_id": match_id},
        }
    )


def test_raw_ingest_takes_each_file_once(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()

    def run():
        stream_raw_matches(
            spark,
            str(landing),
            str(tmp_path / "raw"),
            str(tmp_path / "checkpoint"),
            loaded_at="2026-01-01 00:00:00",
        ).awaitTermination()
        return sorted(r.match_id for r in spark.read.parquet(str(tmp_path / "raw")).collect())

    (landing / "a.jsonl").write_text(envelope(1) + "\n" + envelope(2))
    assert run() == [1, 2]
    (landing / "b.jsonl").write_text(envelope(3))
    assert run() == [1, 2, 3]
    assert run() == [1, 2, 3]


def page(number, *entries):
    rows = [{"match_id": m, "start_time": t} for m, t in entries]
    return json.dumps({"page_no": number, "entries": rows})


def test_backfill_resumes_and_stops_at_the_quotas(spark, tmp_path):
    pages = tmp_path / "pages"
    pages.mkdir()
    now, before = 1740000000, 1680000000
    manifest, progress = str(tmp_path / "manifest"), str(tmp_path / "progress")

    def run():
        stream_backfill(
            spark,
            str(pages),
            manifest,
            progress,
            str(tmp_path / "checkpoint"),
            state=str(tmp_path / "state"),
            quotas={"2025_2026": 2, "2023_2024": 2},
            max_files_per_batch=1,
        ).awaitTermination()
        return sorted(r.match_id for r in read_backfill_manifest(spark, manifest).collect())

    (pages / "1.json").write_text(page(1, (9, now), (8, before)))
    assert run() == [8, 9]
    (pages / "2.json").write_text(page(2, (9, now), (7, now), (6, now)))
    assert run() == [7, 8, 9]
    (pages / "3.json").write_text(page(3, (5, before), (4, before)))
    (pages / "4.json").write_text(page(4, (3, before), (2, now)))
    assert run() == [5, 7, 8, 9]
    last = spark.read.json(progress).first()
    assert last.completed_all_targets


def backfilled(spark, root, pages, files, per_batch, run="checkpoint", **options):
    stream_backfill(
        spark, str(pages), f"{root}/manifest", f"{root}/progress", f"{root}/{run}", state=f"{root}/state",
        max_files_per_batch=per_batch, **options,
    ).awaitTermination()
    return sorted((r.match_id, r.start_time, r.recency_window) for r in read_backfill_manifest(spark, f"{root}/manifest").collect())


def test_backfill_does_not_depend_on_batches(spark, tmp_path):
    pages = tmp_path / "pages"
    pages.mkdir()
    now, before = 1740000000, 1680000000
    for n in (5, 2, 7, 1, 6, 3, 4):  # files come in another order than pages
        starts = [(100 * n + k, (now, before)[(n + k) % 3 == 0]) for k in range(6)]
        starts.append((100 * (n % 4), now + n))  # seen on several pages
        (pages / f"{n}.json").write_text(page(n, *starts))
    (pages / "8.json").write_text(page(8))  # an empty page ends the paging
    (pages / "9.json").write_text(page(9, (950, now)))
    quotas = {"2025_2026": 17, "2023_2024": 30}
    found, last = [], []
    for per_batch in (1, 2, 100):
        root = tmp_path / f"n{per_batch}"
        found.append(backfilled(spark, root, pages, 9, per_batch, quotas=quotas, cursor=12345))
        last.append(spark.read.json(f"{root}/progress").drop("run").first().asDict(recursive=True))
    assert found[0] == found[1] == found[2] and last[0] == last[1] == last[2]
    assert 950 not in {m for m, _, _ in found[0]} and sum(w == "2025_2026" for _, _, w in found[0]) == 17
    assert last[0]["request_count"] == 8 and not last[0]["completed_all_targets"]


def test_new_checkpoint_goes_on_with_the_old_manifest(spark, tmp_path):
    now = 1740000000
    first, second = tmp_path / "first", tmp_path / "second"
    for folder in (first, second):
        folder.mkdir()
    (first / "1.json").write_text(page(1, (1, now), (2, now)))
    (second / "1.json").write_text(page(1, (2, now), (3, now), (4, now)))
    quotas = {"2025_2026": 3}
    assert len(backfilled(spark, tmp_path, first, 1, 1, "one", quotas=quotas)) == 2
    both = backfilled(spark, tmp_path, second, 1, 1, "two", quotas=quotas)
    assert [m for m, _, _ in both] == [1, 2, 3]


def test_filled_batch_writes_nothing(spark, tmp_path):
    now = 1740000000
    pages = tmp_path / "pages"
    pages.mkdir()
    (pages / "1.json").write_text(page(1, (1, now), (2, now)))
    quotas = {"2025_2026": 1}
    backfilled(spark, tmp_path, pages, 1, 1, quotas=quotas)
    (pages / "2.json").write_text(page(2, (3, now)))
    assert [m for m, _, _ in backfilled(spark, tmp_path, pages, 1, 1, quotas=quotas)] == [1]
    assert {p.name for p in (tmp_path / "state").glob("*/seen/batch=*")} == {"batch=0"}


def test_merged_state_selects_the_same_rows_and_stays_small(spark, tmp_path):
    """Many batches, merged by twos: rows of one batch over all pages, in parts that count by the digits of the batches."""
    pages = tmp_path / "pages"
    pages.mkdir()
    now, before = 1740000000, 1680000000
    order = [4, 1, 6, 3, 2, 5]  # files come in another order than pages
    for n in order:
        starts = [(10 * n + k, (now, before)[(n * k) % 3 == 0]) for k in range(8)]
        starts.append((10 * (n % 4 + 1), (before, now)[n % 2]))  # the same match under the other window
        (pages / f"{n}.json").write_text(page(n, *starts))
    quotas = {"2025_2026": 7, "2023_2024": 4}
    one, many = tmp_path / "one", tmp_path / "many"
    at_once = backfilled(spark, one, pages, 6, 100, quotas=quotas)
    assert len(at_once) == 11
    assert backfilled(spark, many, pages, 6, 1, quotas=quotas, fan_in=2) == at_once
    assert spark.read.json(f"{one}/progress").drop("run").collect() == spark.read.json(f"{many}/progress").drop("run").collect()


@pytest.mark.parametrize("fan_in", [2, 3])
def test_levels_hold_every_batch_once(spark, tmp_path, fan_in):
    skipped = {3, 7, 8}

    def summed(rows):
        return rows.groupBy("k").agg(F.sum("n").alias("n"))

    levels = Levels(spark, str(tmp_path / "state"), summed, fan_in)
    taken = []
    for n in range(10):
        if n in skipped:
            continue
        rows = spark.createDataFrame([("all", 1), (f"b{n}", 1)], "k string, n bigint")
        for _ in range(1 + n % 2):  # every other batch is replayed
            counted = {r.k: r.n for r in summed(levels.add(rows, n)).collect()}
        taken.append(n)
        assert counted == {"all": len(taken), **{f"b{m}": 1 for m in taken}}
        assert len(levels.parts(n)) <= (fan_in - 1) * 4
    folders = [p for p in (tmp_path / "state").glob("batch=*")]
    assert len(folders) < len(taken)  # merged parts are gone


def test_candidates_are_bounded_and_enough(spark):
    """What is kept of any split of the sightings gives the choice over all of them."""
    pick = random.Random(3)
    quotas = {"2025_2026": 3, "2023_2024": 4}
    a, b = quotas
    schema = f"match_id bigint, `at {b}` bigint, `start {b}` bigint, `at {a}` bigint, `start {a}` bigint"
    bounds = spark.createDataFrame([(p, 5, 1, 1, 1) for p in range(1, 9)], "page_no bigint, entry_count bigint, next_less_than_match_id bigint, oldest_start_time bigint, newest_start_time bigint")
    for _ in range(2):
        rows, places = [], pick.sample(range(1 << 32, 9 << 32), 120)
        for m in range(60):
            first, second = places.pop(), places.pop()
            rows.append((m, *((first, 1) if pick.random() < 0.7 else (None, None)), *((second, 2) if pick.random() < 0.7 else (None, None))))
        known = spark.createDataFrame([(m, 1, "pro_matches", pick.choice([a, b])) for m in pick.sample(range(60), 2)], MANIFEST)
        whole = spark.createDataFrame(rows, schema)
        kept = [candidates(spark.createDataFrame(rows[i::2], schema), known, quotas) for i in range(2)]
        assert all(k.count() <= 2 * 7 for k in kept)
        want = choose(bounds, whole, known, quotas=quotas).added
        got = choose(bounds, kept[0].unionByName(kept[1]), known, quotas=quotas).added
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_nth_places_are_those_of_a_sort(spark):
    pick = random.Random(5)
    places = {w: sorted(pick.sample(range(-50, 1 << 40), 300) + [7, 7, 7]) for w in "xyz"}
    rows = spark.createDataFrame([(w, at) for w, found in places.items() for at in found] + [(None, None), ("x", None)], "label string, at bigint")
    for bins, ranks in ((8, (150,)), (4096, (1, 2, 303))):
        for rank in ranks:
            assert nth_places(rows, {"x": rank, "y": 304, "z": 5}, bins) == {"x": places["x"][rank - 1], "z": places["z"][4]}
    assert nth_places(rows, {"none": 1}) == {}
