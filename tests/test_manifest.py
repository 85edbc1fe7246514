from pyspark.sql import functions as F

from arenalake.operators import manifest
from arenalake.operators.backfill import backfill_order, page_bounds
from arenalake.operators.envelopes import build_envelopes, missing_payloads
from arenalake.sources.json_files import explode_pages
from arenalake.sources.schemas import MANIFEST, MANIFEST_COLUMNS
from tests.conftest import initial_plan, ranks_before_the_shuffle

ENTRY = "page_no bigint, pos int, match_id bigint, start_time bigint"
PRO = 1735689700


def pages(spark, *texts):
    rows = [(i, text) for i, text in enumerate(texts, start=1)]
    return spark.createDataFrame(rows, "page_no bigint, t string").select(
        "page_no", F.parse_json("t").alias("entries")
    )


def tuples(df):
    return [tuple(r) for r in df.collect()]


def test_newest_start_per_match(spark):
    rows = spark.createDataFrame([(1, 0, 1, 100), (1, 1, 1, 110), (1, 2, 2, 200)], ENTRY)
    assert sorted(tuples(manifest.dedupe_matches(rows))) == [(1, 110), (2, 200)]


def test_entries_without_keys_vanish(spark):
    text = '[{"match_id":1,"start_time":5},{"match_id":2},{"start_time":7},{"match_id":null,"start_time":8}]'
    entries = explode_pages(pages(spark, text))
    assert entries.count() == 4
    assert tuples(manifest.dedupe_matches(entries)) == [(1, 5)]


def test_limit_in_order_of_first_appearance(spark):
    rows = [(1, 0, 9, 100), (1, 1, 3, 100), (2, 0, 9, 900), (2, 1, 1, 100), (1, 2, 5, 100)]
    kept = manifest.dedupe_limit(spark.createDataFrame(rows, ENTRY), 3)
    assert sorted(tuples(kept)) == [(3, 100), (5, 100), (9, 900)]


def test_pro_stream_is_preferred(spark):
    public = spark.createDataFrame([(1, 900, "public_matches", "a")], MANIFEST)
    pro = spark.createDataFrame([(1, 100, "pro_matches", "a")], MANIFEST)
    for order in ([public, pro], [pro, public]):
        merged = manifest.merge_manifests(manifest.concat_manifests(order))
        assert tuples(merged) == [(1, 100, "pro_matches", "a")]


def test_newest_within_a_stream_and_later_input_on_ties(spark):
    first = spark.createDataFrame([(1, 100, "pro_matches", "x"), (2, 5, "pro_matches", "x")], MANIFEST)
    second = spark.createDataFrame([(1, 90, "pro_matches", "y"), (2, 5, "pro_matches", "y")], MANIFEST)
    merged = manifest.merge_manifests(manifest.concat_manifests([first, second]))
    assert sorted(tuples(merged)) == [(1, 100, "pro_matches", "x"), (2, 5, "pro_matches", "y")]


def test_unknown_streams_share_the_last_rank(spark):
    rows = [(1, 100, "odd", "a"), (1, 200, "unknown", "a"), (2, None, "pro_matches", "a")]
    merged = manifest.merge_manifests(
        manifest.concat_manifests([spark.createDataFrame(rows, MANIFEST)])
    )
    assert tuples(merged) == [(1, 200, "unknown", "a")]


def test_order_and_topk(spark):
    rows = [(1, 100, "s", "w"), (2, 300, "s", "w"), (3, 300, "s", "w"), (4, 200, "s", "w")]
    frame = spark.createDataFrame(rows, MANIFEST)
    assert [r[0] for r in tuples(manifest.newest_first(frame))] == [3, 2, 4, 1]
    top = manifest.newest_manifest(frame, 2)
    assert [r[0] for r in tuples(top)] == [3, 2]
    assert "TakeOrderedAndProject" in initial_plan(top)


def test_backfill_order(spark):
    rows = [(1, 5, "s", "2025_2026"), (2, 9, "s", "2025_2026"), (3, 1, "s", "2023_2024")]
    assert [r[0] for r in tuples(backfill_order(spark.createDataFrame(rows, MANIFEST)))] == [3, 2, 1]


def test_page_to_manifest_keeps_targets(spark):
    text = (
        '[{"match_id":1,"start_time":1735689700},{"match_id":2,"start_time":1609459200},'
        '{"match_id":3,"start_time":1704067200}]'
    )
    rows = manifest.manifest_rows(explode_pages(pages(spark, text)), "pro_matches")
    got = rows.orderBy("pos").select(*MANIFEST_COLUMNS)
    assert tuples(got) == [
        (1, 1735689700, "pro_matches", "2025_2026"),
        (3, 1704067200, "pro_matches", "2023_2024"),
    ]


def test_page_bounds(spark):
    text = '[{"match_id":1005,"start_time":7},{"match_id":1002},{"match_id":1009,"start_time":3}]'
    assert tuples(page_bounds(pages(spark, text, "[]", '[{"start_time":4}]'))) == [
        (1, 3, 1002, 3, 7),
        (2, 0, None, None, None),
        (3, 1, None, 4, 4),
    ]


def test_merge_keeps_one_row_per_task_before_the_shuffle(spark):
    rows = spark.createDataFrame([(i % 3, i, "a", "b") for i in range(9)], MANIFEST)
    merged = manifest.merge_manifests(manifest.concat_manifests([rows]))
    assert ranks_before_the_shuffle(merged, "match_id")


def test_envelopes(spark):
    rows = [(1, 5, "pro_matches", "w"), (2, 6, "pro_matches", "w")]
    frame = spark.createDataFrame(rows, MANIFEST)
    payloads = spark.sql("""select 1L as match_id, parse_json('{"a":1}') as payload""")
    built = build_envelopes(frame, payloads, F.lit("now"))
    assert built.columns == [*MANIFEST_COLUMNS, "ingested_at", "payload"]
    assert [r.match_id for r in built.collect()] == [1]
    assert [r.match_id for r in missing_payloads(frame, payloads).collect()] == [2]


def test_size_admission(spark):
    rows = spark.createDataFrame([("a", None), ("b", 10), ("c", 11)], "name string, size bigint")
    assert sorted(r.name for r in manifest.admit_resources(rows, "size", 10).collect()) == ["a", "b"]
