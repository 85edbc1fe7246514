"""Manifests and payloads in, validated exports out."""

import json

from arenalake import workflow
from arenalake.operators.envelopes import missing_payloads
from arenalake.operators.manifest import concat_manifests, merge_manifests
from arenalake.registry import queries
from arenalake.sources import feed, sinks
from arenalake.sources.csv_files import read_export, read_manifest
from arenalake.sources.sinks import truncate_raw_tables
from tests.conftest import SMALL


def test_whole_run(spark, tmp_path):
    streams = ("public_matches", "pro_matches")
    manifests = [feed.manifest(spark, SMALL, stream) for stream in streams]
    for stream, rows in zip(streams, manifests):
        sinks.write_manifest(rows, str(tmp_path / stream))
    paths = ",".join(str(tmp_path / stream / "csv") for stream in streams)
    payloads = queries._details(spark, SMALL)
    details = str(tmp_path / "details")
    workflow.detail_envelopes(spark, paths, payloads, details, limit=None)

    heroes = str(tmp_path / "heroes")
    feed.hero_array_lines(spark, SMALL).write.text(heroes)
    schema = "workflow_test"
    for _ in range(2):
        counts = workflow.load_raw(
            spark,
            schema,
            match_details=details,
            hero_stats=heroes,
            pro_matches=str(tmp_path / "nowhere"),
            replace=True,
            loaded_at="2026-01-01 00:00:00",
        )
    models = workflow.models_of(spark, schema)
    merged = merge_manifests(concat_manifests(manifests))
    expected = merged.count() - missing_payloads(merged, payloads).count()
    assert models.raw_matches.count() == expected
    # The write has counted its rows and nulls.
    assert counts["raw_matches"]["rows"] == expected and counts["raw_pro_matches"]["rows"] == 0
    assert counts["raw_hero_stats"]["rows"] == models.raw_hero_stats.count() > 0
    assert counts["raw_matches"]["null match_id"] == 0
    labels = models.raw_matches.where("recency_window IS NULL").count()
    assert counts["raw_matches"]["null recency_window"] == labels
    checked = workflow.hero_snapshot(spark, heroes, str(tmp_path / "hero_snapshot"))
    assert 0 < checked.count() <= spark.read.text(str(tmp_path / "hero_snapshot")).count()

    models = models.materialize_core("workflow_core", buckets=4)
    models.register_views()
    rows = spark.sql("select sum(match_count) from mart_liveops_summary").first()
    targets = spark.table("workflow_core.fct_match").where("recency_window like '202%'")
    assert rows[0] == targets.count()

    valid = workflow.export_and_validate(models, str(tmp_path / "out"), str(tmp_path / "report"))
    assert valid
    assert spark.read.json(str(tmp_path / "report")).first().is_valid
    assert not workflow.check_models(models, str(tmp_path / "checks"))  # players without a known match or hero
    failed = spark.read.json(str(tmp_path / "checks")).where("failures > 0").collect()
    assert {r.check_name.split("_")[0] for r in failed} <= {"relationships", "not"}
    truncate_raw_tables(spark, schema)
    assert models.raw_matches.count() == 0
    assert not workflow.export_and_validate(
        workflow.models_of(spark, schema), str(tmp_path / "out"), str(tmp_path / "report")
    )



def land(path, *pages):
    rows = [
        json.dumps({"page_no": n, "entries": [{"match_id": m, "start_time": t} for m, t in page]})
        for n, page in enumerate(pages, start=1)
    ]
    path.write_text("\n".join(rows))
    return str(path)


def ids(rows):
    return sorted(r.match_id for r in rows.collect())


def test_backfill_runs_resume(spark, tmp_path):
    now, before = 1740000000, 1680000000
    pages = land(
        tmp_path / "pages.jsonl",
        [(9, now), (8, before)],
        [(7, now), (6, now)],
        [(5, before), (4, now)],
        [(3, before), (2, before)],
    )
    quotas = {"2025_2026": 3, "2023_2024": 3}
    first, second = str(tmp_path / "first"), str(tmp_path / "second")
    progress = workflow.pro_backfill(spark, pages, first, quotas=quotas, max_pages=2).first()
    assert (progress.request_count, progress.next_less_than_match_id) == (2, 6)
    assert progress.active_backfill_window == "2023_2024"
    progress = workflow.pro_backfill(spark, pages, second, previous=first, quotas=quotas).first()
    assert (progress.request_count, progress.completed_all_targets) == (2, True)
    manifest = read_manifest(spark, f"{second}/manifest/csv")
    assert ids(manifest) == [3, 5, 6, 7, 8, 9]
    assert spark.read.json(f"{second}/raw").count() == 8


def test_public_slice(spark, tmp_path):
    pages = land(tmp_path / "pages.jsonl", [(1, 5), (2, 6), (1, 9)], [(3, 7)])
    workflow.public_slice(spark, pages, str(tmp_path / "out"), limit=2)
    manifest = read_manifest(spark, str(tmp_path / "out" / "manifest" / "csv"))
    assert sorted(tuple(r)[:3] for r in manifest.collect()) == [
        (1, 9, "public_matches"),
        (2, 6, "public_matches"),
    ]


def test_normalized_snapshots(spark, tmp_path):
    lines = tmp_path / "details.jsonl"
    lines.write_text(json.dumps({"match_id": 4, "players": [{"hero_id": 1}, {"hero_id": 2}]}))
    matches, players = str(tmp_path / "matches"), str(tmp_path / "players")
    workflow.normalize_details(spark, str(lines), matches, players)
    assert read_export(spark, matches).first().match_id == "4"
    assert read_export(spark, players).count() == 2
