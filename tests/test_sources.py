import json

import pytest
from pyspark.sql import functions as F

from arenalake.operators import envelopes
from arenalake.registry import round_trips
from arenalake.sources import csv_files, json_files, sinks
from arenalake.sources.schemas import MANIFEST, MANIFEST_COLUMNS
from tests.conftest import SMALL

ENVELOPE = {
    "match_id": 1,
    "start_time": 1740000000,
    "source_stream": "pro_matches",
    "recency_window": "2025_2026",
    "ingested_at": "2026-01-01T00:00:00+00:00",
    "payload": {"match_id": 1, "start_time": 1740000000, "players": [{"player_slot": 0, "hero_id": 5}]},
}


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def lines(path, *records):
    return write(path, "\n\n".join(json.dumps(r) for r in records) + "\n   \n")


def test_blank_lines_are_skipped(spark, tmp_path):
    path = lines(tmp_path / "a.jsonl", ENVELOPE, {"match_id": 2})
    assert json_files.read_json_lines(spark, path).count() == 2


def test_raw_matches(spark, tmp_path):
    path = lines(tmp_path / "a.jsonl", ENVELOPE)
    rows = json_files.load_raw_matches(spark, path, "2026-02-01 10:00:00")
    assert dict(rows.dtypes)["raw_payload"] == "variant"
    row = rows.select("*", F.to_json("raw_payload").alias("text")).first()
    assert (row.match_id, row.source_stream, str(row.loaded_at)) == (1, "pro_matches", "2026-02-01 10:00:00")
    assert json.loads(row.text) == ENVELOPE["payload"]


@pytest.mark.parametrize("key", [*MANIFEST_COLUMNS, "payload"])
def test_a_missing_envelope_key_fails(spark, tmp_path, key):
    path = lines(tmp_path / "a.jsonl", {k: v for k, v in ENVELOPE.items() if k != key})
    with pytest.raises(Exception, match=f"envelope without {key}"):
        json_files.load_raw_matches(spark, path).collect()


def test_load_time_is_one_utc_time(spark, tmp_path):
    path = lines(tmp_path / "a.jsonl", ENVELOPE, ENVELOPE)
    rows = json_files.load_raw_matches(spark, path)
    assert rows.select("loaded_at").distinct().count() == 1
    assert dict(rows.dtypes)["loaded_at"] == "timestamp_ntz"


def test_missing_files_are_empty(spark, tmp_path):
    nowhere = str(tmp_path / "nowhere")
    assert json_files.load_raw_matches(spark, nowhere).count() == 0
    assert json_files.load_raw_hero_stats(spark, nowhere).count() == 0
    assert json_files.load_raw_pro_matches(spark, nowhere).count() == 0
    assert csv_files.read_manifest(spark, nowhere).count() == 0


HEROES = [
    {"id": 1, "localized_name": "One", "primary_attr": "agi", "attack_type": "Melee", "pro_pick": 4, "pro_win": 2, "roles": ["Carry"]},
    {"id": None, "localized_name": "Nobody"},
    {"id": 2, "localized_name": None},
]


def test_hero_array_document(spark, tmp_path):
    path = write(tmp_path / "h.json", json.dumps(HEROES, indent=2))
    rows = json_files.load_raw_hero_stats(spark, path)
    assert sorted(r.hero_id for r in rows.collect()) == [1, 2]
    checked = envelopes.hero_rows(json_files.read_json_array(spark, path))
    assert [tuple(r) for r in checked.collect()] == [(1, "One", "agi", "Melee", 4, 2)]


def test_raw_snapshot_is_not_filtered(spark, tmp_path):
    path = write(tmp_path / "h.json", json.dumps(HEROES, indent=2))
    records = json_files.read_json_array(spark, path)
    snapshot = str(tmp_path / "snapshot")
    assert json_files.read_snapshot(spark, snapshot).count() == 0
    sinks.write_records(records, snapshot)
    again = json_files.read_snapshot(spark, snapshot).select(F.to_json("record"))
    key = json.dumps
    got = [json.loads(r[0]) for r in again.collect()]
    assert sorted(map(key, got)) == sorted(key(dict(sorted(h.items()))) for h in HEROES)


def test_arrays_per_line(spark, tmp_path):
    path = write(tmp_path / "h.jsonl", json.dumps(HEROES) + "\n" + json.dumps([{"id": 7}]) + "\n")
    rows = json_files.load_raw_hero_stats(spark, path, one_array_per_line=True)
    assert sorted(r.hero_id for r in rows.collect()) == [1, 2, 7]


def test_pro_matches(spark, tmp_path):
    matches = [
        {"match_id": 1, "start_time": 1735689599},
        {"match_id": 2, "start_time": 1735689600},
        {"match_id": 3, "start_time": 1600000000},
        {"match_id": None, "start_time": 5},
        {"match_id": 4},
    ]
    path = write(tmp_path / "p.json", json.dumps(matches, indent=2))
    rows = json_files.load_raw_pro_matches(spark, path)
    assert sorted((r.match_id, r.recency_window) for r in rows.collect()) == [
        (1, "2023_2024"),
        (2, "2025_2026"),
        (3, "outside_target_windows"),
    ]


def normalized(spark, tmp_path, *records):
    path = lines(tmp_path / "n.jsonl", *records)
    return envelopes.normalize_envelopes(json_files.read_json_lines(spark, path))


def test_envelope_and_bare_payload(spark, tmp_path):
    bare = {"match_id": 2, "start_time": 1680000000, "source_stream": "ignored"}
    unlabelled = {"payload": {"match_id": 3}}
    rows = normalized(spark, tmp_path, ENVELOPE, bare, unlabelled)
    snapshot = envelopes.match_snapshot(rows)
    assert len(snapshot.columns) == 14
    got = sorted((r.match_id, r.source_stream, r.recency_window) for r in snapshot.collect())
    assert got == [
        (1, "pro_matches", "2025_2026"),
        (2, "unknown", "2023_2024"),
        (3, "unknown", "outside_target_windows"),
    ]


def test_player_snapshot_keeps_incomplete_players(spark, tmp_path):
    players = [{"player_slot": None, "hero_id": 0}, {"hero_id": None, "player_slot": 128}, {"player_slot": 127}]
    rows = envelopes.player_snapshot(normalized(spark, tmp_path, {"match_id": 1, "players": players}))
    assert len(rows.columns) == 16
    got = [(r.player_slot, r.hero_id, r.is_radiant) for r in rows.collect()]
    assert sorted(got, key=repr) == [(127, None, True), (128, None, False), (None, 0, True)]


def test_manifest_round_trip(spark, tmp_path):
    rows = [(1, 5, "pro_matches", "2023_2024"), (2, 6, "public_matches", "2025_2026")]
    sinks.write_manifest(spark.createDataFrame(rows, MANIFEST), str(tmp_path / "m"))
    assert sorted(map(tuple, csv_files.read_manifest(spark, f"{tmp_path}/m/csv").collect())) == rows
    assert spark.read.schema(MANIFEST).json(f"{tmp_path}/m/json").count() == 2


def test_a_manifest_with_text_ids_fails(spark, tmp_path):
    path = write(tmp_path / "m.csv", ",".join(MANIFEST_COLUMNS) + "\none,5,pro_matches,x\n")
    with pytest.raises(Exception, match="not a whole number: one"):
        csv_files.read_manifest(spark, path).collect()


def test_manifest_columns_go_by_name(spark, tmp_path):
    path = write(tmp_path / "m.csv", "source_stream,extra,start_time,match_id\npro_matches,z,5,1\n")
    assert [tuple(r) for r in csv_files.read_manifest(spark, path).collect()] == [
        (1, 5, "pro_matches", None)
    ]
    empty = write(tmp_path / "e.csv", "")
    assert csv_files.read_manifest(spark, empty).count() == 0


def test_manifest_list_keeps_its_order(spark, tmp_path):
    from arenalake.operators.manifest import merge_manifests

    header = ",".join(MANIFEST_COLUMNS)
    first = write(tmp_path / "a.csv", f"{header}\n1,5,pro_matches,x\n2,5,pro_matches,p\n2,5,pro_matches,q\n")
    second = write(tmp_path / "b.csv", f"{header}\n1,5,pro_matches,y\n")
    for paths, label in ((f"{first}, {second} ,", "y"), (f"{second},{first}", "x")):
        merged = merge_manifests(csv_files.read_manifests(spark, paths))
        got = {r.match_id: r.recency_window for r in merged.collect()}
        assert got == {1: label, 2: "q"}
    assert csv_files.split_paths(" a , ,b,") == ["a", "b"]


def test_export_order_and_quotes(spark, tmp_path):
    rows = [(2, "2025_2026", '["Carry","Escape"]'), (10, "2023_2024", None), (2, "2023_2024", "a")]
    mart = spark.createDataFrame(rows, "hero_id bigint, recency_window string, role_list string")
    path = sinks.export_mart(mart, "mart_hero_meta_shift", str(tmp_path))
    parts = sorted((tmp_path / "mart_hero_meta_shift.csv").glob("part-*"))
    body = [line for part in parts for line in part.read_text().splitlines()]
    header = "HERO_ID,RECENCY_WINDOW,ROLE_LIST"
    assert [line for line in body if line != header] == [
        "2,2023_2024,a",
        '2,2025_2026,"[""Carry"",""Escape""]"',
        "10,2023_2024,",
    ]
    back = csv_files.read_export(spark, path)
    assert back.columns == header.split(",") and back.count() == 3


def test_empty_snapshot_keeps_its_header(spark, tmp_path):
    sinks.write_snapshot_csv(spark.createDataFrame([], MANIFEST), str(tmp_path / "s"))
    assert csv_files.read_export(spark, str(tmp_path / "s")).columns == list(MANIFEST_COLUMNS)


def test_raw_tables(spark, tmp_path):
    sinks.ensure_raw_tables(spark, "raw_test")
    sinks.ensure_raw_tables(spark, "raw_test")
    rows = json_files.load_raw_matches(spark, lines(tmp_path / "a.jsonl", ENVELOPE), "2026-01-01")
    table = "raw_test.raw_matches"
    sinks.append_raw(rows, "raw_test", "raw_matches")
    sinks.append_raw(rows, "raw_test", "raw_matches")
    assert spark.table(table).count() == 2
    sinks.append_raw(rows, "raw_test", "raw_matches", replace=True)
    assert spark.table(table).count() == 1
    payload = F.variant_get("raw_payload", "$.players[0].hero_id", "int")
    assert spark.table(table).select(payload).first()[0] == 5
    sinks.truncate_raw_tables(spark, "raw_test")
    assert spark.table(table).count() == 0


def test_text_survives_csv(spark, tmp_path):
    names = [" Axe ", 'a "quoted", b', "two\nlines", "\t", None]
    rows = spark.createDataFrame(list(enumerate(names)), "hero_id long, hero_name string")
    path = sinks.export_mart(rows.withColumn("recency_window", F.lit("w")), "mart_hero_meta_shift", str(tmp_path))
    back = csv_files.read_export(spark, path).select("HERO_ID", "HERO_NAME").collect()
    assert {int(r.HERO_ID): r.HERO_NAME for r in back} == dict(enumerate(names))
    sinks.write_snapshot_csv(rows, str(tmp_path / "snapshot"))
    back = csv_files.read_export(spark, str(tmp_path / "snapshot")).collect()
    assert {int(r.hero_id): r.hero_name for r in back} == dict(enumerate(names))


def test_each_file_of_a_folder_has_its_own_header(spark, tmp_path):
    folder = tmp_path / "manifests"
    folder.mkdir()
    (folder / "a.csv").write_text("match_id,start_time,source_stream,recency_window\n1,10,s,w\n")
    (folder / "b.csv").write_text("start_time,recency_window,match_id\n20,w,2\n30,v,3\n")
    for rows in (csv_files.read_manifest(spark, str(folder)), csv_files.read_manifests(spark, [str(folder)])):
        found = sorted(tuple(r) for r in rows.select(*MANIFEST_COLUMNS).collect())
        assert found == [(1, 10, "s", "w"), (2, 20, None, "w"), (3, 30, None, "v")]


def test_one_envelope_per_manifest_row(spark):
    manifest = spark.createDataFrame([(1, 5, "s", "w"), (2, 6, "s", "w")], MANIFEST)
    payloads = spark.sql(
        """SELECT id AS match_id, at, parse_json(p) AS payload FROM VALUES
           (1L, 2, '{"d": 2}'), (1L, 1, '{"d": 1}'), (1L, 1, '{"d": 1}'), (3L, 1, '{"d": 9}') AS t(id, at, p)"""
    )
    built = envelopes.build_envelopes(manifest, payloads, F.lit("now"), order=[F.col("at")])
    found = built.select("match_id", F.variant_get("payload", "$.d", "int").alias("d")).collect()
    assert [tuple(r) for r in found] == [(1, 1)]


def test_envelope_lines_land_compressed_in_files_of_bounded_length(spark, tmp_path, monkeypatch):
    rows = spark.range(250).select(F.col("id").alias("match_id"), F.lit("w").alias("recency_window"))
    sinks.write_json_lines(rows.coalesce(1), str(tmp_path / "lines"), 100)
    files = list((tmp_path / "lines").glob("part-*"))
    assert len(files) == 3 and all(f.name.endswith(".json.gz") for f in files)
    back = json_files.read_json_lines(spark, str(tmp_path / "lines"))
    found = back.select(F.variant_get("record", "$.match_id", "long"), F.variant_get("record", "$.recency_window", "string"))
    assert sorted(map(tuple, found.collect())) == [(k, "w") for k in range(250)]
    monkeypatch.setattr(round_trips, "fresh_path", lambda spark, label: str(tmp_path / label))
    assert round_trips.sink_envelopes(spark, SMALL).count() > 0
    files = list((tmp_path / "envelopes").glob("part-*"))
    assert files and all(f.name.endswith(".json.gz") for f in files)
