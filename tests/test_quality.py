from arenalake.operators import contracts, quality
from arenalake.sources import sinks

SUMMARY_COLUMNS = [c.lower() for c in contracts.REQUIRED_COLUMNS["mart_liveops_summary"]]
RETURNING_COLUMNS = [c.lower() for c in contracts.REQUIRED_COLUMNS["mart_returning_player_proxy"]]
HERO_COLUMNS = [c.lower() for c in contracts.REQUIRED_COLUMNS["mart_hero_meta_shift"]]
BOTH = ("2023_2024", "2025_2026")
PREFIX = "mart_hero_meta_shift.csv does not contain a 2025_2026 hero row with populated"
NO_DELTAS = f"{PREFIX} prior/current delta fields."


def test_violations(spark):
    rows = spark.createDataFrame([("a", "x"), ("a", None), (None, "y"), ("b", "z")], "k string, v string")
    parents = spark.createDataFrame([("a",)], "id string")
    assert quality.null_rows(rows, "v").count() == 1
    assert [tuple(r) for r in quality.duplicate_keys(rows, "k").collect()] == [("a", 2)]
    assert [tuple(r) for r in quality.orphan_keys(rows, "k", parents, "id").collect()] == [("b", 1)]
    assert [r.v for r in quality.unexpected_rows(rows, "v", ["x", "y"]).collect()] == ["z"]


def test_suite_size(spark):
    assert sum(map(len, quality.NOT_NULL.values())) == 16
    assert len(quality.UNIQUE) == 6
    assert len(quality.RELATIONSHIPS) == 3
    assert len(quality.accepted_values()) == 4


def test_orphans_are_counted_in_rows(spark):
    models = {
        "child": spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int"),
        "parent": spark.createDataFrame([(2,)], "k int"),
    }
    counts = quality.check_relationships(models, (("child", "k", "parent", "k"),))
    assert [r.failures for r in counts.collect()] == [2]


def text_rows(spark, columns, windows, **values):
    rows = [tuple(w if c == "recency_window" else values.get(c, "1") for c in columns) for w in windows]
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns))


def exports(spark, folder, summary=BOTH, returning=BOTH, heroes=BOTH, **hero_values):
    folder = str(folder)
    tables = {
        "mart_liveops_summary": text_rows(spark, SUMMARY_COLUMNS, summary),
        "mart_returning_player_proxy": text_rows(spark, RETURNING_COLUMNS, returning),
        "mart_hero_meta_shift": text_rows(spark, HERO_COLUMNS, heroes, **hero_values),
    }
    for name, table in tables.items():
        sinks.export_mart(table, name, folder)
    return folder


def test_complete_exports_pass(spark, tmp_path):
    report = contracts.validation_report(spark, exports(spark, tmp_path)).first()
    assert report.is_valid and report.errors == []
    assert report.target_windows == list(BOTH)


def test_missing_window_fails(spark, tmp_path):
    folder = exports(spark, tmp_path, summary=("2025_2026",))
    report = contracts.validation_report(spark, folder).first()
    assert not report.is_valid
    assert report.errors == ["mart_liveops_summary.csv is missing target windows: 2023_2024"]


def test_blank_deltas_fail(spark, tmp_path):
    folder = exports(spark, tmp_path, volatility_score="  ", stability_segment=None)
    assert contracts.validation_report(spark, folder).first().errors == [NO_DELTAS]


def test_one_window_sample_fails_in_every_mart(spark, tmp_path):
    now = ("2025_2026",)
    folder = exports(spark, tmp_path, now, now, now, volatility_score=None)
    errors = contracts.validation_report(spark, folder).first().errors
    assert errors == [
        "mart_liveops_summary.csv is missing target windows: 2023_2024",
        "mart_returning_player_proxy.csv is missing target windows: 2023_2024",
        "mart_hero_meta_shift.csv is missing target windows: 2023_2024",
        NO_DELTAS,
    ]


def test_missing_export_and_columns(spark, tmp_path):
    table = text_rows(spark, SUMMARY_COLUMNS, BOTH).drop("patch_count", "match_count")
    sinks.export_mart(table, "mart_liveops_summary", str(tmp_path))
    errors = contracts.validation_report(spark, str(tmp_path)).first().errors
    assert errors == [
        "mart_liveops_summary.csv is missing required columns: MATCH_COUNT, PATCH_COUNT",
        f"Missing exported mart: {tmp_path}/mart_returning_player_proxy.csv",
        f"Missing exported mart: {tmp_path}/mart_hero_meta_shift.csv",
    ]


def test_empty_export(spark, tmp_path):
    folder = tmp_path / "e"
    exports(spark, folder)
    empty = tmp_path / "empty"
    empty.mkdir()
    (empty / "mart_liveops_summary.csv").write_text("")
    first = contracts.validation_report(spark, str(empty)).first().errors[:2]
    assert first == [
        "mart_liveops_summary.csv is missing required columns: "
        + ", ".join(contracts.REQUIRED_COLUMNS["mart_liveops_summary"]),
        "mart_liveops_summary.csv is missing target windows: 2023_2024, 2025_2026",
    ]


def test_report_is_written(spark, tmp_path):
    report = contracts.validation_report(spark, exports(spark, tmp_path / "e"))
    assert sinks.write_report(report, str(tmp_path / "r")) is True
