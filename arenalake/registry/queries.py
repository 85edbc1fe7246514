"""One callable per operator: ``(spark, sf_dir) -> DataFrame``, over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from arenalake.functions.payload import has_key, players
from arenalake.functions.windows import epoch_to_ntz
from arenalake.operators import backfill, contracts, distinct, envelopes, manifest, quality
from arenalake.plans import core, dashboards, marts
from arenalake.plans.models import Models
from arenalake.registry.landing import landed_lines, landed_table
from arenalake.sources import csv_files, feed, json_files, sinks
from arenalake.sources.schemas import MANIFEST_COLUMNS, RAW_TABLES
from arenalake.sources.tables import read_table
from arenalake.storage import fresh_path
from arenalake.streaming import backfill as backfill_stream
from arenalake.streaming.raw_ingest import stream_raw_matches

Query = Callable[[SparkSession, str], DataFrame]

LOADED_AT = "2026-01-01 00:00:00"
TOP_HEROES = 5
PUBLIC_LIMIT = 200
DETAIL_LIMIT = 800
HIGH_USAGE_FROM = 0.005
SIZE_BOUND = 1000
SAVED_CURSOR = 8123456789
#: Documents of a landed, compressed file: some 75 MB of text.
LINES_PER_FILE = 50_000
# The matches of the first month of 2023 count as selected before the backfill starts.
SELECTED_SPAN = (1672531200, 1675209599)

ORDER_TABLES = ("orders", "lineitem")


def present(rows: DataFrame) -> DataFrame:
    """Result types that every engine prints alike: decimals as doubles, dates as text."""
    columns = []
    for field in rows.schema:
        column = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, (T.DateType, T.TimestampNTZType)):
            column = column.cast("string")
        columns.append(column.alias(field.name))
    return rows.select(*columns)


# Inputs. Marts and their parts run lazily from the raw tables. Checks and exports read stored
# models, because that is what they are about.


def raw_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = RAW_TABLES["raw_matches"]
    return landed_table(spark, sf_dir, "raw_matches", ORDER_TABLES, feed.raw_matches, schema)


def raw_hero_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = RAW_TABLES["raw_hero_stats"]
    return landed_table(
        spark, sf_dir, "raw_hero_stats", ("supplier",), feed.raw_hero_stats, schema
    )


def models(spark: SparkSession, sf_dir: str) -> Models:
    return Models(raw_matches(spark, sf_dir), raw_hero_stats(spark, sf_dir))


MODEL_TABLES = (*ORDER_TABLES, "supplier")


def _stored(spark: SparkSession, sf_dir: str, name: str, build: Query) -> DataFrame:
    return landed_table(spark, sf_dir, name, MODEL_TABLES, build)


def stored_core(spark: SparkSession, sf_dir: str) -> Models:
    """The models on top of the stored dimension and facts."""
    names = ("dim_heroes", "fct_match", "fct_player_match")
    return models(spark, sf_dir).with_core(
        *[_stored(spark, sf_dir, name, _model(name)) for name in names]
    )


def stored_mart(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    def build(session: SparkSession, folder: str) -> DataFrame:
        return getattr(stored_core(session, folder), name)

    return _stored(spark, sf_dir, name, build)


def stored_models(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Staging views, stored core and stored marts by name."""
    named = stored_core(spark, sf_dir).named()
    for name in sinks.EXPORT_ORDER:
        named[name] = stored_mart(spark, sf_dir, name)
    return named


def _mixed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    build = partial(feed.envelope_lines, with_legacy=True)
    path = landed_lines(spark, sf_dir, "detail_lines", ORDER_TABLES, build, LINES_PER_FILE)
    return json_files.read_json_lines(spark, path)


def _hero_records(spark: SparkSession, sf_dir: str) -> str:
    return landed_lines(spark, sf_dir, "hero_arrays", ("supplier",), feed.hero_array_lines)


def _page_files(spark: SparkSession, sf_dir: str) -> str:
    return landed_lines(spark, sf_dir, "pages", ("orders",), feed.page_lines)


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return json_files.read_pages(spark, _page_files(spark, sf_dir))


def _entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return json_files.explode_pages(_pages(spark, sf_dir))


def _manifest_files(spark: SparkSession, sf_dir: str) -> str:
    paths = []
    for stream in ("public_matches", "pro_matches"):
        path = fresh_path(spark, f"manifest-{stream}")
        sinks.write_manifest(feed.manifest(spark, sf_dir, stream), path)
        paths.append(f"{path}/csv")
    return " , ".join(paths)


def _merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    streams = ("public_matches", "pro_matches")
    return manifest.merge_manifests(
        manifest.concat_manifests([feed.manifest(spark, sf_dir, s) for s in streams])
    )


def _details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Available details: all loads that have players, of which some matches have several."""
    rows = raw_matches(spark, sf_dir).where(has_key(F.col("raw_payload"), "players"))
    return rows.select("match_id", "loaded_at", F.col("raw_payload").alias("payload"))


# Scans and loads


def scan_jsonl_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    record = F.col("record")
    return _mixed_lines(spark, sf_dir).select(
        has_key(record, "payload").alias("is_envelope"),
        F.variant_get(record, "$.match_id", "bigint").alias("match_id"),
        F.variant_get(record, "$.source_stream", "string").alias("source_stream"),
        F.variant_get(record, "$.payload.duration", "bigint").alias("payload_duration"),
    )


def _envelope_files(spark: SparkSession, sf_dir: str) -> str:
    build = partial(feed.envelope_lines, with_legacy=False)
    return landed_lines(spark, sf_dir, "envelopes", ORDER_TABLES, build, LINES_PER_FILE)


def load_raw_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = json_files.load_raw_matches(spark, _envelope_files(spark, sf_dir), LOADED_AT)
    return _loaded(rows)


def _loaded(raw: DataFrame) -> DataFrame:
    payload = F.col("raw_payload")
    return raw.select(
        *MANIFEST_COLUMNS,
        F.variant_get(payload, "$.duration", "bigint").alias("payload_duration"),
        F.array_size(players(payload, ("hero_id",))).cast("bigint").alias("player_count"),
        "loaded_at",
    )


def load_raw_hero_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = json_files.load_raw_hero_stats(
        spark, _hero_records(spark, sf_dir), LOADED_AT, one_array_per_line=True
    )
    payload = F.col("raw_payload")
    return rows.select(
        "hero_id",
        F.variant_get(payload, "$.localized_name", "string").alias("hero_name"),
        F.variant_get(payload, "$.roles", "string").alias("role_list"),
        "loaded_at",
    )


def load_raw_pro_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    def arrays(session: SparkSession, folder: str) -> DataFrame:
        return feed.pro_pages(session, folder).select(F.to_json("entries").alias("value"))

    path = landed_lines(spark, sf_dir, "pro_arrays", ("orders",), arrays)
    rows = json_files.load_raw_pro_matches(spark, path, LOADED_AT)
    return rows.drop("raw_payload")


def scan_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "manifest")
    sinks.write_manifest(feed.manifest(spark, sf_dir, "pro_matches"), path)
    return csv_files.read_manifest(spark, f"{path}/csv")


def envelope_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    built = envelopes.build_envelopes(
        _merged(spark, sf_dir),
        _details(spark, sf_dir),
        F.lit(feed.INGESTED_AT),
        order=[F.col("loaded_at").asc_nulls_last()],
    )
    duration = F.variant_get("payload", "$.duration", "bigint")
    return built.select(
        *MANIFEST_COLUMNS, "ingested_at", duration.alias("payload_duration")
    )


def missing_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelopes.missing_payloads(_merged(spark, sf_dir), _details(spark, sf_dir))


def normalize_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelopes.normalize_envelopes(_mixed_lines(spark, sf_dir)).select(
        "source_stream",
        "recency_window",
        F.variant_get("payload", "$.match_id", "bigint").alias("match_id"),
        F.variant_get("payload", "$.start_time", "bigint").alias("start_time"),
    )


def match_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelopes.match_snapshot(envelopes.normalize_envelopes(_mixed_lines(spark, sf_dir)))


def player_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelopes.player_snapshot(envelopes.normalize_envelopes(_mixed_lines(spark, sf_dir)))


def hero_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _hero_records(spark, sf_dir)
    return envelopes.hero_rows(json_files.read_json_array(spark, path, one_array_per_line=True))


def size_admission(spark: SparkSession, sf_dir: str) -> DataFrame:
    """German documents have no known size."""
    documents = read_table(spark, sf_dir, "documents")
    sized = documents.select(
        "doc_id", F.when(F.col("lang") != "de", F.col("n_chars")).alias("size")
    )
    return manifest.admit_resources(sized, "size", SIZE_BOUND)


# Manifests


def manifest_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = manifest.manifest_rows(_entries(spark, sf_dir), "pro_matches")
    return rows.select(*MANIFEST_COLUMNS)


def dedupe_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.dedupe_matches(_entries(spark, sf_dir))


def dedupe_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.public_manifest(_entries(spark, sf_dir), PUBLIC_LIMIT)


def manifest_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = csv_files.read_manifests(spark, _manifest_files(spark, sf_dir))
    return manifest.newest_first(manifest.merge_manifests(rows))


def manifest_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.newest_manifest(_merged(spark, sf_dir), DETAIL_LIMIT)


def _backfill(spark: SparkSession, sf_dir: str) -> backfill.Backfill:
    before = feed.manifest(spark, sf_dir, "pro_matches")
    before = before.where(F.col("start_time").between(*SELECTED_SPAN))
    return backfill.plan_backfill(_pages(spark, sf_dir), before, cursor=SAVED_CURSOR)


def backfill_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backfill.backfill_order(_backfill(spark, sf_dir).selected)


def backfill_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backfill.selected_counts(_backfill(spark, sf_dir).selected)


def page_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backfill.page_bounds(_pages(spark, sf_dir))


def backfill_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    progress = _backfill(spark, sf_dir).progress
    labels = ("2023_2024", "2025_2026")
    counts = [
        F.col(f"{kind}_counts_by_window")[w].alias(f"{kind}_{w}")
        for kind in ("selected", "target")
        for w in labels
    ]
    return progress.select(
        *counts,
        *[c for c in progress.columns if not c.endswith("_counts_by_window")],
    )


# Streams over the landed files


def stream_raw_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw table after a stream has taken all envelope files."""
    folder = fresh_path(spark, "raw-stream")
    stream_raw_matches(
        spark,
        _envelope_files(spark, sf_dir),
        f"{folder}/table",
        f"{folder}/checkpoint",
        loaded_at=LOADED_AT,
    ).awaitTermination()
    return _loaded(spark.read.schema(RAW_TABLES["raw_matches"]).parquet(f"{folder}/table"))


def _backfill_stream(spark: SparkSession, sf_dir: str) -> str:
    """The folder of a backfill stream that took the page files in several batches."""
    folder = fresh_path(spark, "backfill-stream")
    backfill_stream.stream_backfill(
        spark,
        _page_files(spark, sf_dir),
        f"{folder}/manifest",
        f"{folder}/progress",
        f"{folder}/checkpoint",
        state=f"{folder}/state",
        max_files_per_batch=3,
    ).awaitTermination()
    return folder


def stream_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _backfill_stream(spark, sf_dir)
    return backfill_stream.read_backfill_manifest(spark, f"{folder}/manifest").drop("run")


def stream_backfill_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _backfill_stream(spark, sf_dir)
    return spark.read.json(f"{folder}/progress").select(
        "next_less_than_match_id", "request_count", "completed_all_targets"
    )


# Models


def _model(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return getattr(models(spark, sf_dir), name)

    return query


def selected_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = core.selected_payloads(raw_matches(spark, sf_dir))
    count = F.coalesce(F.array_size("players"), F.lit(0)).cast("bigint")
    return rows.withColumn("player_count", count).drop("players")


def _player_rows(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return models(spark, sf_dir).player_rows(*columns)


def player_match_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The join of the two facts."""
    m = models(spark, sf_dir)
    columns = ("player_match_key", "account_id", "hero_id", "win")
    return marts.player_match_rows(m.fct_player_match, m.fct_match, columns)


def target_window_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = marts.in_target_windows(models(spark, sf_dir).match_fact("start_time"))
    return rows.select("match_id", "recency_window", "start_time")


# Marts and their parts


def window_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.window_totals(_player_rows(spark, sf_dir))


def distinct_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.distinct_counts(_player_rows(spark, sf_dir, "account_id", "hero_id"))


def merged_distinct_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts of whole windows from words that were stored per window and day."""
    rows = _player_rows(spark, sf_dir, "account_id", "hero_id")
    day = F.to_date(epoch_to_ntz(F.col("start_time"))).alias("match_date")
    daily = rows.select("recency_window", day, *marts.DISTINCT_COUNTS)
    stored = _written(distinct.key_words(daily, ("recency_window", "match_date"), list(marts.DISTINCT_COUNTS)), "words")
    window = ("recency_window",)
    merged = distinct.merge_words(stored, window)
    return distinct.counts_of_words(merged, window, marts.DISTINCT_COUNTS, "player_row_count")


def approximate_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Estimates from stored daily sketches beside the exact counts: are they within the stated error?"""
    rows = _player_rows(spark, sf_dir, "account_id", "hero_id")
    size = 12
    stored = _written(marts.usage_sketches(rows, size), "sketches")
    both = marts.distinct_counts(rows).join(marts.approximate_counts(stored), "recency_window")
    bound = distinct.sketch_error(size)

    def within(estimated: str, exact: str):
        return F.abs(F.col(estimated) - F.col(exact)) <= F.col(exact) * bound

    return both.select(
        "recency_window",
        *marts.DISTINCT_COUNTS.values(),
        within("known_account_estimate", "known_account_count").alias("accounts_within"),
        within("hero_estimate", "distinct_hero_count").alias("heroes_within"),
        (F.col("sketch_bytes") <= 2**size + 64).alias("bytes_bounded"),
    )


def _written(rows: DataFrame, label: str) -> DataFrame:
    path = fresh_path(rows.sparkSession, label)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def hero_win_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.hero_window_metrics(_player_rows(spark, sf_dir, "hero_id", "win"))


def hero_pick_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.hero_pick_rates(_player_rows(spark, sf_dir, "hero_id", "win"))


def hero_window_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.hero_window_pivot(_player_rows(spark, sf_dir, "hero_id", "win"))


def hero_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.hero_deltas(_player_rows(spark, sf_dir, "hero_id", "win"))


def first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.first_seen(_player_rows(spark, sf_dir, "account_id"))


def account_window_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.account_window_status(_player_rows(spark, sf_dir, "account_id"))


# Quality. The feed has records that break some rules, and some rules are stricter than the
# suite's, so that the counts are not all zero.


def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.check_not_null(stored_models(spark, sf_dir))


def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = {"stg_matches": "match_id", "stg_hero_stats": "hero_id", **quality.UNIQUE}
    return quality.check_unique(stored_models(spark, sf_dir), keys)


def dq_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.check_relationships(stored_models(spark, sf_dir))


def dq_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    stricter = (("fct_match", "recency_window", ("2023_2024", "2025_2026")),)
    rules = stricter + quality.accepted_values()
    return quality.check_accepted_values(stored_models(spark, sf_dir), rules)


# Exports and their contract


def _export(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        mart = stored_mart(spark, sf_dir, name)
        path = sinks.export_mart(mart, name, fresh_path(spark, "export"))
        return csv_files.read_export(spark, path)

    return query


def _incomplete_exports(spark: SparkSession, sf_dir: str) -> str:
    """Exports with faults: no previous window, a missing column, and so no current deltas."""
    mart = partial(stored_mart, spark, sf_dir)
    folder = fresh_path(spark, "incomplete")
    current = F.col("recency_window") == "2025_2026"
    previous = F.col("recency_window") == "2023_2024"
    summary = mart("mart_liveops_summary").where(current).drop("patch_count", "league_count")
    sinks.export_mart(summary, "mart_liveops_summary", folder)
    returning = mart("mart_returning_player_proxy")
    sinks.export_mart(returning, "mart_returning_player_proxy", folder)
    heroes = mart("mart_hero_meta_shift").where(previous).drop("attack_type")
    sinks.export_mart(heroes, "mart_hero_meta_shift", folder)
    return folder


def _complete_exports(spark: SparkSession, sf_dir: str) -> str:
    folder = fresh_path(spark, "complete")
    for name in sinks.EXPORT_ORDER:
        sinks.export_mart(stored_mart(spark, sf_dir, name), name, folder)
    return folder


def _each_export(spark: SparkSession, sf_dir: str):
    folder = _incomplete_exports(spark, sf_dir)
    for name in contracts.REQUIRED_COLUMNS:
        yield name, csv_files.read_export(spark, f"{folder}/{name}.csv")


def _union(parts: list[DataFrame]) -> DataFrame:
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows


def validate_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _union(
        [
            export.agg(F.count("*").alias("row_count")).select(
                F.lit(name).alias("mart"),
                "row_count",
                F.lit(",".join(contracts.missing_columns(export, name))).alias("missing_columns"),
            )
            for name, export in _each_export(spark, sf_dir)
        ]
    )


def validate_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _union(
        [
            contracts.missing_windows(export).select(
                F.lit(name).alias("mart"),
                F.array_join("missing_windows", ",").alias("missing_windows"),
            )
            for name, export in _each_export(spark, sf_dir)
        ]
    )


def validate_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The complete hero export has populated deltas; one without the current window has none."""
    rows = []
    for folder in (_complete_exports(spark, sf_dir), _incomplete_exports(spark, sf_dir)):
        export = csv_files.read_export(spark, f"{folder}/{contracts.HERO_MART}.csv")
        rows.append(
            contracts.complete_deltas(export).withColumn(
                "export", F.lit(folder.rsplit("/", 1)[-1].split("-")[0])
            )
        )
    return _union(rows)


def validation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = []
    for folder in (_complete_exports(spark, sf_dir), _incomplete_exports(spark, sf_dir)):
        report = contracts.validation_report(spark, folder)
        rows.append(
            report.select(
                F.lit(folder.rsplit("/", 1)[-1].split("-")[0]).alias("export"),
                F.array_join("target_windows", ",").alias("target_windows"),
                "is_valid",
                F.array_join("errors", " | ").alias("errors"),
            )
        )
    return _union(rows)


# Dashboards


def dashboard_kpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboards.kpi_cards(models(spark, sf_dir).mart_liveops_summary)


def window_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = models(spark, sf_dir)
    return dashboards.window_summary(m.mart_liveops_summary, m.mart_returning_player_proxy)


def _heroes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models(spark, sf_dir).mart_hero_meta_shift


def delta_scatter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboards.delta_scatter(
        _heroes(spark, sf_dir),
        windows=["2025_2026"],
        attributes=["str", "agi"],
        attack_types=["Melee"],
        segments=["watchlist", "volatile"],
    )


def volatility_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboards.volatility_ranked(_heroes(spark, sf_dir))


def volatility_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboards.volatility_ranks(_heroes(spark, sf_dir))


def segment_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboards.segment_topk(_heroes(spark, sf_dir), TOP_HEROES, windows=["2025_2026"])


def action_quadrant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboards.action_quadrant(_heroes(spark, sf_dir))


def recommended_action(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboards.action_board(
        _heroes(spark, sf_dir), HIGH_USAGE_FROM, windows=["2025_2026"]
    )


_QUERIES: dict[str, Query] = {
    "scan_jsonl_payloads": scan_jsonl_payloads,
    "load_raw_matches": load_raw_matches,
    "load_raw_hero_stats": load_raw_hero_stats,
    "load_raw_pro_matches": load_raw_pro_matches,
    "scan_manifest": scan_manifest,
    "explode_pages": _entries,
    "envelope_build": envelope_build,
    "missing_payloads": missing_payloads,
    "normalize_envelopes": normalize_envelopes,
    "match_snapshot": match_snapshot,
    "player_snapshot": player_snapshot,
    "hero_rows": hero_rows,
    "size_admission": size_admission,
    "manifest_rows": manifest_rows,
    "dedupe_matches": dedupe_matches,
    "dedupe_limit": dedupe_limit,
    "manifest_union": manifest_union,
    "manifest_topk": manifest_topk,
    "backfill_select": backfill_select,
    "backfill_counts": backfill_counts,
    "page_bounds": page_bounds,
    "backfill_progress": backfill_progress,
    "stream_raw_ingest": stream_raw_ingest,
    "stream_backfill": stream_backfill,
    "stream_backfill_progress": stream_backfill_progress,
    "stg_matches": _model("stg_matches"),
    "stg_hero_stats": _model("stg_hero_stats"),
    "dim_heroes": _model("dim_heroes"),
    "fct_match": _model("fct_match"),
    "selected_payloads": selected_payloads,
    "fct_player_match": _model("fct_player_match"),
    "player_match_join": player_match_join,
    "target_window_filter": target_window_filter,
    "window_totals": window_totals,
    "distinct_counts": distinct_counts,
    "merged_distinct_counts": merged_distinct_counts,
    "approximate_counts": approximate_counts,
    "hero_win_rate": hero_win_rate,
    "hero_pick_rate": hero_pick_rate,
    "hero_window_pivot": hero_window_pivot,
    "hero_deltas": hero_deltas,
    "hero_meta_shift": _model("mart_hero_meta_shift"),
    "liveops_summary": _model("mart_liveops_summary"),
    "first_seen": first_seen,
    "account_window_status": account_window_status,
    "returning_players": _model("mart_returning_player_proxy"),
    "dq_not_null": dq_not_null,
    "dq_unique": dq_unique,
    "dq_relationships": dq_relationships,
    "dq_accepted_values": dq_accepted_values,
    "validate_columns": validate_columns,
    "validate_windows": validate_windows,
    "validate_deltas": validate_deltas,
    "validation_report": validation_report,
    "export_liveops_summary": _export("mart_liveops_summary"),
    "export_hero_meta_shift": _export("mart_hero_meta_shift"),
    "export_returning_players": _export("mart_returning_player_proxy"),
    "dashboard_kpi": dashboard_kpi,
    "window_summary": window_summary,
    "delta_scatter": delta_scatter,
    "volatility_ranked": volatility_ranked,
    "volatility_ranks": volatility_ranks,
    "segment_topk": segment_topk,
    "action_quadrant": action_quadrant,
    "recommended_action": recommended_action,
}


def presented(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return present(query(spark, sf_dir))

    return run


def all_queries() -> dict[str, Query]:
    return {name: presented(query) for name, query in _QUERIES.items()}
