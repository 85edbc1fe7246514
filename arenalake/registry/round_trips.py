"""Queries that write with a sink and return what is read back; their SQL is that of the rows written."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from arenalake.operators import envelopes, quality
from arenalake.registry import queries as q
from arenalake.registry.landing import landed
from arenalake.sources import csv_files, feed, json_files, sinks
from arenalake.sources.schemas import MANIFEST, MANIFEST_COLUMNS
from arenalake.storage import fresh_path
from arenalake.streaming.incremental import Store


def _kept(rows: DataFrame, schema: str) -> DataFrame:
    """The rows in the shared folder, so that the schema they came from can be dropped."""
    spark = rows.sparkSession
    path = fresh_path(spark, schema)
    rows.write.parquet(path)
    spark.sql(f"DROP SCHEMA {schema} CASCADE")
    return spark.read.schema(rows.schema).parquet(path)


def _schema_name(label: str) -> str:
    return f"{label}_{uuid.uuid4().hex[:12]}"


def sink_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "envelopes")
    built = envelopes.build_envelopes(
        q._merged(spark, sf_dir),
        q._details(spark, sf_dir),
        F.lit(feed.INGESTED_AT),
        order=[F.col("loaded_at").asc_nulls_last()],
    )
    sinks.write_json_lines(built, path, q.LINES_PER_FILE)
    record = F.col("record")
    kinds = {"match_id": "bigint", "start_time": "bigint"}
    return json_files.read_json_lines(spark, path).select(
        *[
            F.variant_get(record, f"$.{name}", kinds.get(name, "string")).alias(name)
            for name in (*MANIFEST_COLUMNS, "ingested_at")
        ],
        F.variant_get(record, "$.payload.duration", "bigint").alias("payload_duration"),
    )


def sink_match_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "snapshot")
    rows = q.match_snapshot(spark, sf_dir)
    sinks.write_snapshot_csv(rows, path)
    back = csv_files.read_export(spark, path)
    return back.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in rows.schema])


def sink_manifest_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "manifest")
    sinks.write_manifest(feed.manifest(spark, sf_dir, "pro_matches"), path)
    return spark.read.schema(MANIFEST).json(f"{path}/json")


def sink_hero_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "hero-records")
    records = json_files.read_json_array(spark, q._hero_records(spark, sf_dir), one_array_per_line=True)
    sinks.write_records(records, path)
    return envelopes.hero_rows(json_files.read_snapshot(spark, path))


def sink_raw_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw table after an append and a load that replaces it."""
    schema = _schema_name("raw")
    rows = json_files.load_raw_matches(spark, q._envelope_files(spark, sf_dir), q.LOADED_AT)
    sinks.ensure_raw_tables(spark, schema)
    sinks.append_raw(rows, schema, "raw_matches")
    sinks.append_raw(rows, schema, "raw_matches", replace=True)
    return _kept(q._loaded(spark.table(f"{schema}.raw_matches")), schema)


def sink_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "progress")
    rows = q.backfill_progress(spark, sf_dir)
    sinks.write_progress(rows, path)
    return spark.read.schema(rows.schema).json(path)


def sink_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "report")
    rows = q.validation_report(spark, sf_dir)
    sinks.write_report(rows, path)
    return spark.read.schema(rows.schema).json(path)


def dq_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All data checks, as the step of a run stores them."""
    path = fresh_path(spark, "checks")
    quality.run_checks(q.stored_models(spark, sf_dir)).write.json(path)
    return spark.read.schema("check_name string, model string, column_name string, failures bigint").json(path)


def model_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    q.models(spark, sf_dir).register_views()
    return spark.table("stg_matches")


def core_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = _schema_name("core")
    stored = q.models(spark, sf_dir).materialize_core(schema, buckets=8)
    return _kept(stored.fct_match, schema)


# Facts and marts that follow the loads


def _store(spark: SparkSession, sf_dir: str) -> Store:
    """A store that took the raw table in two loads, mixed by match and load time, and the first one twice."""
    def write(path: str) -> None:
        raw = q.raw_matches(spark, sf_dir)
        part = F.pmod(F.xxhash64("match_id", "loaded_at"), F.lit(2))
        store = Store(spark, f"{path}-tables")
        for batch, k in enumerate((1, 0)):
            store.apply(raw.where(part == k), batch)
        store.apply(raw.where(part == 1), 0)
        spark.createDataFrame([("done",)], "value string").write.text(path)

    return Store(spark, landed(spark, sf_dir, "incremental", q.ORDER_TABLES, write) + "-tables")


def incremental_fct_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _store(spark, sf_dir).matches()


def incremental_fct_player_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _store(spark, sf_dir).players()


def incremental_hero_meta_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _store(spark, sf_dir).hero_meta_shift(q.models(spark, sf_dir).dim_heroes)


def incremental_liveops_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _store(spark, sf_dir).liveops_summary()


def incremental_returning_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _store(spark, sf_dir).returning_players()


#: Each query with the key whose SQL checks it.
ROUND_TRIPS: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str]] = {
    "sink_envelopes": (sink_envelopes, "envelope_build"),
    "sink_match_snapshot": (sink_match_snapshot, "match_snapshot"),
    "sink_manifest_json": (sink_manifest_json, "scan_manifest"),
    "sink_hero_records": (sink_hero_records, "hero_rows"),
    "sink_raw_tables": (sink_raw_tables, "load_raw_matches"),
    "dq_suite": (dq_suite, "dq_suite"),
    "sink_progress": (sink_progress, "backfill_progress"),
    "sink_report": (sink_report, "validation_report"),
    "model_views": (model_views, "stg_matches"),
    "core_tables": (core_tables, "fct_match"),
    "incremental_fct_match": (incremental_fct_match, "fct_match"),
    "incremental_fct_player_match": (incremental_fct_player_match, "fct_player_match"),
    "incremental_hero_meta_shift": (incremental_hero_meta_shift, "hero_meta_shift"),
    "incremental_liveops_summary": (incremental_liveops_summary, "liveops_summary"),
    "incremental_returning_players": (incremental_returning_players, "returning_players"),
}
