"""The steps of a run in order: select matches, wrap payloads, load, export, validate."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from arenalake.config import DEFAULTS, Settings
from arenalake.operators.backfill import backfill_order, page_bounds, plan_backfill
from arenalake.operators.contracts import validation_report
from arenalake.operators.envelopes import (
    build_envelopes,
    hero_rows,
    match_snapshot,
    normalize_envelopes,
    player_snapshot,
)
from arenalake.operators.manifest import merge_manifests, newest_manifest, public_manifest
from arenalake.operators.quality import run_checks
from arenalake.plans.models import Models
from arenalake.sources.csv_files import read_manifests
from arenalake.sources.json_arrays import read_split_arrays
from arenalake.sources.json_files import (
    explode_pages,
    load_raw_hero_stats,
    load_raw_matches,
    load_raw_pro_matches,
    read_cursor,
    read_json_lines,
    read_pages,
    read_snapshot,
    utc_now,
)
from arenalake.sources.schemas import MANIFEST
from arenalake.sources.sinks import (
    EXPORT_ORDER,
    append_raw,
    ensure_raw_tables,
    export_mart,
    write_json_lines,
    write_manifest,
    write_progress,
    write_records,
    write_report,
    write_snapshot_csv,
)


def public_slice(
    spark: SparkSession, pages_path: str, target: str, *, limit: int | None = None, settings: Settings = DEFAULTS
) -> None:
    """Write the manifest of the public matches of the landed pages, or of the first ``limit``."""
    entries = explode_pages(read_pages(spark, pages_path))
    write_manifest(public_manifest(entries, limit, settings), f"{target}/manifest")


def unread_pages(pages: DataFrame, cursor: int | None) -> DataFrame:
    """Pages from the first one that reaches below the cursor. Pages run from new ids to old."""
    if cursor is None:
        return pages
    below = page_bounds(pages).where(F.col("next_less_than_match_id") < cursor)
    return pages.where(F.col("page_no") >= below.agg(F.min("page_no")).scalar())


def pro_backfill(
    spark: SparkSession,
    pages_path: str,
    target: str,
    *,
    previous: str | None = None,
    cursor: int | None = None,
    quotas: Mapping[str, int] | None = None,
    max_pages: int | None = None,
    settings: Settings = DEFAULTS,
) -> DataFrame:
    """One bounded backfill run: writes manifest, raw entries and progress to ``target``.

    ``previous`` is the target of the run to resume, which must be another folder. Its manifest
    counts against the quotas, its entries stay in the raw snapshot, and its cursor tells where to
    go on unless ``cursor`` is given. Returns the stored progress.
    """
    known = spark.createDataFrame([], MANIFEST)
    if previous:
        known = read_manifests(spark, [f"{previous}/manifest/csv"])
        cursor = read_cursor(spark, f"{previous}/progress") if cursor is None else cursor
    pages = unread_pages(read_pages(spark, pages_path), cursor)
    plan = plan_backfill(
        pages, known, quotas=quotas, settings=settings, max_pages=max_pages, cursor=cursor
    )
    write_manifest(backfill_order(plan.selected), f"{target}/manifest")
    raw = plan.read_entries
    if previous:
        raw = spark.read.schema(raw.schema).json(f"{previous}/raw").unionByName(raw)
    write_json_lines(raw, f"{target}/raw")
    write_progress(plan.progress, f"{target}/progress")
    return spark.read.json(f"{target}/progress")


def normalize_details(
    spark: SparkSession, path: str, matches: str, players: str, settings: Settings = DEFAULTS
) -> None:
    """Match and player snapshots as CSV from envelope or bare payload lines."""
    rows = normalize_envelopes(read_json_lines(spark, path), settings)
    write_snapshot_csv(match_snapshot(rows), matches)
    write_snapshot_csv(player_snapshot(rows, settings), players)


def detail_envelopes(
    spark: SparkSession,
    manifest_paths: str,
    payloads: DataFrame,
    path: str,
    *,
    limit: int | None = None,
    ingested_at: Column | None = None,
    settings: Settings = DEFAULTS,
) -> None:
    """Write the envelopes of the newest manifest matches whose payload is there."""
    manifest = merge_manifests(read_manifests(spark, manifest_paths), settings)
    if limit is not None:
        manifest = newest_manifest(manifest, limit)
    if ingested_at is None:
        ingested_at = F.date_format(utc_now(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
    write_json_lines(build_envelopes(manifest, payloads, ingested_at), path)


def load_raw(
    spark: SparkSession,
    schema: str,
    *,
    match_details: str,
    hero_stats: str,
    pro_matches: str,
    replace: bool = False,
    loaded_at: datetime | str | None = None,
    settings: Settings = DEFAULTS,
) -> dict[str, dict[str, int]]:
    """Append the landed files to the raw tables, or replace their content.

    Missing files count as empty; array files may have any size. Returns for each table the number of rows
    written and of nulls by column, counted by the write.
    """
    ensure_raw_tables(spark, schema)
    loads = {
        "raw_matches": load_raw_matches(spark, match_details, loaded_at),
        "raw_hero_stats": load_raw_hero_stats(spark, hero_stats, loaded_at),
        "raw_pro_matches": load_raw_pro_matches(spark, pro_matches, loaded_at, settings=settings),
    }
    return {name: append_raw(rows, schema, name, replace=replace) for name, rows in loads.items()}


def hero_snapshot(spark: SparkSession, source: str, snapshot: str) -> DataFrame:
    """Store the hero records as they came, and return the checked rows of those with id and name."""
    write_records(read_split_arrays(spark, source), snapshot)
    return hero_rows(read_snapshot(spark, snapshot))


def check_models(models: Models, path: str) -> bool:
    """Run all data checks, store their failure counts, and tell whether there are none."""
    run_checks(models.named()).write.mode("overwrite").json(path)
    spark = models.raw_matches.sparkSession
    return spark.read.schema("failures bigint").json(path).where("failures > 0").isEmpty()


def models_of(spark: SparkSession, schema: str, settings: Settings = DEFAULTS) -> Models:
    """The models over the raw tables of a schema."""
    return Models(
        spark.table(f"{schema}.raw_matches"), spark.table(f"{schema}.raw_hero_stats"), settings
    )


def export_and_validate(models: Models, directory: str, report_path: str) -> bool:
    """Export the marts, check the contract on the files, store the report; true if valid."""
    for name in EXPORT_ORDER:
        export_mart(getattr(models, name), name, directory)
    spark = models.raw_matches.sparkSession
    return write_report(validation_report(spark, directory, models.settings), report_path)
