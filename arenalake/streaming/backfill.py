"""Resumable backfill over landed page files.

The stream checkpoint tells which files were taken. Each batch adds the bounds and first sightings
of its pages to the run's state and selects anew over the state of the whole run, in page order,
so the rows do not depend on how many files a batch has or in which order they come. A run is a
checkpoint; the matches of other runs in the same manifest count as selected before. A batch
whose pages all lie behind the page that met the last quota changes nothing and is skipped.
Everything a batch writes is overwritten when it is replayed.

The state is kept in parts that are merged by levels. A merged part of sightings holds what can
still be selected, at most the sum of the quotas for each window. So a batch reads the last few batches
and that many rows of each merged part, whose number grows with the logarithm of the batches. Bounds
stay one short row a page. Runs into one manifest take turns.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from arenalake.config import DEFAULTS, Settings
from arenalake.operators.backfill import (
    candidates,
    choose,
    joined_sightings,
    page_bounds,
    selected_index,
    sightings,
)
from arenalake.sources.json_files import explode_pages
from arenalake.sources.schemas import MANIFEST, MANIFEST_COLUMNS
from arenalake.sources.sinks import write_progress
from arenalake.streaming.levels import Levels, read_if_there

_PARTS = f"{MANIFEST}, run string"
_REACHED = "until bigint, full boolean"


def read_backfill_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The manifest so far, with the run that selected each row."""
    return read_if_there(spark, path, _PARTS)


def run_name(checkpoint: str) -> str:
    return "r" + hashlib.sha256(checkpoint.encode()).hexdigest()[:12]


def stream_backfill(
    spark: SparkSession,
    pages: str,
    manifest: str,
    progress: str,
    checkpoint: str,
    *,
    state: str,
    cursor: int | None = None,
    quotas: Mapping[str, int] | None = None,
    settings: Settings = DEFAULTS,
    max_files_per_batch: int = 60,
    fan_in: int = 8,
) -> StreamingQuery:
    """Take all pending page files (lines of ``{page_no, entries}``) in batches, then stop.

    ``state`` is a folder for the runs' pages. ``cursor`` is where the run started. ``fan_in`` parts
    of the state are merged into one of the next level.
    """
    run = run_name(checkpoint)
    own = f"{state}/{run}"

    def take(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        reached = read_if_there(session, f"{own}/reached", _REACHED, "json").first()
        if reached and reached["full"]:
            first_page = batch.agg(F.min("page_no")).first()[0]
            if first_page is None or first_page > reached["until"]:
                return
        earlier = read_backfill_manifest(session, manifest).where(F.col("run") != run)
        known = selected_index(earlier)
        limits = settings.quotas if quotas is None else quotas

        def first_seen(parts: DataFrame) -> DataFrame:
            return candidates(joined_sightings(parts, settings), known, limits, settings)

        seen = sightings(explode_pages(batch), settings)
        bounds = Levels(session, f"{own}/bounds", lambda parts: parts, fan_in).add(page_bounds(batch), batch_id)
        stored = Levels(session, f"{own}/seen", first_seen, fan_in).add(seen, batch_id)
        chosen = choose(
            bounds, joined_sightings(stored, settings), known, quotas=quotas, settings=settings, cursor=cursor
        )
        rows = chosen.added.select(*MANIFEST_COLUMNS)
        rows.write.mode("overwrite").parquet(f"{manifest}/run={run}")
        write_progress(chosen.progress, f"{progress}/run={run}")
        session.createDataFrame([(chosen.until, chosen.full)], _REACHED).write.mode("overwrite").json(
            f"{own}/reached"
        )

    stream = (
        spark.readStream.schema("page_no bigint, entries variant")
        .option("maxFilesPerTrigger", max_files_per_batch)
        .json(pages)
    )
    return (
        stream.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
