"""Incremental raw load: new envelope files are appended once, whatever restarts happen."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from arenalake.sources.json_files import load_time, require_values
from arenalake.sources.schemas import ENVELOPE, MANIFEST_COLUMNS


def stream_raw_matches(
    spark: SparkSession,
    landing: str,
    table_path: str,
    checkpoint: str,
    *,
    loaded_at: datetime | str | None = None,
    max_files_per_batch: int = 1000,
) -> StreamingQuery:
    """Append all landed files that no earlier run has taken, then stop."""
    envelopes = (
        spark.readStream.schema(ENVELOPE)
        .option("mode", "FAILFAST")
        .option("maxFilesPerTrigger", max_files_per_batch)
        .json(landing)
    )
    rows = require_values(envelopes, (*MANIFEST_COLUMNS, "payload")).select(
        *MANIFEST_COLUMNS,
        F.col("payload").alias("raw_payload"),
        load_time(loaded_at).alias("loaded_at"),
    )
    return (
        rows.writeStream.format("parquet")
        .option("path", table_path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
