"""A session with the settings the pipeline relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# UTC keeps calendar functions independent of the machine. AQE coalesces small shuffle
# partitions and splits skewed join partitions at run time.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}

# For a cluster: many small shuffle partitions, which AQE merges up to the advisory size, so one
# setting fits small and large inputs; larger scan splits, so that fewer tasks are scheduled.
CLUSTER_CONF = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
}


def build_session(app_name: str = "arenalake", master: str | None = None, **conf: str) -> SparkSession:
    """Extra settings use double underscores for dots: ``spark__sql__shuffle__partitions="8"``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in BASE_CONF.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
