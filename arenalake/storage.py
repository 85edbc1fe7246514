"""Where intermediate files live: the shared folder that the cluster names."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

_local_root: str | None = None


def shared_folder(spark: SparkSession) -> str:
    """The folder from ``spark.checkpoint.dir``; a temporary one only in local mode without it."""
    configured = spark.conf.get("spark.checkpoint.dir", "")
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    global _local_root
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="arenalake-")
        atexit.register(shutil.rmtree, _local_root, ignore_errors=True)
    return _local_root


def _app_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/arenalake/{spark.sparkContext.applicationId}"


def remove_app_files(spark: SparkSession) -> None:
    """Delete what this application put into the shared folder, when its results are taken."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(_app_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path nobody else writes to, grouped by application so that it can be cleaned up later."""
    return f"{_app_folder(spark)}/{label}-{uuid.uuid4().hex}"
