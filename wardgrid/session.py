"""Session settings the operators are written for."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "true",
    # else it follows the cores registered at that moment, and two readings of a file may be cut differently
    "spark.sql.files.minPartitionNum": "256",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "wardgrid", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings above; ``extra`` uses ``__`` for dots in keys."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in extra.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: the one the cluster names.

    Only a local session without ``spark.checkpoint.dir`` gets a temporary
    folder; on a cluster an unset folder is an error, because a machine-local
    path would be lost together with its machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    fallback = os.path.join(tempfile.mkdtemp(prefix="wardgrid-"), "shared")
    spark.conf.set("spark.checkpoint.dir", fallback)
    return fallback
