"""Let Python workers import this package where it isn't installed for them, bound their batches, and give freed memory back."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import SparkSession

ROOT = str(Path(__file__).resolve().parents[2])
#: Workers are kept for later stages; with these the arrays of a stage don't stay with them. A session's own values hold.
GIVE_BACK = {"ARROW_DEFAULT_MEMORY_POOL": "system", "MALLOC_ARENA_MAX": "1", "MALLOC_MMAP_THRESHOLD_": "1048576", "MALLOC_TRIM_THRESHOLD_": "4194304"}
#: Rows go to the workers in batches of so many bytes at most (a longer row comes alone), else of up to 10,000 texts or sets
#: that the executor and the worker hold at once. A session's own value holds.
BATCH = ("spark.sql.execution.arrow.maxBytesPerBatch", "8m")


def importable(spark: SparkSession) -> SparkSession:
    """Add the package's folder to the workers' path; on a cluster it must be installed or shipped with ``addPyFile``."""
    if spark.conf.get(BATCH[0], None) is None:
        spark.conf.set(*BATCH)
    environment = spark.sparkContext.environment
    for name, value in GIVE_BACK.items():
        environment.setdefault(name, value)
    paths = environment.get("PYTHONPATH", "").split(":")
    if ROOT not in paths:
        environment["PYTHONPATH"] = ":".join([ROOT, *filter(None, paths)])
    return spark
