"""Which files a path holds, and the first line of each, without reading further."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import can_list, expanded, filesystem, list_files

#: Bytes read at once; a longer first line takes more reads.
STEP = 1 << 16


def listed(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path) of every file; contents stay unread.

    The source names files that have bytes. Empty ones are listed by tasks, or by the
    driver where Python does not reach the files.
    """
    files = spark.read.format("binaryFile").load(paths).select(F.col("_metadata.file_path").alias("path"))
    roots = expanded(paths)
    if roots is not None and all(can_list(r) for r in roots):
        return files.unionByName(list_files(spark, roots).where("size = 0").select("path"))
    names = spark.createDataFrame([(p,) for p in spark.read.text(paths).inputFiles()], "path string")
    names = names.withColumn("path", F.regexp_replace("path", "^([^:/]+):///", "$1:/"))  # one spelling of a local path
    return files.unionByName(names.join(files, "path", "left_anti"))


def first_line(path: str) -> bytes:
    """Up to the first line feed, without it."""
    held = b""
    system, inside, _ = filesystem(path)
    with system.open_input_stream(inside) as stream:
        while b"\n" not in held and (more := stream.read(STEP)):
            held += more
    return held.split(b"\n", 1)[0]


def can_open(files: DataFrame) -> bool:
    """Whether Python can open such files, tried with one of them; else their text is scanned for first lines."""
    one = files.limit(1).collect()
    try:
        return not one or first_line(one[0]["path"]) is not None
    except (OSError, ValueError, NotImplementedError):
        return False


def first_lines(files: DataFrame) -> DataFrame:
    """(path, head) of every file; each task opens its files one after the other."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch["path"]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path.as_py()], pa.string()), pa.array([first_line(path.as_py())], pa.binary())], names=["path", "head"]
                )

    return files.select("path").mapInArrow(read, "path string, head binary")
