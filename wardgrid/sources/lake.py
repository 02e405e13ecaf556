"""Layered lake folders, partition replacement, retention."""

from __future__ import annotations

import datetime as dt
import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.observation import Observation

from ..errors import PartitionError
from ..fixed_values import LAKE_LAYERS, RETENTION_DAYS
from ..functions.text import text_map
from .files import can_list, list_files, remove
from .scratch import write_through

_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_$]*")
DAY_FOLDER = "fecha"


def checked_name(name: str) -> str:
    """A table or column name: up to three plain identifiers joined by dots."""
    parts = name.split(".")
    if len(parts) > 3 or not all(_NAME.fullmatch(p) for p in parts):
        raise ValueError(f"invalid identifier: {name!r}")
    return name


def layer_folder(root: str, layer: str, domain: str) -> str:
    if layer not in LAKE_LAYERS:
        raise ValueError(f"unknown layer {layer!r}; use one of {', '.join(sorted(LAKE_LAYERS))}")
    return f"{root.rstrip('/')}/{layer}/{domain}" if root else f"{layer}/{domain}"


def object_key(layer: str, domain: str, day: dt.date | str, file: str, root: str = "") -> str:
    """``layer/domain/fecha=D/file``, below ``root`` if given."""
    return f"{layer_folder(root, layer, domain)}/{DAY_FOLDER}={day}/{file}"


def with_lineage(df: DataFrame, columns: tuple[str, ...], origin: Column | str) -> DataFrame:
    """Project the loaded columns and record where each row came from.

    ``origin`` is a constant, or a column such as ``_metadata.file_path``.
    """
    origin = F.lit(origin) if isinstance(origin, str) else origin
    return df.withColumn("_archivo_origen", origin).select(*columns)


def replace_partition(df: DataFrame, table: str, column: str, day: dt.date | str) -> int:
    """Replace one day of a partitioned Parquet table and return its row count.

    * A row of another day aborts the job before anything is replaced.
    * Spark writes to a staging folder and swaps at job commit, so a failing
      write leaves the old day in place. The swap itself is a folder delete and
      rename, not a transaction; a reader at that moment can miss the day.
    * Without rows the day is emptied, as a delete followed by no insert.
    """
    checked_name(column)
    for name in df.columns:
        checked_name(name)
    day = str(day)
    folder = f"{table.rstrip('/')}/{column}={day}"
    stray = f"row outside {column}={day}"
    if column in df.columns:
        foreign = ~F.col(column).cast("string").eqNullSafe(day)
        guard = F.when(foreign, F.raise_error(F.lit(stray))).otherwise(F.lit(day).cast("date"))
        guarded = df.withColumn(column, guard)
    else:
        guarded = df.withColumn(column, F.lit(day).cast("date"))
    seen = Observation("replaced")
    observed = guarded.observe(seen, F.count(F.lit(1)).alias("rows"))
    try:
        (
            observed.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(column)
            .parquet(table)
        )
    except Exception as error:
        if stray not in str(error):
            raise
        strays = df.where(foreign).count()
        raise PartitionError(f"{strays} rows do not belong to {day}; nothing was replaced") from None
    if seen.get["rows"] == 0:
        df.drop(column).limit(0).write.mode("overwrite").parquet(folder)
        return 0
    return df.sparkSession.read.parquet(folder).count()


def replace_days(
    df: DataFrame,
    table: str,
    column: str,
    days: DataFrame,
    fmt: str = "parquet",
    present: DataFrame | None = None,
    arranged: bool = False,
    **options: str,
) -> None:
    """Replace many days in one write; requested days without rows are emptied.

    ``days`` holds the requested days in ``column``. Rows of other days abort
    before anything is replaced. ``present`` may name the days that have rows when
    the caller has counted them already; ``arranged`` keeps the caller's partitions
    and order, for files whose lines have an order. As in :func:`replace_partition`, the swap
    happens at job commit.
    """
    checked_name(column)
    requested = days.select(F.col(column).cast("date")).distinct()
    if present is None:
        present = write_through(df.select(F.col(column).cast("date")).distinct(), "present-days")
    strays = present.join(requested, column, "left_anti").count()
    if strays:
        raise PartitionError(f"rows of {strays} days that were not requested; nothing was replaced")
    # rebalancing gives each day few files and splits a day that holds most rows
    (
        (df if arranged else df.hint("rebalance", column))
        .write.mode("overwrite")
        .format(fmt)
        .options(**options)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(column)
        .save(table)
    )
    empty = requested.join(present, column, "left_anti")
    folder = F.concat(F.lit(f"{table.rstrip('/')}/{column}="), F.col(column).cast("string"))
    if can_list(table):
        remove(empty.select(folder.alias("path")))  # by tasks, all days at once
        return
    blank = df.drop(column).limit(0)
    for row in empty.select(folder).collect():  # at most the requested days
        blank.write.mode("overwrite").format(fmt).options(**options).save(row[0])


def list_objects(spark: SparkSession, root: str) -> DataFrame:
    """Objects below a lake root: path, layer, domain, day, written_at, size. No content is read."""
    layout = r"/([^/]+)/([^/]+)/fecha=([0-9-]{10})/"
    if can_list(root):  # by tasks
        found = list_files(spark, [root]).where("size > 0").withColumnsRenamed({"modified": "modificationTime", "size": "length"})
    else:
        found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return found.select(
        "path",
        F.regexp_extract("path", layout, 1).alias("capa"),
        F.regexp_extract("path", layout, 2).alias("dominio"),
        F.regexp_extract("path", layout, 3).try_cast("date").alias("fecha"),
        F.col("modificationTime").alias("escrito_en"),
        F.col("length").alias("bytes"),
    )


def retention_expired(
    objects: DataFrame,
    as_of: Column,
    layer: str = "capa",
    written: str = "escrito_en",
    keep_days: dict[str, int] | None = None,
) -> DataFrame:
    """Objects kept longer than their layer allows; other layers never expire."""
    keep = RETENTION_DAYS if keep_days is None else keep_days
    limit = F.try_element_at(text_map({k: str(v) for k, v in keep.items()}), F.col(layer))
    expires = F.date_add(F.col(written).cast("date"), limit.cast("int"))
    return objects.withColumn("expira_el", expires).where(F.col("expira_el") <= as_of)


def expire(spark: SparkSession, root: str, as_of: dt.date, journal: str, keep_days: dict[str, int] | None = None) -> DataFrame:
    """Remove what ``root`` keeps longer than its layers allow; returns path, capa, dominio, expira_el, removed.

    The plan is written to ``journal`` first, and tasks remove what the written plan names: a
    lost executor or a second run removes the same objects, and finds some gone. Only objects in
    ``layer/domain/fecha=D`` expire. Later runs add to the journal.
    """
    run = f"{journal.rstrip('/')}/as_of={as_of}/{uuid.uuid4().hex}"
    objects = list_objects(spark, root).where("capa <> '' and fecha is not null")
    plan = retention_expired(objects, F.lit(as_of), keep_days=keep_days).select("path", "capa", "dominio", "expira_el")
    plan.write.parquet(f"{run}-plan")
    plan = spark.read.schema(plan.schema).parquet(f"{run}-plan")
    done = plan.join(remove(plan), "path")
    done.write.parquet(f"{run}-done")
    return spark.read.schema(done.schema).parquet(f"{run}-done")
