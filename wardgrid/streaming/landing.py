"""Incremental ingest of landed visit files.

The stream carries file names, not contents. Per micro-batch only files that are new, or that
changed since they were scanned, go to the splittable batch scan. What earlier batches
scanned stays in a state below the checkpoint, in two tables whose days are replaced all at once: the files of
each day (path, size, time, error), and their checked rows. A late file thus costs its own scan and the
day's rows, read from Parquet; the landing folder is never listed again. Files that are gone take
their rows along. A day's partition is replaced as a whole, so a replayed batch or a
resubmitted file gives the same tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from ..errors import QualityGateError, StructureError
from ..fixed_values import VISIT_COLUMNS
from ..operators.validation import over_limit
from ..params import DEFAULTS, Parameters
from ..plans.pipeline import checked_records, day_of_file, load_visits, scan_files, write_layers
from ..sources import daytable
from ..sources.files import can_list, stat
from ..sources.scratch import write_through

_FILE = T.StructType(
    [
        T.StructField("path", T.StringType(), False),
        T.StructField("modificationTime", T.TimestampType(), False),
        T.StructField("length", T.LongType(), False),
        T.StructField("content", T.BinaryType(), True),
    ]
)


#: Names of visit files, in any case.
VISIT_FILES = "*.{[cC][sS][vV],[tT][xX][tT]}"


FILES = T.StructType(
    [
        T.StructField("fecha", T.DateType()),
        T.StructField("path", T.StringType()),  # as the scan names it
        T.StructField("source", T.StringType()),  # as it is read again
        T.StructField("size", T.LongType()),
        T.StructField("modified", T.TimestampType()),
        T.StructField("error", T.StringType()),
    ]
)


def landed_files(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """Stream of new file names; contents are never read by this source."""
    return (
        spark.readStream.format("binaryFile")
        .schema(_FILE)
        .option("pathGlobFilter", VISIT_FILES)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(folder)
        .select(F.col("_metadata.file_path").alias("path"), F.col("path").alias("source"))
    )


def _as_they_are(spark: SparkSession, files: DataFrame, folder: str) -> DataFrame:
    """``files`` (fecha, path, source) that still exist, with size and time as they are now."""
    first = files.limit(1).collect()
    if first and not can_list(first[0].path):
        present = spark.read.format("binaryFile").schema(_FILE).option("pathGlobFilter", VISIT_FILES).load(folder)
        present = present.select(F.col("_metadata.file_path").alias("path"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"))
    else:
        present = stat(files.select("path").repartition("path")).where("size is not null")
    return files.join(present, "path")


def scan_changed(spark: SparkSession, batch: DataFrame, folder: str, state: str) -> tuple[DataFrame, DataFrame]:
    """(files, checked) of all days that ``batch`` (path, source) touches; only its files, and known ones that changed, are scanned."""
    batch = write_through(batch.select("path", "source").withColumn("fecha", day_of_file(F.col("path"))), "batch")
    if not batch.where("fecha is null").isEmpty():
        raise StructureError("a file path carries no day")
    days = batch.select("fecha").distinct()
    of_days = lambda df: df.join(F.broadcast(days), "fecha", "left_semi")  # noqa: E731  (one row per day of a batch)
    known = of_days(daytable.read(spark, f"{state}/files", "fecha", FILES))
    everything = known.select("fecha", "path", "source").unionByName(batch.select("fecha", "path", "source")).distinct()
    present = write_through(_as_they_are(spark, everything, folder), "present")
    same = [present[c].eqNullSafe(known[c]) for c in ("path", "size", "modified")]
    fresh = batch.select("path").unionByName(present.join(known, same, "left_anti").select("path")).distinct()
    fresh = write_through(present.join(fresh, "path", "left_semi"), "fresh")
    kept = write_through(present.join(fresh, "path", "left_anti").join(known.select("path", "error"), "path"), "kept")

    empty = f"path string, record_number long, {', '.join(f'{c} string' for c in VISIT_COLUMNS)}, fecha date"
    schema = checked_records(spark.createDataFrame([], empty)).schema
    rows = of_days(daytable.read(spark, f"{state}/rows", "fecha", schema)).join(kept.select("path"), "path", "left_semi").select(schema.names)
    files = kept.select(FILES.names)
    paths = [r.source for r in fresh.select("source").collect()]  # at most the batch's files, and those that changed
    if paths:
        scanned, records = scan_files(spark, paths)
        files = files.unionByName(fresh.join(scanned.select("path", "error"), "path").select(FILES.names))
        rows = rows.unionByName(records.select(schema.names))
    daytable.replace_days(rows, f"{state}/rows", "fecha", days)
    daytable.replace_days(files, f"{state}/files", "fecha", days)
    read = lambda name, of: of_days(daytable.read(spark, f"{state}/{name}", "fecha", of))
    return read("files", FILES), read("rows", schema)


def ingest_landed(
    spark: SparkSession,
    folder: str,
    lake: str,
    table: str,
    checkpoint: str,
    params: Parameters = DEFAULTS,
    files_per_batch: int = 1000,
    refused_to: str | None = None,
) -> StreamingQuery:
    """Process all files present, then stop (``availableNow``).

    Per batch: scan, validate, write layers, load the days within the limit.
    Unreadable files and days over the limit then fail the batch, which is tried
    again on the next start; with ``refused_to`` they are written there, one folder
    per batch, and the stream goes on.
    """

    def ingest(batch: DataFrame, batch_id: int) -> None:
        files, checked = scan_changed(spark, batch, folder, f"{checkpoint.rstrip('/')}-days")
        if files.isEmpty():
            return
        summary = write_layers(files.select("fecha", "path", "error"), checked, lake, params, strict=False)
        unreadable = F.col("error").isNotNull()
        refused = summary.where(unreadable).unionByName(
            over_limit(summary.where(~unreadable), params.max_rejection_rate)
        )
        load_visits(spark, lake, table, summary.join(refused, "fecha", "left_anti"))
        if refused_to:
            refused.write.mode("overwrite").parquet(f"{refused_to}/batch={batch_id}")
            return
        # at most one row per day of the batch
        reasons = [
            f"{r.fecha}: {r.error or f'{r.rechazadas} of {r.total} rows rejected'}"
            for r in refused.orderBy("fecha").collect()
        ]
        if reasons:
            raise QualityGateError(f"batch {batch_id} loaded except for " + "; ".join(reasons))

    return (
        landed_files(spark, folder, files_per_batch)
        .writeStream.foreachBatch(ingest)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
