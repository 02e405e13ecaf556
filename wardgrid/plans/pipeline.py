"""Batch jobs from landed files to the published report.

Every job works on any number of days at once: a day is a partition, not a loop.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import schemas
from ..errors import QualityGateError, StructureError
from ..fixed_values import RAW_AIR_COLUMNS, RAW_VISIT_COLUMNS, REPORT_COLUMNS, REPORT_TITLE, VISIT_COLUMNS
from ..operators.air_api import days_without_readings, known_sensors, readings_of_days
from ..operators.grid import calendar_of
from ..operators.quality import store_and_enforce
from ..operators.report import report_lines, require_days
from ..operators.validation import (
    check_rows,
    enforce_rejection_rate,
    quarantined_rows,
    rejection_summary,
    valid_rows,
    visit_rules,
)
from ..params import DEFAULTS, Parameters
from ..sources import daytable
from ..sources.catalogue import district_aliases, districts
from ..sources.delimited import scan_delimited
from ..sources.lake import DAY_FOLDER, layer_folder, replace_days, with_lineage
from ..sources.records import CSV_WRITE, read_csv
from ..sources.scratch import write_through
from .checks import declared_checks
from .models import Models, build_models

VISITS, AIR, REPORTS = "atenciones", "calidad_aire", "reporte"
DAY_IN_PATH = r"(?:_|/fecha=)([0-9]{4}-[0-9]{2}-[0-9]{2})(?:\.[A-Za-z]+$|/)"
STAGED_COLUMNS = (*VISIT_COLUMNS, "_numero_fila")
QUARANTINE_COLUMNS = (*STAGED_COLUMNS, "motivo_rechazo")
#: Failing days an error names; the rest are counted.
SHOWN_DAYS = 20


def day_of_file(path: Column) -> Column:
    """Day in a file's name or folder: ``atenciones_2026-10-07.csv``, ``fecha=2026-10-07/a.csv``."""
    return F.regexp_extract(path, DAY_IN_PATH, 1).try_cast("date")


def stage_visits(
    spark: SparkSession,
    paths: str | list[str],
    lake: str,
    params: Parameters = DEFAULTS,
    day: dt.date | None = None,
    strict: bool = True,
) -> DataFrame:
    """Scan, validate and write the staged and quarantine layers; then apply the gate.

    The day of a file comes from its path, or from ``day`` for a single one. The
    layers are written before the gate raises, so rejected rows can be inspected.
    Returns one summary row per day (``fecha``). With ``strict=False`` nothing is
    raised: days with an unreadable file carry it in ``error`` and are not staged,
    and days over the limit are left to the caller.
    """
    files, records = scan_files(spark, paths, day, strict)
    # parsed and checked once; both layers and the summary read the written rows
    return write_layers(files, write_through(records, "checked"), lake, params, strict)


def scan_files(
    spark: SparkSession, paths: str | list[str], day: dt.date | None = None, strict: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(files, records): day, path and error of each file; checked rows with their day and path."""
    scan = scan_delimited(spark, paths)
    if strict:
        scan.require_readable()
    expected = F.lit(day) if day is not None else day_of_file(F.col("path"))
    files = scan.files.select(expected.alias(DAY_FOLDER), "path", "error")
    if not files.where(F.col(DAY_FOLDER).isNull()).isEmpty():
        raise StructureError("a file path carries no day")
    return files, checked_records(scan.records.withColumn(DAY_FOLDER, expected))


def checked_records(records: DataFrame) -> DataFrame:
    """Scanned records of days with what the rules make of them."""
    return check_rows(records.withColumnRenamed("record_number", "_numero_fila"), visit_rules(F.col(DAY_FOLDER)))


def write_layers(files: DataFrame, checked: DataFrame, lake: str, params: Parameters = DEFAULTS, strict: bool = True) -> DataFrame:
    """Write the staged and quarantine layers of the days of ``files`` from checked rows; the summary, as ``stage_visits`` has it."""
    listed = files.groupBy(DAY_FOLDER).agg(
        F.min(F.concat(F.col("path"), F.lit(": "), F.col("error"))).alias("error")  # null without an error
    )
    counted = rejection_summary(checked, DAY_FOLDER)
    numbers = [c for c in counted.columns if c != DAY_FOLDER]
    summary = write_through(listed.join(counted, DAY_FOLDER, "left").fillna(0, numbers), "summary")
    staged = summary.where("error is null")
    days = staged.select(DAY_FOLDER)
    for layer, rows, columns, count in (
        ("staged", valid_rows(checked), STAGED_COLUMNS, "validas"),
        ("cuarentena", quarantined_rows(checked), QUARANTINE_COLUMNS, "rechazadas"),
    ):
        present = staged.where(F.col(count) > 0).select(DAY_FOLDER)
        if not strict:
            rows = rows.join(days, DAY_FOLDER, "left_semi")
        folder = layer_folder(lake, layer, VISITS)
        replace_days(rows.select(DAY_FOLDER, *columns), folder, DAY_FOLDER, days, "csv", present, **CSV_WRITE)
    if strict:
        enforce_rejection_rate(summary, params.max_rejection_rate)
    return summary


def load_visits(
    spark: SparkSession, lake: str, table: str, days: DataFrame, loaded_at: dt.datetime | None = None
) -> None:
    """Reread the staged days and replace them in the raw visits table, all of them or none."""
    staged = read_csv(spark, layer_folder(lake, "staged", VISITS), STAGED_COLUMNS, DAY_FOLDER)
    rows = staged.join(days.select(DAY_FOLDER), DAY_FOLDER, "left_semi")
    stamp = F.lit(loaded_at) if loaded_at else F.current_timestamp()
    typed = with_lineage(rows, RAW_VISIT_COLUMNS, F.col("_archivo")).withColumns(
        {
            "fecha_atencion": F.col("fecha_atencion").cast("date"),
            "num_atenciones": F.col("num_atenciones").cast("bigint"),
            "_numero_fila": F.col("_numero_fila").cast("bigint"),
            "_cargado_en": stamp.cast("timestamp_ntz"),
        }
    )
    days = days.select(F.col(DAY_FOLDER).alias("fecha_atencion"))
    daytable.replace_days(typed, table, "fecha_atencion", days)


def stage_air(
    spark: SparkSession, locations: str, pages: str, lake: str, days: dt.date | DataFrame, strict: bool = True
) -> DataFrame:
    """Landed API pages to one JSON line per sensor and day with a reading, for all requested days in one pass.

    ``locations`` holds pages of stations; ``pages`` holds the daily pages in
    folders ``sensor_id=<id>``; ``days`` is one day, or has a row per day in ``fecha``. Days
    with readings are written; then days without are named in an error, each with its reason. With
    ``strict=False`` nothing is raised. Returns the readings.
    """
    if not isinstance(days, DataFrame):
        days = spark.range(1).select(F.lit(days).alias(DAY_FOLDER))
    days = write_through(days.select(F.col(DAY_FOLDER).cast("date")).where(f"{DAY_FOLDER} is not null").distinct(), "air-days")
    found = (
        spark.read.option("multiLine", "true")
        .schema(schemas.API_LOCATIONS_PAGE)
        .json(locations)
        .select(F.inline("results"))
    )
    sensors = write_through(known_sensors(found), "sensors")  # all of them: the pages have landed already
    page_schema = schemas.T.StructType(
        [*schemas.API_DAYS_PAGE.fields, schemas.T.StructField("sensor_id", schemas.T.StringType())]
    )
    daily = spark.read.option("multiLine", "true").schema(page_schema).json(pages)
    readings = write_through(readings_of_days(daily, sensors, days), "readings")
    missing = write_through(days_without_readings(readings, sensors, days), "missing-days")
    present = days.join(missing, DAY_FOLDER, "left_anti")
    replace_days(readings, layer_folder(lake, "raw", AIR), DAY_FOLDER, present, "json", present, ignoreNullFields="false")
    if strict:
        first = missing.orderBy(DAY_FOLDER).limit(SHOWN_DAYS).collect()
        if first:
            more = missing.count() - len(first) if len(first) == SHOWN_DAYS else 0
            named = "; ".join(f"{r.error} for {r.fecha}" for r in first)
            raise QualityGateError(named + (f"; and {more} more days" if more else ""))
    return readings


def load_air(
    spark: SparkSession, lake: str, table: str, days: DataFrame, loaded_at: dt.datetime | None = None
) -> None:
    """Reread the landed lines and replace their days in the raw air table, all of them or none."""
    lines = spark.read.schema(schemas.AIR_LINES).json(layer_folder(lake, "raw", AIR))
    stamp = F.lit(loaded_at) if loaded_at else F.current_timestamp()
    rows = lines.select("*", F.col("_metadata.file_path").alias("_archivo")).join(
        days.select(F.col(DAY_FOLDER).alias("fecha")), "fecha", "left_semi"
    )
    typed = with_lineage(rows, RAW_AIR_COLUMNS, F.col("_archivo")).withColumn(
        "_cargado_en", stamp.cast("timestamp_ntz")
    )
    daytable.replace_days(typed, table, "fecha", days.select(F.col(DAY_FOLDER).alias("fecha")))


def raw_visits(spark: SparkSession, table: str) -> DataFrame:
    """The raw visits table as its newest entry has it."""
    return daytable.read(spark, table, "fecha_atencion", schemas.RAW_VISITS)


def raw_air(spark: SparkSession, table: str) -> DataFrame:
    return daytable.read(spark, table, "fecha", schemas.RAW_AIR)


def build_mart(
    spark: SparkSession,
    visits_table: str,
    air_table: str,
    mart: str,
    audit: str,
    params: Parameters = DEFAULTS,
    places: DataFrame | None = None,
    aliases: DataFrame | None = None,
) -> Models:
    """Rebuild the finished table, run the declared checks on it, raise if one fails."""
    models = build_models(
        raw_visits(spark, visits_table),
        raw_air(spark, air_table),
        districts(spark) if places is None else places,
        district_aliases(spark) if aliases is None else aliases,
        params,
        keep_staged=True,
    )
    days = calendar_of((models.district_visits, "fecha"), (models.district_air, "fecha"))
    # days that are gone are emptied; a failing write leaves the old table in place
    stored = daytable.days_of(spark, mart, "fecha")
    daytable.replace_days(models.fact, mart, "fecha", days.union(stored).distinct())
    built = Models(**{**models.__dict__, "fact": daytable.read(spark, mart, "fecha", models.fact.schema)})
    store_and_enforce(spark, declared_checks(built, params), audit)
    return built


def publish_report(mart: DataFrame, lake: str, days: DataFrame, title: str = REPORT_TITLE) -> None:
    """Write the text and CSV report of the requested days, one file per day."""
    require_days(mart, days, DAY_FOLDER)
    wanted = mart.join(days.select(DAY_FOLDER), DAY_FOLDER, "left_semi")
    order = ("seccion", F.desc("alerta"), F.desc("gravedad"), F.desc("atenciones"), "distrito")
    lines = report_lines(wanted, title).repartition(DAY_FOLDER).sortWithinPartitions(DAY_FOLDER, *order)
    folder = layer_folder(lake, "reportes", REPORTS)
    replace_days(
        lines.select(DAY_FOLDER, "linea"), f"{folder}_md", DAY_FOLDER, days, "text", days, arranged=True
    )
    rows = wanted.select(DAY_FOLDER, *REPORT_COLUMNS).repartition(DAY_FOLDER)
    replace_days(rows, f"{folder}_csv", DAY_FOLDER, days, "csv", days, arranged=True, **CSV_WRITE)
