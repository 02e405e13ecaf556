"""Incremental rebuild of the finished table for a set of changed days.

A row depends on its own day and on the preceding rows of its place, counted in
calendar rows. A changed day therefore touches itself and the next rows of the
calendar, no more. Raw tables are read for the changed days only (partition
pruning); every other input is the finished table itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .. import schemas
from ..operators.grid import dense_grid, fill_grid
from ..params import DEFAULTS, Parameters
from ..sources import daytable
from ..sources.catalogue import district_aliases, districts
from ..sources.scratch import write_all_through, write_through
from .models import (
    COUNT_COLUMNS,
    READING_COLUMNS,
    air_by_district,
    fact_columns,
    indicators,
    staged_air,
    staged_visits,
    visits_by_district,
)

_BASE = ["fecha", "ubigeo", "distrito", "zona", *COUNT_COLUMNS, *READING_COLUMNS]


def _reach(calendar: DataFrame, marked: DataFrame, rows: int, forward: bool) -> DataFrame:
    """Calendar days at most ``rows`` calendar rows after (or before) a marked day.

    A marked day need not be in the calendar. The calendar has one row per day, so
    its window is small however large the tables are.
    """
    step = (lambda c: c.asc()) if forward else (lambda c: c.desc())
    union = (
        calendar.select("fecha", F.lit(1).alias("row"), F.lit(False).alias("mark"))
        .unionByName(marked.select("fecha", F.lit(0).alias("row"), F.lit(True).alias("mark")))
        .groupBy("fecha")
        .agg(F.max("row").alias("row"), F.max("mark").alias("mark"))
    )
    ordered = Window.orderBy(step(F.col("fecha"))).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    number = F.sum("row").over(ordered)
    last_mark = F.last(F.when(F.col("mark"), F.col("_number")), True).over(ordered)
    reached = union.withColumn("_number", number).withColumn("_mark", last_mark)
    return reached.where((F.col("row") == 1) & (F.col("_number") - F.col("_mark") <= rows)).select("fecha")


def _on_days(table: DataFrame, column: str, days: list) -> DataFrame:
    return table.where(F.col(column).isin(days))


def refreshed_rows(
    raw_visits: DataFrame,
    raw_air: DataFrame,
    mart: DataFrame,
    changed: list,
    places: DataFrame,
    aliases: DataFrame,
    params: Parameters = DEFAULTS,
) -> tuple[DataFrame, DataFrame]:
    """(rows, days): the rows to write and the days they replace.

    ``changed`` lists the changed days; a changed day without rows in either raw
    table leaves the calendar, and its days in the result are emptied.
    """
    spark = mart.sparkSession
    marked = spark.createDataFrame([(d,) for d in changed], "fecha date")
    visits = visits_by_district(staged_visits(_on_days(raw_visits, "fecha_atencion", changed)), aliases)
    air = air_by_district(staged_air(_on_days(raw_air, "fecha", changed)), places, params)
    visits, air = write_all_through({"changed-visits": visits, "changed-air": air})

    new_days = visits.select("fecha").union(air.select("fecha")).distinct()
    grid = dense_grid(new_days, places.select("ubigeo", "distrito", "zona"), "ubigeo")
    fresh = fill_grid(grid, ["fecha", "ubigeo"], visits, COUNT_COLUMNS, air).select(*_BASE)
    kept = mart.where(~F.col("fecha").isin(changed))
    calendar = write_through(kept.select("fecha").distinct().union(new_days), "calendar")

    touched = write_through(_reach(calendar, marked, params.trailing_rows, forward=True), "touched")
    needed = _reach(calendar, touched, params.trailing_rows, forward=False)
    base = kept.select(*_BASE).join(needed, "fecha", "left_semi").unionByName(fresh)
    rows = fact_columns(indicators(base, params)).join(touched, "fecha", "left_semi")
    # written before the table it was read from is replaced
    return write_through(rows, "refreshed"), touched.union(marked).distinct()


def refresh_mart(
    spark: SparkSession,
    visits_table: str,
    air_table: str,
    mart: str,
    changed: list,
    params: Parameters = DEFAULTS,
    places: DataFrame | None = None,
    aliases: DataFrame | None = None,
) -> DataFrame:
    """Bring a finished table up to date after the raw partitions of ``changed`` were replaced; returns the days it replaced."""
    rows, days = refreshed_rows(
        daytable.read(spark, visits_table, "fecha_atencion", schemas.RAW_VISITS),
        daytable.read(spark, air_table, "fecha", schemas.RAW_AIR),
        daytable.read(spark, mart, "fecha"),
        changed,
        districts(spark) if places is None else places,
        district_aliases(spark) if aliases is None else aliases,
        params,
    )
    daytable.replace_days(rows, mart, "fecha", days)
    return days
