"""The declared checks over stored states of days: only changed days are read again.

Two day tables below one root hold the states: ``staged`` those of the staged and the district tables,
whose days change with the raw days, and ``mart`` those of the finished table, where a changed day also
touches the next rows of the calendar. Each is replaced all at once, so a failing write leaves
the states as they were.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .. import schemas
from ..operators.day_checks import STATE, day_states, failures_by_day, merged_checks
from ..params import DEFAULTS, Parameters
from ..sources import daytable
from ..sources.catalogue import district_aliases, districts
from ..sources.scratch import write_all_through
from .checks import declared_checks
from .models import Models, air_by_district, district_day_fact, staged_air, staged_visits, visits_by_district
from .refresh import refresh_mart

STAGED = {"stg_atenciones", "stg_mediciones_aire", "int_atenciones_distrito_dia", "int_pm25_distrito_dia"}
MART = {"fct_distrito_dia"}
_PARTS = {"staged": STAGED, "mart": MART}


def store_states(models: Models, root: str, staged_days: DataFrame, mart_days: DataFrame, params: Parameters = DEFAULTS) -> None:
    """Replace the states of the given days (column fecha) by those of the rows that ``models`` has of them."""
    declared = declared_checks(models, params)
    for (part, tables), days in zip(_PARTS.items(), (staged_days, mart_days), strict=True):
        daytable.replace_days(day_states(declared, tables), f"{root.rstrip('/')}/{part}", "fecha", days)


def store_all_states(models: Models, root: str, params: Parameters = DEFAULTS) -> None:
    """States of all days of ``models``, which hold whole tables; stored days that they lack are emptied.

    A day with unknown places only is staged and not in the finished table, so the tables name their own days.
    """
    spark, root = models.fact.sparkSession, root.rstrip("/")
    staged = models.visits.select(F.col("fecha_atencion").alias("fecha")).union(models.air.select("fecha")).distinct()
    mart = models.fact.select("fecha").distinct()
    staged, mart = (
        days.union(daytable.days_of(spark, f"{root}/{part}", "fecha")).distinct()
        for part, days in zip(_PARTS, (staged, mart), strict=True)
    )
    store_states(models, root, staged, mart, params)


def read_states(spark: SparkSession, root: str) -> DataFrame:
    parts = [daytable.read(spark, f"{root.rstrip('/')}/{part}", "fecha", T.StructType.fromDDL(STATE)) for part in _PARTS]
    return parts[0].unionByName(parts[1])


def models_of_days(
    raw_visits: DataFrame,
    raw_air: DataFrame,
    fact: DataFrame,
    changed: list,
    touched: DataFrame,
    places: DataFrame,
    aliases: DataFrame,
    params: Parameters = DEFAULTS,
) -> Models:
    """The tables on the changed days; the finished one on the days that it replaced."""
    visits, air = write_all_through(
        {
            "changed-stg-visits": staged_visits(raw_visits.where(F.col("fecha_atencion").isin(changed))),
            "changed-stg-air": staged_air(raw_air.where(F.col("fecha").isin(changed))),
        }
    )
    days = [r.fecha for r in touched.select("fecha").collect()]  # eight per changed day at most
    return Models(
        visits, air, visits_by_district(visits, aliases), air_by_district(air, places, params), places, aliases,
        fact.where(F.col("fecha").isin(days)),
    )


def _declarations(spark: SparkSession, places: DataFrame, aliases: DataFrame, params: Parameters) -> list:
    """The declared checks on tables without days' rows; places and spellings are whole."""
    visits = staged_visits(spark.createDataFrame([], schemas.RAW_VISITS))
    air = staged_air(spark.createDataFrame([], schemas.RAW_AIR))
    per_district, air_district = visits_by_district(visits, aliases), air_by_district(air, places, params)
    fact = district_day_fact(places, per_district, air_district, params)
    return declared_checks(Models(visits, air, per_district, air_district, places, aliases, fact), params)


def stored_results(spark: SparkSession, root: str, places: DataFrame, aliases: DataFrame, params: Parameters = DEFAULTS) -> DataFrame:
    """One row per declared check, equal to ``run_checks`` over all days; reads the states, places and spellings."""
    return merged_checks(read_states(spark, root), _declarations(spark, places, aliases, params))


def stored_failures(spark: SparkSession, root: str, places: DataFrame, aliases: DataFrame, params: Parameters = DEFAULTS) -> DataFrame:
    """fecha, tabla, prueba, valor, fallas: the days, and values, with which checks fail."""
    return failures_by_day(read_states(spark, root), _declarations(spark, places, aliases, params))


def refresh_checked(
    spark: SparkSession,
    visits_table: str,
    air_table: str,
    mart: str,
    root: str,
    changed: list,
    params: Parameters = DEFAULTS,
    places: DataFrame | None = None,
    aliases: DataFrame | None = None,
) -> DataFrame:
    """Refresh the finished table and the states below ``root`` for the changed days; the results of all checks.

    A run that fails between the two can be repeated: both replace the same days.
    """
    places = districts(spark) if places is None else places
    aliases = district_aliases(spark) if aliases is None else aliases
    touched = refresh_mart(spark, visits_table, air_table, mart, changed, params, places, aliases)
    models = models_of_days(
        daytable.read(spark, visits_table, "fecha_atencion", schemas.RAW_VISITS),
        daytable.read(spark, air_table, "fecha", schemas.RAW_AIR),
        daytable.read(spark, mart, "fecha"),
        changed, touched, places, aliases, params,
    )
    store_states(models, root, spark.createDataFrame([(d,) for d in changed], "fecha date"), touched, params)
    return stored_results(spark, root, places, aliases, params)
