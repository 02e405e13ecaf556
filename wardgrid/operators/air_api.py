"""Landed air-API JSON flattened to sensors and daily readings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..errors import QualityGateError
from ..fixed_values import POLLUTANT
from ..functions.once import filter_computed
from ..functions.rounding import round_binary


def _date_part(instant: Column) -> Column:
    return F.substring(F.coalesce(instant, F.lit("")), 1, 10)


def known_sensors(locations: DataFrame) -> DataFrame:
    """One row per sensor of the right pollutant at a fixed station that was ever seen: ``visto`` is the date, as
    text, of its last UTC instant. ``locations`` has the columns of ``schemas.API_LOCATION``."""
    usable = locations.withColumn("visto", _date_part(F.col("datetimeLast.utc"))).where(
        ~F.coalesce("isMobile", F.lit(False)) & (F.col("visto") != "")
    )
    station = usable.select(
        F.col("id").cast("string").alias("estacion_id"),
        F.col("name").alias("estacion_nombre"),
        F.col("coordinates.latitude").alias("latitud"),
        F.col("coordinates.longitude").alias("longitud"),
        "visto",
        F.explode("sensors").alias("_sensor"),
    )
    return (
        station.where(F.col("_sensor.parameter.name") == POLLUTANT)
        .withColumn("sensor_id", F.col("_sensor.id").cast("string"))
        .drop("_sensor")
    )


def active_sensors(locations: DataFrame, day: Column) -> DataFrame:
    """Known sensors seen on or after the day, which is compared as text, as the API writes it."""
    return known_sensors(locations).where(F.col("visto") >= day.cast("date").cast("string")).drop("visto")


def select_sensors(locations: DataFrame, day: Column, most: int) -> DataFrame:
    """The first sensors in text order of (station, sensor); the limit is the feature."""
    return active_sensors(locations, day).orderBy("estacion_id", "sensor_id").limit(most)


def _reading(day: Column, source: str) -> list[Column]:
    """The columns of a reading, of the sensor columns and the deciding ``_item``."""
    return [
        day.cast("date").alias("fecha"),
        *(F.col(c) for c in ("estacion_id", "estacion_nombre", "latitud", "longitud", "sensor_id")),
        F.coalesce("_item.parameter.name", F.lit(POLLUTANT)).alias("parametro"),
        F.col("_item.parameter.units").alias("unidad"),
        round_binary("_item.value", 3).alias("valor_promedio"),
        F.col("_item.coverage.percentComplete").alias("cobertura_pct"),
        F.col("_item.coverage.observedCount").alias("n_observaciones"),
        F.lit(source).alias("fuente"),
    ]


def daily_readings(pages: DataFrame, day: Column, items: str = "results", source: str = "openaq") -> DataFrame:
    """One reading per sensor page for the local day.

    ``pages`` has the sensor columns of :func:`active_sensors` and an array of
    ``schemas.API_DAY_ITEM``. The first item of that local day decides: when its
    value is null the sensor has no reading, even if a later item matches.
    """
    wanted = day.cast("date").cast("string")
    same_day = F.filter(items, lambda i: _date_part(i["period"]["datetimeFrom"]["local"]) == wanted)
    item = F.get(same_day, F.lit(0))
    found = filter_computed(pages.withColumn("_item", item), F.col("_item.value").isNotNull())
    return found.select(*_reading(day, source))


def readings_of_days(pages: DataFrame, sensors: DataFrame, days: DataFrame, items: str = "results", source: str = "openaq") -> DataFrame:
    """Readings of all requested days at once, as :func:`daily_readings` has them day by day.

    ``pages`` has sensor_id and the items of any number of days; ``sensors`` is
    :func:`known_sensors`; ``days`` has one row per day in ``fecha``. A page gives each of its days
    once, by its first item of that day. A sensor counts for the days up to the one it was last seen.
    """
    dated = F.transform(items, lambda i: _date_part(i["period"]["datetimeFrom"]["local"]))
    first = pages.withColumn("_dates", dated).select(
        "sensor_id",
        F.explode(F.transform(F.array_distinct("_dates"), lambda d: F.struct(
            d.alias("day"), F.get(F.col(items), (F.array_position(F.col("_dates"), d) - 1).cast("int")).alias("item")
        ))).alias("_of"),
    ).select("sensor_id", F.col("_of.day").alias("_day"), F.col("_of.item").alias("_item"))
    wanted = days.select("fecha", F.col("fecha").cast("string").alias("_day"))
    found = first.where("_item.value is not null").join(wanted, "_day").join(sensors, "sensor_id").where("visto >= _day")
    return found.select(*_reading(F.col("fecha"), source))


def days_without_readings(readings: DataFrame, sensors: DataFrame, days: DataFrame) -> DataFrame:
    """fecha, error of each requested day that no sensor reported, or for which no sensor was active."""
    missing = days.join(readings.select("fecha").distinct(), "fecha", "left_anti")
    last = sensors.agg(F.max("visto")).first()[0]
    active = F.lit(last is not None) & (F.lit(last or "") >= F.col("fecha").cast("string"))
    why = F.when(active, f"no station reported {POLLUTANT}").otherwise(f"no active {POLLUTANT} sensor")
    return missing.select("fecha", why.alias("error"))


def require_readings(readings: DataFrame, day: str) -> DataFrame:
    """Fail when no sensor had a reading."""
    if readings.isEmpty():
        raise QualityGateError(f"no station reported {POLLUTANT} for {day}")
    return readings
