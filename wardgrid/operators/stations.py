"""Sensor readings averaged per station and day."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

#: Sums of these types are exact, whatever the order of rows. Readings have three decimals, positions fewer than nine.
EXACT, POSITION = "decimal(18,6)", "decimal(18,9)"


def station_day(
    readings: DataFrame,
    day: str = "fecha",
    station: str = "estacion_id",
    sensor: str = "sensor_id",
    name: str = "estacion_nombre",
    source: str = "fuente",
    value: str = "valor_promedio",
    coverage: str = "cobertura_pct",
    latitude: str = "latitud",
    longitude: str = "longitud",
    loaded_at: str | None = None,
) -> DataFrame:
    """One row per station and day with averaged value, coverage and position.

    Two levels. The first groups by every text column and keeps only numeric
    buffers, which Spark hash-aggregates in each map task; the second takes the
    text maxima and the distinct sensors over the few rows left. A station-day
    with most of the readings is already reduced before the shuffle. All measures are
    summed as decimals, so rounding, distances and the nearest station do not depend on the order
    of rows. A value that is no number, or beyond the type, is a missing value: as a reading it
    leaves its row out, elsewhere it does not count in the average.
    """
    measures = {
        "v": F.col(value).try_cast(EXACT),
        "c": F.col(coverage).try_cast(EXACT),
        "a": F.col(latitude).try_cast(POSITION),
        "o": F.col(longitude).try_cast(POSITION),
    }
    per_sensor = readings.where(measures["v"].isNotNull()).groupBy(
        F.col(day).alias("fecha"),
        F.col(station).cast("string").alias("estacion_id"),
        F.col(name).alias("estacion_nombre"),
        F.col(source).alias("fuente"),
        F.col(sensor).alias("sensor_id"),
    ).agg(
        *(F.sum(c).alias(f"{k}_sum") for k, c in measures.items()),
        *(F.count(c).alias(f"{k}_n") for k, c in measures.items()),
        *([F.max(loaded_at).alias("cargado_en")] if loaded_at else []),
    )

    def mean(k: str):
        return F.try_divide(F.sum(f"{k}_sum"), F.sum(f"{k}_n"))

    return per_sensor.groupBy("fecha", "estacion_id").agg(
        F.max("estacion_nombre").alias("estacion_nombre"),
        mean("a").cast("double").alias("latitud"),
        mean("o").cast("double").alias("longitud"),
        F.round(mean("v"), 2).cast("double").alias("pm25_promedio_24h"),
        F.round(mean("c"), 1).cast("double").alias("cobertura_pct"),
        F.countDistinct("sensor_id").alias("sensores"),
        F.max("fuente").alias("fuente"),
        *([F.max("cargado_en").alias("cargado_en")] if loaded_at else []),
    )
