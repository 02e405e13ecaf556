"""The model's inputs, derived from whole shared test tables.

Visits come from ``events``, air readings from ``lineitem``, places and their
spellings from ``nation`` and ``region``. Positions are multiples of powers of
two, so that averages of equal positions are exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..plans.models import Models, build_models

DAYS = 30
FIRST_DAY = "2024-01-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(*parts) -> Column:
    return F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))


def raw_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = F.col("user_id") % 25
    spelling = (
        F.when(F.col("user_id") % 3 == 0, _text(" Nación  ", place, " "))
        .when(F.col("user_id") % 3 == 1, _text("NACION ", place))
        .otherwise(_text("N.", place))
    )
    group = (
        F.when(F.col("event_type") == "view", "0-4")
        .when(F.col("event_type") == "click", "5-17")
        .when(F.col("event_type") == "purchase", "18-59")
        .when(F.col("event_type") == "signup", "60 +")
        .otherwise("60+")
    )
    diagnosis = F.array(*(F.lit(c) for c in ("j45", "J18.9 ", "J06", "J12")))
    return table(spark, sf_dir, "events").select(
        F.col("ts").cast("date").alias("fecha_atencion"),
        _text(" cli-", F.col("user_id") % 4).alias("codigo_clinica"),
        spelling.alias("distrito"),
        group.alias("grupo_edad"),
        F.get(diagnosis, (F.col("event_id") % 4).cast("int")).alias("diagnostico_cie10"),
        F.floor("value").cast("bigint").alias("num_atenciones"),
        F.col("event_id").alias("_numero_fila"),
        F.lit("events").alias("_archivo_origen"),
        F.date_trunc("day", "ts").cast("timestamp_ntz").alias("_cargado_en"),
    )


def station_latitude(key: str) -> Column:
    return F.lit(-12.0) + (F.col(key) % 40) / F.lit(64.0)


def station_longitude(key: str) -> Column:
    return F.lit(-77.0) + (F.floor(F.col(key) / 40) % 40) / F.lit(64.0)


def raw_air(spark: SparkSession, sf_dir: str) -> DataFrame:
    offset = F.pmod(F.datediff(F.col("l_shipdate").cast("date"), F.lit("1995-01-01").cast("date")), F.lit(DAYS))
    return table(spark, sf_dir, "lineitem").select(
        F.date_add(F.lit(FIRST_DAY).cast("date"), offset.cast("int")).alias("fecha"),
        F.col("l_suppkey").alias("estacion_id"),
        _text("Estacion ", F.col("l_suppkey")).alias("estacion_nombre"),
        station_latitude("l_suppkey").alias("latitud"),
        station_longitude("l_suppkey").alias("longitud"),
        F.col("l_linenumber").cast("string").alias("sensor_id"),
        F.when(F.col("l_returnflag") == "A", "pm10").when(F.col("l_returnflag") == "N", "PM25").otherwise("pm25")
        .alias("parametro"),
        F.lit("µg/m³").alias("unidad"),
        F.when(F.col("l_linenumber") != 7, F.col("l_quantity") * (F.col("l_suppkey") % 4)).cast("double")
        .alias("valor_promedio"),
        F.round(F.col("l_discount") * 1000).cast("double").alias("cobertura_pct"),
        F.lit(24).cast("bigint").alias("n_observaciones"),
        F.when(F.col("l_linestatus") == "O", "openaq").otherwise("simulada").alias("fuente"),
        F.lit("lineitem").alias("_archivo_origen"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("_cargado_en"),
    )


def _code(key: Column) -> Column:
    return F.lpad(key.cast("string"), 6, "0")


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("n_nationkey")
    regions = table(spark, sf_dir, "region")
    nations = table(spark, sf_dir, "nation")
    away = F.when(key % 5 == 4, F.lit(1.0)).otherwise(F.lit(0.0))
    return nations.join(regions, F.col("n_regionkey") == F.col("r_regionkey")).select(
        _code(key).alias("ubigeo"),
        F.col("n_name").alias("distrito"),
        F.col("r_name").alias("zona"),
        (F.lit(-12.0) + (key * 7 % 40) / F.lit(64.0) + F.lit(3 / 1024) + away).alias("latitud"),
        (F.lit(-77.0) + (key % 3) / F.lit(64.0) + F.lit(5 / 1024)).alias("longitud"),
    )


def spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two spellings per nation; every eighth nation is left out on purpose."""
    key = F.col("n_nationkey")
    return (
        table(spark, sf_dir, "nation")
        .where(key % 8 != 7)
        .select(
            F.explode(F.array(_text("NACION ", key), _text("N.", key))).alias("alias_normalizado"),
            _code(key).alias("ubigeo"),
        )
    )


def models(spark: SparkSession, sf_dir: str, keep_staged: bool = False) -> Models:
    return build_models(
        raw_visits(spark, sf_dir),
        raw_air(spark, sf_dir),
        places(spark, sf_dir),
        spellings(spark, sf_dir),
        keep_staged=keep_staged,
    )
