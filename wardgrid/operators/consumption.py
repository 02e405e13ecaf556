"""Questions asked of the finished table. Dates are arguments, never the clock.

The order of an answer is its column ``posicion``, from 1, over the few rows that are
left: places of one day, categories, zones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.rounding import ratio_half_up
from .trends import over_guide


def _placed(rows: DataFrame, *order: Column | str) -> DataFrame:
    return rows.withColumn("posicion", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order)))


def latest_alerts(mart: DataFrame) -> DataFrame:
    """Places in alert on the last day, worst air first."""
    last = mart.select(F.max("fecha")).scalar()
    rows = mart.where((F.col("fecha") == last) & F.col("alerta_salud_publica")).select(
        "fecha", "distrito", "zona", "total_atenciones", "pm25_promedio_24h", "categoria_aire", "variacion_vs_7d_pct"
    )
    return _placed(rows, F.desc_nulls_last("pm25_promedio_24h"), "distrito")


def category_profile(mart: DataFrame, as_of: Column, days: int = 30) -> DataFrame:
    """Average counts by air category over the days before ``as_of``."""
    rows = (
        mart.where(F.col("fecha") >= F.date_sub(as_of, days))
        .groupBy("categoria_aire")
        .agg(
            F.count(F.lit(1)).alias("distrito_dias"),
            F.sum("total_atenciones").alias("_total"),
            F.sum("atenciones_menores_5").alias("_young"),
        )
        .select(
            "categoria_aire",
            "distrito_dias",
            _average("_total").alias("atenciones_promedio"),
            _average("_young").alias("menores_5_promedio"),
        )
    )
    return _placed(rows, F.desc("atenciones_promedio"), "categoria_aire")


def _average(total: str) -> Column:
    return ratio_half_up(F.col(total), F.col("distrito_dias"), 1)


def zone_ranking(mart: DataFrame, as_of: Column) -> DataFrame:
    """Days over the guide and counts per zone in the month of ``as_of``."""
    first = F.trunc(as_of, "month")
    rows = (
        mart.where((F.col("fecha") >= first) & (F.col("fecha") < F.add_months(first, 1)))
        .groupBy("zona")
        .agg(
            F.count_if(over_guide("categoria_aire")).alias("dias_sobre_oms"),
            F.sum("total_atenciones").alias("atenciones"),
        )
    )
    return _placed(rows, F.desc("dias_sobre_oms"), "zona")
