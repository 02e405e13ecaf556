"""The tables derived from raw visits and raw air readings, as lazy DataFrames."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ..fixed_values import ASTHMA_CODES, OLDER_GROUP, PNEUMONIA_CODES, POLLUTANT, YOUNG_GROUP
from ..functions.text import normalize_text
from ..operators.dedup import keep_latest
from ..operators.grid import calendar_of, dense_grid, fill_grid
from ..operators.proximity import nearest_per_key, radius_pairs
from ..operators.rollups import counts_by_place_day
from ..operators.stations import station_day
from ..operators.trends import air_category, alert_flag, percent_change, trailing_average, with_trailing
from ..params import DEFAULTS, Parameters
from ..sources.scratch import write_all_through

VISIT_KEY = ["fecha_atencion", "codigo_clinica", "distrito_reportado", "grupo_edad", "diagnostico_cie10"]
COUNT_COLUMNS = [
    "total_atenciones",
    "atenciones_menores_5",
    "atenciones_adultos_mayores",
    "atenciones_asma",
    "atenciones_neumonia",
    "clinicas_reportantes",
]
READING_COLUMNS = ["pm25_promedio_24h", "estacion_referencia", "distancia_estacion_km", "fuente_calidad_aire"]


def staged_visits(raw: DataFrame) -> DataFrame:
    """Clean, typed visits; of rows with the same natural key the latest load's last row stays."""
    diagnosis = F.upper(F.trim("diagnostico_cie10"))
    clean = raw.select(
        F.col("fecha_atencion").cast("date").alias("fecha_atencion"),
        F.upper(F.trim("codigo_clinica")).alias("codigo_clinica"),
        normalize_text("distrito").alias("distrito_reportado"),
        F.replace("grupo_edad", F.lit(" "), F.lit("")).alias("grupo_edad"),
        diagnosis.alias("diagnostico_cie10"),
        F.substring(diagnosis, 1, 3).alias("categoria_cie10"),
        F.col("num_atenciones").cast("bigint").alias("num_atenciones"),
        F.col("_numero_fila").alias("numero_fila"),
        F.col("_archivo_origen").alias("archivo_origen"),
        F.col("_cargado_en").alias("cargado_en"),
    )
    # the last two only settle ties between loads; a hash keeps long paths out of the shuffle
    origin = F.xxhash64("archivo_origen")
    order = [F.desc("cargado_en"), F.desc("numero_fila"), origin.desc(), F.desc("num_atenciones")]
    return keep_latest(clean, VISIT_KEY, order)


def staged_air(raw: DataFrame) -> DataFrame:
    """One PM2.5 reading per station and day."""
    typed = raw.where(F.lower("parametro") == POLLUTANT).withColumn("fecha", F.col("fecha").cast("date"))
    return station_day(typed, loaded_at="_cargado_en").select(
        "fecha",
        "estacion_id",
        "estacion_nombre",
        "latitud",
        "longitud",
        F.lit(POLLUTANT).alias("parametro"),
        "pm25_promedio_24h",
        "cobertura_pct",
        "sensores",
        "fuente",
        "cargado_en",
    )


def visits_by_district(visits: DataFrame, aliases: DataFrame) -> DataFrame:
    """Counts per day and district code; unknown district texts are left out."""
    code = F.col("categoria_cie10")
    totals = counts_by_place_day(
        visits,
        aliases,
        day="fecha_atencion",
        text="distrito_reportado",
        reporter="codigo_clinica",
        total=("num_atenciones", "total_atenciones"),
        conditional={
            "atenciones_menores_5": F.col("grupo_edad") == YOUNG_GROUP,
            "atenciones_adultos_mayores": F.col("grupo_edad") == OLDER_GROUP,
            "atenciones_asma": code.isin(*ASTHMA_CODES),
            "atenciones_neumonia": code.isin(*PNEUMONIA_CODES),
        },
    )
    return totals.withColumnRenamed("fecha_atencion", "fecha")


def air_by_district(stations: DataFrame, districts: DataFrame, params: Parameters = DEFAULTS) -> DataFrame:
    """The nearest station with enough coverage inside the radius, per day and district."""
    reliable = stations.where(F.col("cobertura_pct") >= F.lit(params.min_coverage_pct)).select(
        "fecha", "estacion_id", "estacion_nombre", "pm25_promedio_24h", "fuente",
        F.col("latitud").alias("_lat"), F.col("longitud").alias("_lon"),
    )
    # of stations at one position only the first by id can be nearest
    per_position = nearest_per_key(
        reliable, ["fecha", "_lat", "_lon"], ["estacion_id"],
        ["estacion_id", "estacion_nombre", "pm25_promedio_24h", "fuente"],
    )
    pairs = radius_pairs(
        per_position,
        districts.select("ubigeo", "latitud", "longitud"),
        params.station_radius_km,
        point_position=("_lat", "_lon"),
        place_position=("latitud", "longitud"),
    )
    nearest = nearest_per_key(
        pairs,
        ["fecha", "ubigeo"],
        ["distancia_km", "estacion_id"],
        ["estacion_id", "estacion_nombre", "distancia_km", "pm25_promedio_24h", "fuente"],
    )
    return nearest.select(
        "fecha",
        "ubigeo",
        F.col("estacion_id").alias("estacion_referencia_id"),
        F.col("estacion_nombre").alias("estacion_referencia"),
        F.round("distancia_km", 2).alias("distancia_estacion_km"),
        "pm25_promedio_24h",
        F.col("fuente").alias("fuente_calidad_aire"),
    )


def indicators(filled: DataFrame, params: Parameters = DEFAULTS, place: str = "ubigeo") -> DataFrame:
    """Air category, trailing average, change and alert on a filled grid."""
    trailing = with_trailing(filled, place, "fecha", "total_atenciones", params.trailing_rows)
    return trailing.withColumn("categoria_aire", air_category("pm25_promedio_24h", params)).withColumns(
        {
            "promedio_atenciones_7d_previos": trailing_average(),
            "variacion_vs_7d_pct": percent_change("total_atenciones"),
            "alerta_salud_publica": alert_flag("total_atenciones", "categoria_aire", params),
        }
    )


def district_day_fact(
    districts: DataFrame, visits: DataFrame, air: DataFrame, params: Parameters = DEFAULTS
) -> DataFrame:
    """One row per day and district."""
    calendar = calendar_of((visits, "fecha"), (air, "fecha"))
    grid = dense_grid(calendar, districts.select("ubigeo", "distrito", "zona"), "ubigeo")
    filled = fill_grid(grid, ["fecha", "ubigeo"], visits, COUNT_COLUMNS, air)
    return fact_columns(indicators(filled, params))


def place_dimension(catalogue: DataFrame) -> DataFrame:
    """The places of a catalogue for those who query: code, name, zone, position."""
    return catalogue.select("ubigeo", "distrito", "zona", "latitud", "longitud")


def fact_columns(computed: DataFrame) -> DataFrame:
    return computed.select(
        "fecha",
        "ubigeo",
        "distrito",
        "zona",
        *COUNT_COLUMNS,
        "pm25_promedio_24h",
        "categoria_aire",
        "estacion_referencia",
        "distancia_estacion_km",
        "fuente_calidad_aire",
        "promedio_atenciones_7d_previos",
        "variacion_vs_7d_pct",
        "alerta_salud_publica",
        F.current_timestamp().alias("actualizado_en"),
    )


@dataclass(frozen=True)
class Models:
    """All derived tables of one build."""

    visits: DataFrame
    air: DataFrame
    district_visits: DataFrame
    district_air: DataFrame
    districts: DataFrame
    aliases: DataFrame
    fact: DataFrame


def build_models(
    raw_visits: DataFrame,
    raw_air: DataFrame,
    districts: DataFrame,
    aliases: DataFrame,
    params: Parameters = DEFAULTS,
    keep_staged: bool = False,
) -> Models:
    """Derive every table.

    The two district tables feed both the calendar and the grid. They are small
    next to the raw tables, so they are written once instead of being computed
    twice. ``keep_staged`` also writes the staged tables, which pays off when the
    checks will read them again.
    """
    visits, air = staged_visits(raw_visits), staged_air(raw_air)
    if keep_staged:
        visits, air = write_all_through({"stg-visits": visits, "stg-air": air})
    per_district, air_district = write_all_through(
        {
            "district-visits": visits_by_district(visits, aliases),
            "district-air": air_by_district(air, districts, params),
        }
    )
    fact = district_day_fact(districts, per_district, air_district, params)
    return Models(visits, air, per_district, air_district, districts, aliases, fact)
