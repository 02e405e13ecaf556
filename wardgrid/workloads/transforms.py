"""Staging, joins, aggregation, windows and set operators over the shared tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.dates import business_day, parse_day
from ..functions.text import normalize_text
from ..operators.dedup import keep_latest
from ..operators.grid import calendar_of, dense_grid, fill_grid
from ..operators.proximity import radius_pairs
from ..operators.resolve import resolve_alias, unmatched_values
from ..operators.trends import ROWS, SUM, air_category, alert_flag, percent_change, trailing_average, with_trailing
from ..params import DEFAULTS
from ..plans.models import air_by_district, staged_air, staged_visits, visits_by_district
from . import derived_sql as sql
from .registry import query
from .tables import places, raw_air, raw_visits, spellings, station_latitude, station_longitude, table


@query(
    "normalize_text",
    r"""SELECT doc_id, length(t) AS n, md5(t) AS digest FROM (
          SELECT doc_id, regexp_replace(replace(upper(trim(translate(text, 'áéíóúüñÁÉÍÓÚÜÑ', 'aeiouunAEIOUUN'))),
                                                'ẞ', 'SS'), '\s+', ' ', 'g') AS t FROM documents)""",
)
def normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", normalize_text("text").alias("t"))
    return docs.select("doc_id", F.length("t").cast("bigint").alias("n"), F.md5(F.col("t").cast("binary")).alias("digest"))


@query(
    "multi_format_date",
    """SELECT o_orderkey, CAST(coalesce(try_strptime(t, '%Y-%m-%d'), try_strptime(t, '%d/%m/%Y'),
                                        try_strptime(t, '%d-%m-%Y')) AS DATE) AS fecha
       FROM (SELECT o_orderkey, CASE o_orderkey % 5
               WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%d/%m/%Y')
               WHEN 2 THEN strftime(o_orderdate, '%-d-%-m-%Y') WHEN 3 THEN strftime(o_orderdate, '31/02/%Y')
               ELSE strftime(o_orderdate, '%Y.%m.%d') END AS t FROM orders)""",
)
def multi_format_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    shapes = {0: "yyyy-MM-dd", 1: "dd/MM/yyyy", 2: "d-M-yyyy", 3: "'31/02/'yyyy", 4: "yyyy.MM.dd"}
    written = F.lit(None).cast("string")
    for rest, shape in shapes.items():
        written = F.when(F.col("o_orderkey") % 5 == rest, F.date_format("o_orderdate", shape)).otherwise(written)
    return table(spark, sf_dir, "orders").select("o_orderkey", parse_day(written).alias("fecha"))


@query(
    "business_date",
    """SELECT event_id, CASE WHEN event_id % 10 = 0 THEN DATE '2024-02-29' ELSE
         CAST(timezone('America/Lima', timezone('UTC', ts)) AS DATE) - 1 END AS dia FROM events""",
)
def business_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    explicit = F.when(F.col("event_id") % 10 == 0, F.lit("2024-02-29").cast("date"))
    # the table's times are UTC wall clocks, whatever the session's zone
    instant = F.convert_timezone(F.lit("UTC"), F.current_timezone(), "ts").cast("timestamp")
    events = table(spark, sf_dir, "events")
    return events.select("event_id", business_day(instant, DEFAULTS.local_zone, explicit).alias("dia"))


_LINE_ORDER = (
    "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus",
)


@query(
    "dedup_latest",
    f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
          PARTITION BY l_orderkey, l_linenumber ORDER BY {", ".join(c + " DESC" for c in _LINE_ORDER)}) AS rn
        FROM lineitem) WHERE rn = 1""",
)
def dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return keep_latest(lines, ["l_orderkey", "l_linenumber"], [F.desc(c) for c in _LINE_ORDER])


@query("staged_visits", f"{sql.VISITS} SELECT * FROM stg_visits")
def visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged_visits(raw_visits(spark, sf_dir)).drop("archivo_origen")


@query("station_day_avg", f"{sql.AIR} SELECT * FROM stg_air")
def station_day_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged_air(raw_air(spark, sf_dir)).drop("parametro")


@query(
    "alias_join",
    f"""{sql.VISITS}, {sql.PLACES} SELECT numero_fila, ubigeo, num_atenciones
        FROM stg_visits JOIN aliases ON distrito_reportado = alias_normalizado""",
)
def alias_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = staged_visits(raw_visits(spark, sf_dir))
    mapped = resolve_alias(staged, spellings(spark, sf_dir), "distrito_reportado", "alias_normalizado")
    return mapped.select("numero_fila", "ubigeo", "num_atenciones")


@query(
    "unmapped_values",
    f"""{sql.VISITS}, {sql.PLACES} SELECT distrito_reportado, count(*) AS filas FROM stg_visits
        WHERE distrito_reportado NOT IN (SELECT alias_normalizado FROM aliases) GROUP BY distrito_reportado""",
)
def unmapped_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = staged_visits(raw_visits(spark, sf_dir))
    return unmatched_values(staged, "distrito_reportado", spellings(spark, sf_dir), "alias_normalizado")


@query("conditional_sums", f"{sql.VISITS_PLACES} SELECT * FROM place_visits")
def conditional_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    return visits_by_district(staged_visits(raw_visits(spark, sf_dir)), spellings(spark, sf_dir))


@query(
    "distinct_count",
    """SELECT l_shipdate AS dia, l_returnflag, count(DISTINCT l_suppkey) AS proveedores, count(*) AS lineas
       FROM lineitem GROUP BY l_shipdate, l_returnflag""",
)
def distinct_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return lines.groupBy(F.col("l_shipdate").alias("dia"), "l_returnflag").agg(
        F.countDistinct("l_suppkey").alias("proveedores"), F.count(F.lit(1)).alias("lineas")
    )


_SUPPLIER_PLACES = f"""
stations AS (
  SELECT s_suppkey, -12.0::DOUBLE + (s_suppkey % 40) / 64.0::DOUBLE AS slat,
         -77.0::DOUBLE + ((s_suppkey // 40) % 40) / 64.0::DOUBLE AS slon FROM supplier),
{sql.PLACES},
pairs AS (
  SELECT s_suppkey, ubigeo, {sql.distance("latitud", "longitud", "slat", "slon")} AS d
  FROM stations CROSS JOIN places)"""


@query(
    "radius_join",
    f"WITH {_SUPPLIER_PLACES} SELECT s_suppkey, ubigeo, round(d, 3) AS distancia_km FROM pairs WHERE d <= 10",
)
def radius_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    stations = table(spark, sf_dir, "supplier").select(
        "s_suppkey", station_latitude("s_suppkey").alias("slat"), station_longitude("s_suppkey").alias("slon")
    )
    pairs = radius_pairs(
        stations,
        places(spark, sf_dir),
        DEFAULTS.station_radius_km,
        point_position=("slat", "slon"),
        place_position=("latitud", "longitud"),
    )
    return pairs.select("s_suppkey", "ubigeo", F.round("distancia_km", 3).alias("distancia_km"))


@query("nearest_station", f"{sql.AIR_PLACES} SELECT * FROM place_air")
def nearest_station(spark: SparkSession, sf_dir: str) -> DataFrame:
    return air_by_district(staged_air(raw_air(spark, sf_dir)), places(spark, sf_dir))


# --------------------------------------------- grid over order days and segments
def _order_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").withColumn("fecha", F.col("o_orderdate").cast("date"))


def _segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("segmento")).distinct()


def _segment_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per day and segment."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_mktsegment").alias("segmento"))
    joined = _order_days(spark, sf_dir).join(customers, F.col("o_custkey") == F.col("c_custkey"))
    return joined.groupBy("fecha", "segmento").agg(F.count(F.lit(1)).alias("pedidos"))


def _segment_reading(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reading for the segments of odd-keyed urgent orders."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_mktsegment").alias("segmento"))
    urgent = _order_days(spark, sf_dir).where("o_orderpriority = '1-URGENT' and o_orderkey % 2 = 1")
    return (
        urgent.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("fecha", "segmento")
        .agg(F.max(F.floor(F.col("o_totalprice") / 5000)).cast("double").alias("lectura"))
    )


def _filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid = dense_grid(
        calendar_of((_order_days(spark, sf_dir), "fecha")), _segments(spark, sf_dir), "segmento"
    )
    counts, readings = _segment_counts(spark, sf_dir), _segment_reading(spark, sf_dir)
    return fill_grid(grid, ["fecha", "segmento"], counts, ["pedidos"], readings)


_GRID_SQL = f"""
days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS fecha FROM orders),
segments AS (SELECT DISTINCT c_mktsegment AS segmento FROM customer),
counts AS (
  SELECT CAST(o_orderdate AS DATE) AS fecha, c_mktsegment AS segmento, count(*) AS pedidos
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL),
readings AS (
  SELECT CAST(o_orderdate AS DATE) AS fecha, c_mktsegment AS segmento, max(floor(o_totalprice / 5000)) AS lectura
  FROM orders JOIN customer ON o_custkey = c_custkey
  WHERE o_orderpriority = '1-URGENT' AND o_orderkey % 2 = 1 GROUP BY ALL),
filled AS (
  SELECT d.fecha, s.segmento, coalesce(c.pedidos, 0) AS pedidos, r.lectura,
         {sql.CATEGORY.format("r.lectura")} AS categoria
  FROM days d CROSS JOIN segments s
  LEFT JOIN counts c ON c.fecha = d.fecha AND c.segmento = s.segmento
  LEFT JOIN readings r ON r.fecha = d.fecha AND r.segmento = s.segmento),
{sql.trailing("filled", "trend", "segmento", "pedidos", "categoria")}"""


@query(
    "calendar_union",
    "SELECT CAST(o_orderdate AS DATE) AS fecha FROM orders UNION SELECT CAST(l_shipdate AS DATE) FROM lineitem",
)
def calendar_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_shipdate").cast("date").alias("fecha"))
    return calendar_of((_order_days(spark, sf_dir), "fecha"), (lines, "fecha"))


@query("dense_grid", f"WITH {_GRID_SQL} SELECT fecha, segmento FROM days CROSS JOIN segments")
def grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dense_grid(calendar_of((_order_days(spark, sf_dir), "fecha")), _segments(spark, sf_dir), "segmento")


@query("grid_fill", f"WITH {_GRID_SQL} SELECT fecha, segmento, pedidos, lectura FROM filled")
def grid_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _filled(spark, sf_dir)


def _trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_trailing(_filled(spark, sf_dir), "segmento", "fecha", "pedidos", DEFAULTS.trailing_rows)


@query(
    "prior7_avg",
    f"""WITH {_GRID_SQL} SELECT fecha, segmento, pedidos, promedio_atenciones_7d_previos AS promedio,
        CAST(sum(pedidos) OVER w AS BIGINT) AS suma, count(pedidos) OVER w AS filas FROM trend
        WINDOW w AS (PARTITION BY segmento ORDER BY fecha ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)""",
)
def prior7_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _trend(spark, sf_dir).select(
        "fecha", "segmento", "pedidos", trailing_average().alias("promedio"),
        F.col(SUM).alias("suma"), F.col(ROWS).alias("filas"),
    )


@query(
    "prior7_days_avg",
    f"""WITH {_GRID_SQL} SELECT fecha, segmento, CAST(sum(pedidos) OVER w AS BIGINT) AS suma,
        count(pedidos) OVER w AS filas FROM filled
        WINDOW w AS (PARTITION BY segmento ORDER BY fecha
                     RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND INTERVAL 1 DAYS PRECEDING)""",
)
def prior7_days_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = with_trailing(_filled(spark, sf_dir), "segmento", "fecha", "pedidos", 7, by_days=True)
    return filled.select("fecha", "segmento", F.col(SUM).alias("suma"), F.col(ROWS).alias("filas"))


@query("pct_vs_prior7", f"WITH {_GRID_SQL} SELECT fecha, segmento, variacion_vs_7d_pct AS variacion FROM trend")
def pct_vs_prior7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _trend(spark, sf_dir).select("fecha", "segmento", percent_change("pedidos").alias("variacion"))


@query("alert_flag", f"WITH {_GRID_SQL} SELECT fecha, segmento, categoria, alerta_salud_publica AS alerta FROM trend")
def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    trend = _trend(spark, sf_dir).withColumn("categoria", air_category("lectura", DEFAULTS))
    return trend.select("fecha", "segmento", "categoria", alert_flag("pedidos", "categoria", DEFAULTS).alias("alerta"))


def _reading() -> Column:
    return F.when(F.col("o_orderkey") % 11 != 0, F.col("o_totalprice") / 5000)


@query(
    "threshold_category",
    "SELECT o_orderkey, "
    + sql.CATEGORY.format("(CASE WHEN o_orderkey % 11 <> 0 THEN o_totalprice / 5000 END)")
    + " AS categoria FROM orders",
)
def threshold_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", air_category(_reading(), DEFAULTS).alias("categoria"))
