"""The finished table, questions asked of it, its report and its checks."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..fixed_values import (
    AGE_GROUPS,
    AIR_CATEGORIES,
    AIR_SOURCES,
    CATEGORY_LABELS,
    DISTRICT_ALIASES,
    DISTRICTS,
    REPORT_CRITERIA,
    REPORT_TABLE_HEAD,
    REPORT_TABLE_RULE,
    REPORT_TITLE,
    ZONES,
)
from ..functions.text import normalize_text
from ..operators.consumption import category_profile, latest_alerts, zone_ranking
from ..operators.quality import (
    duplicates,
    freshness,
    is_null,
    negative,
    not_accepted,
    orphans,
    out_of_range,
    repeated_values,
    run_checks,
)
from ..operators.reconcile import reconcile_totals
from ..operators.report import report_header, report_lines, report_rows
from ..operators.resolve import resolve_alias
from ..plans.checks import declared_checks
from ..plans.models import build_models, place_dimension
from ..plans.refresh import refreshed_rows
from ..plans.stored_checks import models_of_days, store_all_states, store_states, stored_results
from ..sources import daytable
from ..sources.catalogue import district_aliases, districts
from ..sources.lake import replace_days
from ..sources.scratch import new_folder
from . import derived_sql as sql
from .registry import query
from .tables import models, places, raw_air, raw_visits, spellings, table

_FACT_COLUMNS = (
    "fecha, ubigeo, distrito, zona, total_atenciones, atenciones_menores_5, atenciones_adultos_mayores, "
    "atenciones_asma, atenciones_neumonia, clinicas_reportantes, pm25_promedio_24h, categoria_aire, "
    "estacion_referencia, distancia_estacion_km, fuente_calidad_aire, promedio_atenciones_7d_previos, "
    "variacion_vs_7d_pct, alerta_salud_publica"
)


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models(spark, sf_dir).fact.drop("actualizado_en")


query("place_day_fact", f"{sql.ALL} SELECT {_FACT_COLUMNS} FROM fact")(fact)


@query("mart_refresh", f"{sql.ALL} SELECT {_FACT_COLUMNS} FROM fact")
def mart_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table built without three days, then refreshed with them, equals a full build."""
    visits, air, area, names = (f(spark, sf_dir) for f in (raw_visits, raw_air, places, spellings))
    late = [dt.date(2024, 1, d) for d in (4, 5, 20)]
    first = build_models(
        visits.where(~F.col("fecha_atencion").isin(late)), air.where(~F.col("fecha").isin(late)), area, names
    ).fact
    folder = new_folder(spark, "mart")
    first.write.partitionBy("fecha").parquet(folder)
    rows, days = refreshed_rows(visits, air, spark.read.schema(first.schema).parquet(folder), late, area, names)
    replace_days(rows, folder, "fecha", days)
    return spark.read.schema(first.schema).parquet(folder).drop("actualizado_en")


@query("dim_place", f"WITH {sql.PLACES} SELECT * FROM places")
def dim_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    return place_dimension(places(spark, sf_dir))


def _values(rows: tuple[tuple, ...]) -> str:
    quoted = lambda v: "'" + v.replace("'", "''") + "'" if isinstance(v, str) else repr(v)
    return ", ".join("(" + ", ".join(quoted(v) for v in r) + ")" for r in rows)


_SPELT = tuple((i, alias, ubigeo) for i, (alias, ubigeo) in enumerate(DISTRICT_ALIASES))


@query(
    "catalogue_resolve",
    f"""WITH names(i, alias, ubigeo) AS (VALUES {_values(_SPELT)}),
        area(ubigeo, distrito, zona, latitud, longitud) AS (VALUES {_values(DISTRICTS)}),
        spelt AS (SELECT c_acctbal, c_custkey % {len(_SPELT) + 3} AS i FROM customer)
        SELECT area.ubigeo, distrito, zona, latitud, longitud, count(spelt.i) AS clientes,
               count(DISTINCT spelt.i) AS grafias, CAST(coalesce(sum(round(c_acctbal)), 0) AS BIGINT) AS saldo
        FROM area LEFT JOIN names ON names.ubigeo = area.ubigeo LEFT JOIN spelt ON spelt.i = names.i
        GROUP BY ALL""",
)
def catalogue_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers under every spelling of the catalogue's aliases, and some unknown, counted per catalogued place."""
    which = F.col("c_custkey") % (len(_SPELT) + 3)
    known = F.get(F.array(*(F.lit(f"  {alias.lower().replace(' ', '  ')} ") for _, alias, _ in _SPELT)), which.cast("int"))
    spelt = table(spark, sf_dir, "customer").select(
        normalize_text(F.coalesce(known, F.lit("nowhere"))).alias("texto"), F.round("c_acctbal").cast("bigint").alias("saldo")
    )
    found = resolve_alias(spelt, district_aliases(spark), "texto", "alias_normalizado").groupBy("ubigeo").agg(
        F.count(F.lit(1)).alias("clientes"), F.count_distinct("texto").alias("grafias"), F.sum("saldo").alias("saldo")
    )
    return place_dimension(districts(spark)).join(found, "ubigeo", "left").fillna(0, ["clientes", "grafias", "saldo"])


@query(
    "latest_alerts",
    f"""{sql.ALL} SELECT fecha, distrito, zona, total_atenciones, pm25_promedio_24h, categoria_aire,
        variacion_vs_7d_pct, row_number() OVER (ORDER BY pm25_promedio_24h DESC NULLS LAST, distrito) AS posicion
        FROM fact WHERE fecha = (SELECT max(fecha) FROM fact) AND alerta_salud_publica""",
)
def alerts_of_last_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_alerts(fact(spark, sf_dir))


@query(
    "category_profile",
    f"""{sql.ALL} SELECT *, row_number() OVER (ORDER BY atenciones_promedio DESC, categoria_aire) AS posicion FROM (
        SELECT categoria_aire, count(*) AS distrito_dias,
        CAST((sum(total_atenciones) * 20 + count(*)) // (2 * count(*)) AS DOUBLE) / 10 AS atenciones_promedio,
        CAST((sum(atenciones_menores_5) * 20 + count(*)) // (2 * count(*)) AS DOUBLE) / 10 AS menores_5_promedio
        FROM fact WHERE fecha >= DATE '2024-02-05' - 30 GROUP BY categoria_aire)""",
)
def profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return category_profile(fact(spark, sf_dir), F.lit("2024-02-05").cast("date"))


@query(
    "zone_ranking",
    f"""{sql.ALL} SELECT *, row_number() OVER (ORDER BY dias_sobre_oms DESC, zona) AS posicion FROM (
        SELECT zona,
        count(CASE WHEN categoria_aire IN ('SOBRE_GUIA_OMS', 'SOBRE_ECA_PERU') THEN 1 END) AS dias_sobre_oms,
        CAST(sum(total_atenciones) AS BIGINT) AS atenciones
        FROM fact WHERE date_trunc('month', fecha) = DATE '2024-01-01' GROUP BY zona)""",
)
def ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zone_ranking(fact(spark, sf_dir), F.lit("2024-01-20").cast("date"))


_HEADER_SQL = """
head AS (
  SELECT fecha, count(*) AS distritos, CAST(sum(total_atenciones) AS BIGINT) AS atenciones,
         count(pm25_promedio_24h) AS con_pm25, max(pm25_promedio_24h) AS peor_pm25,
         (SELECT min(distrito) FROM fact w WHERE w.fecha = f.fecha AND w.pm25_promedio_24h =
            (SELECT max(pm25_promedio_24h) FROM fact m WHERE m.fecha = f.fecha)) AS peor_distrito,
         count(CASE WHEN alerta_salud_publica THEN 1 END) AS alertas,
         coalesce(string_agg(CASE WHEN alerta_salud_publica THEN distrito END, ', ' ORDER BY distrito), '')
           AS en_alerta
  FROM fact f GROUP BY fecha)"""


@query("report_header", f"{sql.ALL}, {_HEADER_SQL} SELECT * FROM head")
def header(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report_header(fact(spark, sf_dir))


@query(
    "report_rows",
    f"""{sql.ALL} SELECT fecha, distrito, zona, total_atenciones, atenciones_menores_5, atenciones_adultos_mayores,
        pm25_promedio_24h, categoria_aire, variacion_vs_7d_pct, alerta_salud_publica,
        row_number() OVER (PARTITION BY fecha ORDER BY alerta_salud_publica DESC,
          CASE WHEN coalesce(pm25_promedio_24h, 0) = 0 THEN -1 ELSE pm25_promedio_24h END DESC,
          total_atenciones DESC, distrito) AS posicion FROM fact""",
)
def rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report_rows(fact(spark, sf_dir))


_LABELS = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in CATEGORY_LABELS.items())


def _one_decimal(value: str) -> str:
    # exact value of the double, rounded half to even, as the report formats it
    return f"printf('%.1f', {value})"


_LINES_SQL = f"""{sql.ALL}, {_HEADER_SQL},
fixed AS (
  SELECT fecha, unnest([1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 13, 14]) AS seccion,
    unnest(['# {REPORT_TITLE} — ' || CAST(fecha AS VARCHAR), '',
      '- Distritos analizados: **' || distritos || '**',
      '- Atenciones respiratorias reportadas: **' || atenciones || '**',
      '- Distritos con medicion de PM2.5: **' || con_pm25 || '**',
      CASE WHEN con_pm25 > 0 THEN '- Mayor PM2.5 del dia: **' || {_one_decimal("peor_pm25")} || ' µg/m³** en '
        || peor_distrito END,
      '- Distritos en ALERTA de salud publica: **' || alertas || '**',
      CASE WHEN alertas > 0 THEN '  - ' || en_alerta END, '',
      '{REPORT_TABLE_HEAD}', '{REPORT_TABLE_RULE}', '', '{REPORT_CRITERIA}']) AS linea
  FROM head)
SELECT fecha, seccion, linea FROM fixed WHERE linea IS NOT NULL
UNION ALL
SELECT fecha, 12, '| ' || distrito || ' | ' || zona || ' | ' || total_atenciones || ' | ' || atenciones_menores_5
  || ' | ' || atenciones_adultos_mayores || ' | '
  || CASE WHEN pm25_promedio_24h IS NULL THEN '-' ELSE {_one_decimal("pm25_promedio_24h")} END || ' | '
  || CASE categoria_aire {_LABELS} END || ' | '
  || CASE WHEN variacion_vs_7d_pct IS NULL THEN '-' ELSE printf('%+.1f', variacion_vs_7d_pct) || '%' END || ' | '
  || CASE WHEN alerta_salud_publica THEN 'SI' ELSE 'no' END || ' |'
FROM fact"""


@query("report_lines", _LINES_SQL)
def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report_lines(fact(spark, sf_dir)).select("fecha", "seccion", "linea")


# -------------------------------------------------------------------- checks
@query(
    "reconcile_totals",
    f"""{sql.ALL},
    a AS (SELECT fecha_atencion AS fecha, sum(num_atenciones) AS total_staging FROM stg_visits
          JOIN aliases ON distrito_reportado = alias_normalizado GROUP BY 1),
    b AS (SELECT fecha, sum(total_atenciones) AS total_mart FROM fact
          WHERE ubigeo <> '000003' AND fecha <> DATE '2024-01-09' GROUP BY 1)
    SELECT coalesce(a.fecha, b.fecha) AS fecha, CAST(coalesce(total_staging, 0) AS BIGINT) AS total_staging,
           CAST(coalesce(total_mart, 0) AS BIGINT) AS total_mart
    FROM a FULL JOIN b ON a.fecha = b.fecha
    WHERE coalesce(total_staging, 0) <> coalesce(total_mart, 0)""",
)
def reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table that lost one place and one day must not reconcile."""
    m = models(spark, sf_dir)
    mapped = resolve_alias(m.visits, spellings(spark, sf_dir), "distrito_reportado", "alias_normalizado")
    damaged = m.fact.where("ubigeo <> '000003' and fecha <> date'2024-01-09'")
    return reconcile_totals(mapped, "fecha_atencion", "num_atenciones", damaged, "fecha", "total_atenciones")


@query(
    "dq_unique_combo",
    """SELECT l_orderkey, l_linenumber, count(*) AS repeticiones FROM lineitem
       GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
)
def dq_unique_combo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicates(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("dq_unique", "SELECT o_custkey, count(*) AS repeticiones FROM orders GROUP BY 1 HAVING count(*) > 1")
def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_values(table(spark, sf_dir, "orders"), "o_custkey")


@query("dq_non_negative", "SELECT o_orderkey, o_totalprice - 100000 AS saldo FROM orders WHERE o_totalprice - 100000 < 0")
def dq_non_negative(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_totalprice") - 100000).alias("saldo"))
    return orders.where(negative("saldo"))


@query("dq_in_range", "SELECT event_id, value FROM events WHERE value < 1 OR value > 100")
def dq_in_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").where(out_of_range("value", 1, 100)).select("event_id", "value")


@query(
    "dq_not_null",
    "SELECT doc_id, quality FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NULL",
)
def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return documents.join(labels, "doc_id", "left").where(is_null("quality")).select("doc_id", "quality")


@query(
    "dq_accepted",
    """SELECT o_orderpriority, count(*) AS filas FROM orders
       WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM') GROUP BY 1""",
)
def dq_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return not_accepted(table(spark, sf_dir, "orders"), "o_orderpriority", ("1-URGENT", "2-HIGH", "3-MEDIUM"))


@query(
    "dq_relationships",
    """SELECT o_custkey, count(*) AS filas FROM orders
       WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'MACHINERY') GROUP BY 1""",
)
def dq_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    parents = table(spark, sf_dir, "customer").where("c_mktsegment <> 'MACHINERY'")
    return orphans(table(spark, sf_dir, "orders"), "o_custkey", parents, "c_custkey")


@query(
    "freshness",
    """SELECT max(ts) AS ultimo,
         (epoch_us(TIMESTAMP '2024-02-01 18:00:00') - epoch_us(max(ts))) / 3600000000 AS antiguedad_horas,
         CASE WHEN epoch_us(TIMESTAMP '2024-02-01 18:00:00') - epoch_us(max(ts)) > 72 * 3600000000 THEN 'error'
              WHEN epoch_us(TIMESTAMP '2024-02-01 18:00:00') - epoch_us(max(ts)) > 36 * 3600000000 THEN 'warn'
              ELSE 'pass' END AS estado FROM events""",
)
def freshness_of_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    as_of = F.lit("2024-02-01 18:00:00").cast("timestamp_ntz")
    return freshness(table(spark, sf_dir, "events"), "ts", as_of)


def _checks_sql() -> str:
    """One SELECT per declared check: table, check, severity, failures."""
    parts: list[str] = []

    def add(where: str, name: str, failures: str, severity: str = "error") -> None:
        parts.append(
            f"SELECT '{where}' AS tabla, '{name}' AS prueba, '{severity}' AS severidad, ({failures}) AS fallas"
        )

    def filled(where: str, source: str, *columns: str) -> None:
        for c in columns:
            add(where, f"no_nulo_{c}", f"SELECT count(*) FROM {source} WHERE {c} IS NULL")

    def single(where: str, source: str, name: str, columns: str) -> None:
        add(where, name, f"SELECT count(*) FROM (SELECT {columns} FROM {source} WHERE {columns.split(',')[0]} IS NOT "
                         f"NULL GROUP BY {columns} HAVING count(*) > 1)")

    def domain(where: str, source: str, column: str, values: tuple[str, ...]) -> None:
        listed = ", ".join(f"'{v}'" for v in values)
        add(where, f"dominio_{column}", f"SELECT count(DISTINCT {column}) FROM {source} WHERE {column} NOT IN ({listed})")

    def related(where: str, source: str, column: str, parent: str, key: str, name: str, severity: str = "error") -> None:
        add(where, name, f"SELECT count(DISTINCT {column}) FROM {source} WHERE {column} NOT IN "
                         f"(SELECT {key} FROM {parent})", severity)

    def at_least_zero(where: str, source: str, column: str) -> None:
        add(where, f"no_negativo_{column}", f"SELECT count(*) FROM {source} WHERE {column} < 0")

    def ranged(where: str, source: str, column: str, low: float, high: float) -> None:
        add(where, f"rango_{column}", f"SELECT count(*) FROM {source} WHERE {column} < {low} OR {column} > {high}")

    filled("distritos", "places", "ubigeo")
    single("distritos", "places", "unico_ubigeo", "ubigeo")
    domain("distritos", "places", "zona", ZONES)
    filled("alias_distritos", "aliases", "alias_normalizado", "ubigeo")
    single("alias_distritos", "aliases", "unico_alias_normalizado", "alias_normalizado")
    related("alias_distritos", "aliases", "ubigeo", "places", "ubigeo", "relacion_ubigeo")
    key = "fecha_atencion, codigo_clinica, distrito_reportado, grupo_edad, diagnostico_cie10"
    filled("stg_atenciones", "stg_visits", "fecha_atencion", "distrito_reportado", "num_atenciones")
    at_least_zero("stg_atenciones", "stg_visits", "num_atenciones")
    single("stg_atenciones", "stg_visits", "combinacion_unica", key)
    related("stg_atenciones", "stg_visits", "distrito_reportado", "aliases", "alias_normalizado",
            "distritos_sin_mapear", "warn")
    domain("stg_atenciones", "stg_visits", "grupo_edad", AGE_GROUPS)
    filled("stg_mediciones_aire", "stg_air", "fecha", "estacion_id", "pm25_promedio_24h")
    ranged("stg_mediciones_aire", "stg_air", "pm25_promedio_24h", 0, 1000)
    single("stg_mediciones_aire", "stg_air", "combinacion_unica", "fecha, estacion_id")
    domain("stg_mediciones_aire", "stg_air", "fuente", AIR_SOURCES)
    filled("int_atenciones_distrito_dia", "place_visits", "ubigeo", "total_atenciones")
    at_least_zero("int_atenciones_distrito_dia", "place_visits", "total_atenciones")
    single("int_atenciones_distrito_dia", "place_visits", "combinacion_unica", "fecha, ubigeo")
    related("int_atenciones_distrito_dia", "place_visits", "ubigeo", "places", "ubigeo", "relacion_ubigeo")
    ranged("int_pm25_distrito_dia", "place_air", "distancia_estacion_km", 0, 10)
    filled("int_pm25_distrito_dia", "place_air", "pm25_promedio_24h")
    single("int_pm25_distrito_dia", "place_air", "combinacion_unica", "fecha, ubigeo")
    filled("dim_distrito", "places", "ubigeo")
    single("dim_distrito", "places", "unico_ubigeo", "ubigeo")
    filled("fct_distrito_dia", "fact", "fecha", "ubigeo", "total_atenciones", "categoria_aire", "alerta_salud_publica")
    at_least_zero("fct_distrito_dia", "fact", "total_atenciones")
    ranged("fct_distrito_dia", "fact", "pm25_promedio_24h", 0, 1000)
    single("fct_distrito_dia", "fact", "combinacion_unica", "fecha, ubigeo")
    related("fct_distrito_dia", "fact", "ubigeo", "places", "ubigeo", "relacion_ubigeo")
    domain("fct_distrito_dia", "fact", "categoria_aire", AIR_CATEGORIES)
    add("conciliacion", "conciliacion_atenciones",
        "SELECT count(*) FROM (SELECT fecha_atencion AS f, sum(num_atenciones) AS a FROM stg_visits JOIN aliases "
        "ON distrito_reportado = alias_normalizado GROUP BY 1) x FULL JOIN (SELECT fecha AS f, "
        "sum(total_atenciones) AS b FROM fact GROUP BY 1) y ON x.f = y.f WHERE coalesce(a, 0) <> coalesce(b, 0)")
    body = " UNION ALL ".join(parts)
    return f"{sql.ALL} SELECT *, CASE WHEN fallas = 0 THEN 'pass' ELSE severidad END AS estado FROM ({body})"


@query("declared_checks", _checks_sql())
def all_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results of the 41 declared checks on the derived tables; the zone check fails there."""
    return run_checks(declared_checks(models(spark, sf_dir, keep_staged=True)))


@query("checks_of_stored_days", _checks_sql())
def checks_of_stored_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States of all days but three, then of those three and the days they touch; merged they equal the checks of all days."""
    visits, air, area, names = (f(spark, sf_dir) for f in (raw_visits, raw_air, places, spellings))
    late = [dt.date(2024, 1, d) for d in (4, 5, 20)]
    first = build_models(
        visits.where(~F.col("fecha_atencion").isin(late)), air.where(~F.col("fecha").isin(late)), area, names, keep_staged=True
    )
    mart, states = new_folder(spark, "mart"), new_folder(spark, "states")
    first.fact.write.partitionBy("fecha").parquet(mart)
    first = replace(first, fact=daytable.read(spark, mart, "fecha", first.fact.schema))
    store_all_states(first, states)
    rows, touched = refreshed_rows(visits, air, first.fact, late, area, names)
    daytable.replace_days(rows, mart, "fecha", touched)
    changed = spark.createDataFrame([(d,) for d in late], "fecha date")
    now = daytable.read(spark, mart, "fecha", first.fact.schema)
    store_states(models_of_days(visits, air, now, late, touched, area, names), states, changed, touched)
    return stored_results(spark, states, area, names)
