"""SQL over the shared test tables that mirrors ``tables.py`` and ``plans.models``."""

from __future__ import annotations

RAW_VISITS = """
raw_visits AS (
  SELECT CAST(ts AS DATE) AS fecha_atencion,
         ' cli-' || CAST(user_id % 4 AS VARCHAR) AS codigo_clinica,
         CASE user_id % 3
           WHEN 0 THEN ' Nación  ' || CAST(user_id % 25 AS VARCHAR) || ' '
           WHEN 1 THEN 'NACION ' || CAST(user_id % 25 AS VARCHAR)
           ELSE 'N.' || CAST(user_id % 25 AS VARCHAR) END AS distrito,
         CASE event_type WHEN 'view' THEN '0-4' WHEN 'click' THEN '5-17'
           WHEN 'purchase' THEN '18-59' WHEN 'signup' THEN '60 +' ELSE '60+' END AS grupo_edad,
         CASE event_id % 4 WHEN 0 THEN 'j45' WHEN 1 THEN 'J18.9 ' WHEN 2 THEN 'J06' ELSE 'J12' END
           AS diagnostico_cie10,
         CAST(floor(value) AS BIGINT) AS num_atenciones,
         event_id AS numero_fila,
         date_trunc('day', ts) AS cargado_en
  FROM events)"""

STAGED_VISITS = """
stg_visits AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (
        PARTITION BY fecha_atencion, codigo_clinica, distrito_reportado, grupo_edad, diagnostico_cie10
        ORDER BY cargado_en DESC, numero_fila DESC) AS rn
    FROM (
      SELECT fecha_atencion,
             upper(trim(codigo_clinica)) AS codigo_clinica,
             regexp_replace(upper(trim(translate(distrito, 'áéíóúüñÁÉÍÓÚÜÑ', 'aeiouunAEIOUUN'))),
                            '\\s+', ' ', 'g') AS distrito_reportado,
             replace(grupo_edad, ' ', '') AS grupo_edad,
             upper(trim(diagnostico_cie10)) AS diagnostico_cie10,
             left(upper(trim(diagnostico_cie10)), 3) AS categoria_cie10,
             num_atenciones, numero_fila, cargado_en
      FROM raw_visits))
  WHERE rn = 1)"""

RAW_AIR = """
raw_air AS (
  SELECT DATE '2024-01-01' + CAST(date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) % 30 AS INTEGER)
           AS fecha,
         CAST(l_suppkey AS VARCHAR) AS estacion_id,
         'Estacion ' || CAST(l_suppkey AS VARCHAR) AS estacion_nombre,
         -12.0::DOUBLE + (l_suppkey % 40) / 64.0::DOUBLE AS latitud,
         -77.0::DOUBLE + ((l_suppkey // 40) % 40) / 64.0::DOUBLE AS longitud,
         CAST(l_linenumber AS VARCHAR) AS sensor_id,
         CASE WHEN l_linenumber <> 7 THEN CAST(l_quantity AS BIGINT) * (l_suppkey % 4) END AS valor,
         CAST(round(l_discount * 1000) AS BIGINT) AS cobertura,
         CASE WHEN l_linestatus = 'O' THEN 'openaq' ELSE 'simulada' END AS fuente,
         l_shipdate AS cargado_en
  FROM lineitem WHERE l_returnflag <> 'A')"""

# averages are rounded half up on exact integers
STAGED_AIR = """
stg_air AS (
  SELECT fecha, estacion_id, max(estacion_nombre) AS estacion_nombre,
         avg(latitud) AS latitud, avg(longitud) AS longitud,
         CAST((sum(valor) * 200 + count(*)) // (2 * count(*)) AS DOUBLE) / 100 AS pm25_promedio_24h,
         CAST((sum(cobertura) * 20 + count(*)) // (2 * count(*)) AS DOUBLE) / 10 AS cobertura_pct,
         CAST(count(DISTINCT sensor_id) AS BIGINT) AS sensores,
         max(fuente) AS fuente, max(cargado_en) AS cargado_en
  FROM raw_air WHERE valor IS NOT NULL GROUP BY fecha, estacion_id)"""

PLACES = """
places AS (
  SELECT lpad(CAST(n_nationkey AS VARCHAR), 6, '0') AS ubigeo, n_name AS distrito, r_name AS zona,
         -12.0::DOUBLE + (n_nationkey * 7 % 40) / 64.0::DOUBLE + 3 / 1024.0::DOUBLE
           + CASE WHEN n_nationkey % 5 = 4 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS latitud,
         -77.0::DOUBLE + (n_nationkey % 3) / 64.0::DOUBLE + 5 / 1024.0::DOUBLE AS longitud
  FROM nation JOIN region ON n_regionkey = r_regionkey),
aliases AS (
  SELECT 'NACION ' || CAST(n_nationkey AS VARCHAR) AS alias_normalizado,
         lpad(CAST(n_nationkey AS VARCHAR), 6, '0') AS ubigeo FROM nation WHERE n_nationkey % 8 <> 7
  UNION ALL
  SELECT 'N.' || CAST(n_nationkey AS VARCHAR), lpad(CAST(n_nationkey AS VARCHAR), 6, '0')
  FROM nation WHERE n_nationkey % 8 <> 7)"""

BY_PLACE = """
place_visits AS (
  SELECT fecha_atencion AS fecha, ubigeo,
         CAST(sum(num_atenciones) AS BIGINT) AS total_atenciones,
         CAST(sum(CASE WHEN grupo_edad = '0-4' THEN num_atenciones ELSE 0 END) AS BIGINT) AS atenciones_menores_5,
         CAST(sum(CASE WHEN grupo_edad = '60+' THEN num_atenciones ELSE 0 END) AS BIGINT)
           AS atenciones_adultos_mayores,
         CAST(sum(CASE WHEN categoria_cie10 = 'J45' THEN num_atenciones ELSE 0 END) AS BIGINT) AS atenciones_asma,
         CAST(sum(CASE WHEN categoria_cie10 BETWEEN 'J12' AND 'J18' THEN num_atenciones ELSE 0 END) AS BIGINT)
           AS atenciones_neumonia,
         CAST(count(DISTINCT codigo_clinica) AS BIGINT) AS clinicas_reportantes
  FROM stg_visits JOIN aliases ON distrito_reportado = alias_normalizado GROUP BY fecha_atencion, ubigeo)"""


def distance(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (
        f"2 * 6371.0 * asin(sqrt(least(1.0, power(sin((radians({lat2}) - radians({lat1})) / 2), 2) + "
        f"cos(radians({lat1})) * cos(radians({lat2})) * "
        f"power(sin((radians({lon2}) - radians({lon1})) / 2), 2))))"
    )


BY_PLACE_AIR = f"""
place_air AS (
  SELECT fecha, ubigeo, estacion_id AS estacion_referencia_id, estacion_nombre AS estacion_referencia,
         round(distancia_km, 2) AS distancia_estacion_km, pm25_promedio_24h, fuente AS fuente_calidad_aire
  FROM (
    SELECT *, row_number() OVER (PARTITION BY fecha, ubigeo ORDER BY distancia_km, estacion_id) AS rn
    FROM (SELECT s.fecha, p.ubigeo, s.estacion_id, s.estacion_nombre, s.pm25_promedio_24h, s.fuente,
                 {distance("p.latitud", "p.longitud", "s.latitud", "s.longitud")} AS distancia_km
          FROM stg_air s CROSS JOIN places p WHERE s.cobertura_pct >= 50)
    WHERE distancia_km <= 10)
  WHERE rn = 1)"""


def trailing(source: str, target: str, key: str, value: str, category: str | None = None) -> str:
    """Prior-7 comparison of ``source``; exact integer arithmetic."""
    alert = (
        f"coalesce({category} IN ('SOBRE_GUIA_OMS', 'SOBRE_ECA_PERU') AND s7 > 0 "
        f"AND {value} * n7 * 100 >= s7 * 120, false)"
        if category
        else f"coalesce(s7 > 0 AND {value} * n7 * 100 >= s7 * 120, false)"
    )
    return f"""
{target} AS (
  SELECT * EXCLUDE (s7, n7),
         CASE WHEN n7 > 0 THEN CAST((s7 * 20 + n7) // (2 * n7) AS DOUBLE) / 10 END AS promedio_atenciones_7d_previos,
         CASE WHEN s7 > 0 THEN CAST(sign({value} * n7 - s7) AS BIGINT) *
           ((abs({value} * n7 - s7) * 2000 + s7) // (2 * s7)) / 10.0::DOUBLE END AS variacion_vs_7d_pct,
         {alert} AS alerta_salud_publica
  FROM (SELECT *,
          CAST(sum({value}) OVER w AS BIGINT) AS s7,
          count({value}) OVER w AS n7
        FROM {source}
        WINDOW w AS (PARTITION BY {key} ORDER BY fecha ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)))"""


CATEGORY = (
    "CASE WHEN {0} IS NULL THEN 'SIN_COBERTURA' WHEN {0} <= 15 THEN 'DENTRO_GUIA_OMS' "
    "WHEN {0} <= 50 THEN 'SOBRE_GUIA_OMS' ELSE 'SOBRE_ECA_PERU' END"
)

FACT = f"""
calendar AS (SELECT fecha FROM place_visits UNION SELECT fecha FROM place_air),
joined AS (
  SELECT c.fecha, p.ubigeo, p.distrito, p.zona,
         coalesce(v.total_atenciones, 0) AS total_atenciones,
         coalesce(v.atenciones_menores_5, 0) AS atenciones_menores_5,
         coalesce(v.atenciones_adultos_mayores, 0) AS atenciones_adultos_mayores,
         coalesce(v.atenciones_asma, 0) AS atenciones_asma,
         coalesce(v.atenciones_neumonia, 0) AS atenciones_neumonia,
         coalesce(v.clinicas_reportantes, 0) AS clinicas_reportantes,
         a.pm25_promedio_24h, {CATEGORY.format("a.pm25_promedio_24h")} AS categoria_aire,
         a.estacion_referencia, a.distancia_estacion_km, a.fuente_calidad_aire
  FROM calendar c CROSS JOIN places p
  LEFT JOIN place_visits v ON v.fecha = c.fecha AND v.ubigeo = p.ubigeo
  LEFT JOIN place_air a ON a.fecha = c.fecha AND a.ubigeo = p.ubigeo),
{trailing("joined", "fact", "ubigeo", "total_atenciones", "categoria_aire")}"""

VISITS = f"WITH {RAW_VISITS}, {STAGED_VISITS}"
AIR = f"WITH {RAW_AIR}, {STAGED_AIR}"
VISITS_PLACES = f"{VISITS}, {PLACES}, {BY_PLACE}"
AIR_PLACES = f"{AIR}, {PLACES}, {BY_PLACE_AIR}"
ALL = f"WITH {RAW_VISITS}, {STAGED_VISITS}, {RAW_AIR}, {STAGED_AIR}, {PLACES}, {BY_PLACE}, {BY_PLACE_AIR}, {FACT}"
