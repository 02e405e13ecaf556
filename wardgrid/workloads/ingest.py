"""File scans, sources, sinks and the landing stream over files written from the tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from .. import schemas
from ..functions.text import normalize_header
from ..operators.air_api import daily_readings, known_sensors, readings_of_days, select_sensors
from ..operators.ranking import with_position
from ..operators.validation import check_rows, quarantined_rows, rejection_summary, valid_rows, visit_rules
from ..params import DEFAULTS
from ..plans.pipeline import raw_visits
from ..sources import daytable
from ..sources.delimited import scan_delimited
from ..sources.lake import (
    layer_folder,
    list_objects,
    replace_days,
    replace_partition,
    retention_expired,
    with_lineage,
)
from ..sources.records import read_csv, read_json_lines, write_csv, write_json_lines
from ..sources.scratch import new_folder
from ..streaming.landing import ingest_landed
from .registry import query
from .tables import station_latitude, station_longitude, table

CHUNK = 1_000_000  # rows per written file, so that no file grows with the data
_CODES = ("J45", "J18.9", " j06", "Z00")
_GROUPS = ("0-4", "5-17", "18-59", "60 +", "bebes")
_HEADER = ("Fecha Atención", "Cod. Clínica", "Distrito", "Grupo Edad", "Diagnóstico CIE10", "N° Atenciones")
# event type -> separator, encoding, line end
_STYLES = {
    "view": (";", "ISO-8859-1", "\r"),
    "click": (",", "UTF-8", ""),
    "purchase": ("|", "UTF-8", "\r"),
    "signup": ("\t", "ISO-8859-1", ""),
    "error": (";", "UTF-8", ""),
}


def _per_style(part: int) -> Column:
    choice = F.lit(None).cast("string")
    for kind, style in _STYLES.items():
        choice = F.when(F.col("event_type") == kind, F.lit(style[part])).otherwise(choice)
    return choice


def _get(options: tuple[str, ...], index: Column) -> Column:
    return F.get(F.array(*(F.lit(o) for o in options)), index.cast("int"))


def dirty_fields(events: DataFrame) -> DataFrame:
    """The six raw fields of a visits file, with defects, for every event."""
    event = F.col("event_id")
    place = F.concat(F.lit("Peñón "), (F.col("user_id") % 25).cast("string"))
    note = F.concat(F.lit('La "Ñ"\n'), place)  # holds quotes and a line end
    return events.withColumns(
        {
            "f0": F.date_format("ts", "dd/MM/yyyy"),
            "f1": F.concat(F.lit("CLI-"), event.cast("string")),
            "f2": F.when((F.col("event_type") == "error") & (event % 7 == 0), note)
            .when(event % 31 == 0, " ")
            .otherwise(place),
            "f3": _get(_GROUPS, event % 5),
            "f4": _get(_CODES, event % 4),
            "f5": F.when(event % 13 == 0, "N/D")
            .when(event % 3 == 0, F.concat(F.floor("value").cast("string"), F.lit(".0")))
            .otherwise(F.floor("value").cast("string")),
        }
    )


def land_dirty_files(spark: SparkSession, sf_dir: str) -> str:
    """Write every event to files of five styles; blank lines follow every 50th event."""
    folder = new_folder(spark, "landing")
    events = table(spark, sf_dir, "events").withColumn("chunk", F.floor(F.col("event_id") / CHUNK))
    separator, ending = _per_style(0), _per_style(2)
    fields = [F.col(f"f{i}") for i in range(6)]
    quoted = [
        F.when(c.contains('"'), F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(c)
        for c in fields
    ]
    line = F.concat(F.concat_ws("\x00", *quoted))
    body = dirty_fields(events).select(
        "event_type",
        "chunk",
        F.posexplode(F.when(F.col("event_id") % 50 == 0, F.array(line, F.lit(""))).otherwise(F.array(line))).alias(
            "piece", "line"
        ),
        "event_id",
    )
    header = events.select("event_type", "chunk").distinct().select(
        "event_type", "chunk", F.lit(0).alias("piece"), F.lit("\x00".join(_HEADER)).alias("line"),
        F.lit(-1).cast("long").alias("event_id"),
    )
    text = F.concat(F.replace("line", F.lit("\x00"), separator), ending)
    latin = F.encode(text, "ISO-8859-1").cast("string")
    marked = F.when((F.col("event_type") == "click") & (F.col("event_id") == -1), F.concat(F.lit("﻿"), text))
    (
        body.unionByName(header)
        .withColumn("value", F.when(_per_style(1) == "UTF-8", F.coalesce(marked, text)).otherwise(latin))
        .repartition("event_type", "chunk")
        .sortWithinPartitions("event_type", "chunk", "event_id", "piece")
        .select("event_type", "chunk", "value")
        .write.partitionBy("event_type", "chunk")
        .text(folder)
    )
    return folder


def _origin(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "event_type": F.regexp_extract("path", "event_type=([a-z]+)", 1),
            "chunk": F.regexp_extract("path", "chunk=([0-9]+)", 1).cast("bigint"),
        }
    ).drop("path")


_DIRTY_SQL = f"""
dirty AS (
  SELECT event_id, event_type, event_id // {CHUNK} AS chunk,
         strftime(ts, '%d/%m/%Y') AS f0,
         'CLI-' || CAST(event_id AS VARCHAR) AS f1,
         CASE WHEN event_type = 'error' AND event_id % 7 = 0
                THEN 'La "Ñ"' || chr(10) || 'Peñón ' || CAST(user_id % 25 AS VARCHAR)
              WHEN event_id % 31 = 0 THEN ' '
              ELSE 'Peñón ' || CAST(user_id % 25 AS VARCHAR) END AS f2,
         CASE event_id % 5 WHEN 0 THEN '0-4' WHEN 1 THEN '5-17' WHEN 2 THEN '18-59' WHEN 3 THEN '60 +'
              ELSE 'bebes' END AS f3,
         CASE event_id % 4 WHEN 0 THEN 'J45' WHEN 1 THEN 'J18.9' WHEN 2 THEN ' j06' ELSE 'Z00' END AS f4,
         CASE WHEN event_id % 13 = 0 THEN 'N/D'
              WHEN event_id % 3 = 0 THEN CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) || '.0'
              ELSE CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) END AS f5,
         CAST(ts AS DATE) AS dia, CAST(floor(value) AS BIGINT) AS n
  FROM events)"""


@query(
    "scan_dirty_csv",
    f"""WITH {_DIRTY_SQL}
    SELECT event_type, chunk,
           1 + row_number() OVER w + count(CASE WHEN event_id % 50 = 0 THEN 1 END) OVER before AS record_number,
           f0 AS fecha_atencion, f1 AS codigo_clinica, f2 AS distrito, f3 AS grupo_edad,
           f4 AS diagnostico_cie10, f5 AS num_atenciones
    FROM dirty
    WINDOW w AS (PARTITION BY event_type, chunk ORDER BY event_id),
           before AS (PARTITION BY event_type, chunk ORDER BY event_id
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
)
def scan_dirty_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _origin(scan_delimited(spark, land_dirty_files(spark, sf_dir)).require_readable().records)


@query(
    "file_layout",
    f"""SELECT DISTINCT event_type, event_id // {CHUNK} AS chunk,
        CASE WHEN event_type IN ('view', 'signup') THEN 'cp1252' ELSE 'utf-8' END AS encoding,
        CASE event_type WHEN 'click' THEN ',' WHEN 'purchase' THEN '|' WHEN 'signup' THEN chr(9) ELSE ';' END
          AS separator,
        'fecha_atencion codigo_clinica distrito grupo_edad diagnostico_cie10 num_atenciones' AS header
        FROM events""",
)
def file_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = scan_delimited(spark, land_dirty_files(spark, sf_dir)).files
    return _origin(files.withColumn("header", F.array_join("header", " ")).drop("error"))


@query(
    "header_normalize",
    """SELECT doc_id, length(h) AS n, md5(h) AS digest FROM (
         SELECT doc_id, trim(regexp_replace(lower(regexp_replace(strip_accents(text), '[^\\x00-\\x7F]', '', 'g')),
                             '[^a-z0-9]+', '_', 'g'), '_') AS h FROM documents)""",
)
def header_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", normalize_header("text").alias("h"))
    return docs.select("doc_id", F.length("h").cast("bigint").alias("n"), F.md5(F.col("h").cast("binary")).alias("digest"))


@query("json_lines_roundtrip", "SELECT conv_id, turn, role, length(text) AS n, md5(text) AS digest FROM conversations")
def json_lines_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = table(spark, sf_dir, "conversations")
    folder = new_folder(spark, "json-lines")
    write_json_lines(source, folder)
    return _digested(read_json_lines(spark, folder, source.schema), "conv_id", "turn", "role")


@query(
    "csv_roundtrip",
    "SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang, length(text) AS n, md5(text) AS digest FROM documents",
)
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("doc_id", "lang", "text")
    folder = new_folder(spark, "csv")
    write_csv(table(spark, sf_dir, "documents"), folder, columns)
    return _digested(read_csv(spark, folder, columns), "doc_id", "lang")


def _digested(df: DataFrame, *keys: str) -> DataFrame:
    return df.select(
        *keys, F.length("text").cast("bigint").alias("n"), F.md5(F.col("text").cast("binary")).alias("digest")
    )


# ------------------------------------------------------------------ validation
def _checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a raw row, validated against a day that is wrong for each 17th."""
    raw = dirty_fields(table(spark, sf_dir, "events"))
    names = dict(zip([f"f{i}" for i in range(6)], schemas.VISIT_COLUMNS))
    shaped = raw.withColumn(
        "f0",
        F.when(F.col("event_id") % 19 == 0, "31/02/2024")
        .when(F.col("event_id") % 2 == 0, F.date_format("ts", "yyyy-MM-dd"))
        .otherwise(F.col("f0")),
    )
    day = F.col("ts").cast("date")
    expected = F.when(F.col("event_id") % 17 == 0, F.date_add(day, 1)).otherwise(day)
    rows = shaped.withColumn("expected", expected).select("event_id", "event_type", "expected", *names)
    return check_rows(rows.withColumnsRenamed(names), visit_rules(F.col("expected"))).drop("expected")


_CHECKED_SQL = f"""WITH {_DIRTY_SQL},
shaped AS (
  SELECT * REPLACE (CASE WHEN event_id % 19 = 0 THEN '31/02/2024'
                         WHEN event_id % 2 = 0 THEN strftime(dia, '%Y-%m-%d') ELSE f0 END AS f0) FROM dirty),
checked AS (
  SELECT *, concat_ws('; ',
    CASE WHEN event_id % 19 = 0 THEN 'fecha invalida ''31/02/2024''' END,
    CASE WHEN event_id % 19 <> 0 AND event_id % 17 = 0
         THEN 'fecha ' || CAST(dia AS VARCHAR) || ' distinta al dia procesado' END,
    CASE WHEN trim(f2) = '' THEN 'distrito vacio' END,
    CASE WHEN f3 = 'bebes' THEN 'grupo_edad invalido ''bebes''' END,
    CASE WHEN f4 = 'Z00' THEN 'diagnostico_cie10 no respiratorio o invalido ''Z00''' END,
    CASE WHEN f5 = 'N/D' THEN 'num_atenciones invalido ''N/D''' END) AS motivo
  FROM shaped)"""


@query(
    "validate_rows",
    f"""{_CHECKED_SQL}
    SELECT event_id, dia AS fecha_atencion, f1 AS codigo_clinica, f2 AS distrito, replace(f3, ' ', '') AS grupo_edad,
           upper(trim(f4)) AS diagnostico_cie10, n AS num_atenciones
    FROM checked WHERE motivo = ''""",
)
def validate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return valid_rows(_checked(spark, sf_dir)).drop("event_type")


@query(
    "quarantine_split",
    f"""{_CHECKED_SQL}
    SELECT event_id, f0 AS fecha_atencion, f1 AS codigo_clinica, f2 AS distrito, f3 AS grupo_edad,
           f4 AS diagnostico_cie10, f5 AS num_atenciones, motivo AS motivo_rechazo
    FROM checked WHERE motivo <> ''""",
)
def quarantine_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quarantined_rows(_checked(spark, sf_dir)).drop("event_type")


@query(
    "rejection_rate",
    f"""{_CHECKED_SQL}
    SELECT event_type, count(*) AS total, count(CASE WHEN motivo <> '' THEN 1 END) AS rechazadas,
           count(CASE WHEN motivo = '' THEN 1 END) AS validas,
           count(CASE WHEN motivo <> '' THEN 1 END) / count(*) AS tasa_rechazo
    FROM checked GROUP BY event_type""",
)
def rejection_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejection_summary(_checked(spark, sf_dir), "event_type")


# --------------------------------------------------------------------- air API
_SENSOR_SQL = """
    SELECT estacion_id, s_name AS estacion_nombre, latitud, longitud, estacion_id || CAST(n AS VARCHAR) AS sensor_id
    FROM (SELECT *, CAST(s_suppkey AS VARCHAR) AS estacion_id,
                 -12.0::DOUBLE + (s_suppkey % 40) / 64.0::DOUBLE AS latitud,
                 -77.0::DOUBLE + ((s_suppkey // 40) % 40) / 64.0::DOUBLE AS longitud FROM supplier)
    CROSS JOIN (VALUES (1), (3)) AS sensors(n)
    WHERE s_suppkey % 7 <> 0 AND s_suppkey % 5 <> 0"""


def _locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """API stations built from suppliers: some mobile, some off, three sensors each."""
    key = F.col("s_suppkey")

    def sensor(n: int, pollutant: str) -> Column:
        return F.struct(
            F.concat(key.cast("string"), F.lit(str(n))).cast("bigint").alias("id"),
            F.lit(pollutant).alias("name"),
            F.struct(
                F.lit(n).cast("bigint").alias("id"), F.lit(pollutant).alias("name"),
                F.lit("µg/m³").alias("units"), F.lit(pollutant).alias("displayName"),
            ).alias("parameter"),
        )

    last = F.when(key % 5 == 0, "2023-12-31T23:00:00Z").otherwise("2024-01-02T05:00:00Z")
    return table(spark, sf_dir, "supplier").select(
        key.alias("id"),
        F.col("s_name").alias("name"),
        (key % 7 == 0).alias("isMobile"),
        F.struct(station_latitude("s_suppkey").alias("latitude"), station_longitude("s_suppkey").alias("longitude"))
        .alias("coordinates"),
        F.struct(last.alias("utc"), last.alias("local")).alias("datetimeLast"),
        F.array(sensor(1, "pm25"), sensor(2, "pm10"), sensor(3, "pm25")).alias("sensors"),
    )


@query("select_sensors", f"{_SENSOR_SQL} ORDER BY estacion_id, sensor_id LIMIT 20")
def sensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.lit("2024-01-01").cast("date")
    return select_sensors(_locations(spark, sf_dir), day, DEFAULTS.max_sensors)


@query(
    "daily_value_pick",
    """SELECT CAST(l_shipdate AS DATE) AS fecha, CAST(l_orderkey AS VARCHAR) AS estacion_id,
              CAST(l_linenumber AS VARCHAR) AS sensor_id, 'pm25' AS parametro, 'µg/m³' AS unidad,
              l_quantity AS valor_promedio, l_tax AS cobertura_pct, l_suppkey AS n_observaciones, 'openaq' AS fuente
       FROM lineitem WHERE l_partkey % 9 <> 0""",
)
def daily_value_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each line is a sensor page with three items; the second and third are of its day."""
    day = F.col("l_shipdate").cast("date")

    def item(shift: int, value: Column) -> Column:
        local = F.concat(F.date_add(day, shift).cast("string"), F.lit("T00:00:00-05:00"))
        return F.struct(
            value.alias("value"),
            F.struct(F.lit("pm25").alias("name"), F.lit("µg/m³").alias("units")).alias("parameter"),
            F.struct(F.struct(local.alias("local")).alias("datetimeFrom")).alias("period"),
            F.struct(F.col("l_tax").alias("percentComplete"), F.col("l_suppkey").alias("observedCount")).alias("coverage"),
        )

    first = F.when(F.col("l_partkey") % 9 != 0, F.col("l_quantity"))
    pages = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("estacion_id"),
        F.lit(None).cast("string").alias("estacion_nombre"),
        F.lit(None).cast("double").alias("latitud"),
        F.lit(None).cast("double").alias("longitud"),
        F.col("l_linenumber").cast("string").alias("sensor_id"),
        day.alias("dia"),
        F.array(item(-1, F.lit(1.0)), item(0, first), item(0, F.lit(2.0))).alias("results"),
    )
    return daily_readings(pages, F.col("dia")).drop("estacion_nombre", "latitud", "longitud")


_DAYS_SQL = """
    pages AS (
      SELECT CAST(l_suppkey AS VARCHAR) || CAST(l_linenumber AS VARCHAR) AS sensor_id, CAST(l_shipdate AS DATE) AS fecha,
             l_partkey % 9 <> 0 AS measured, l_quantity,
             row_number() OVER (PARTITION BY l_suppkey, l_linenumber, l_shipdate ORDER BY l_orderkey, l_partkey) AS place
      FROM lineitem WHERE l_linenumber IN (1, 3))"""


@query(
    "readings_of_days",
    f"""WITH {_DAYS_SQL},
    sensors AS (
      SELECT CAST(s_suppkey AS VARCHAR) AS estacion_id, CAST(s_suppkey AS VARCHAR) || CAST(n AS VARCHAR) AS sensor_id,
             CASE WHEN s_suppkey % 5 = 0 THEN '2023-12-31' ELSE '1996-06-30' END AS visto
      FROM supplier CROSS JOIN (VALUES (1), (3)) AS numbers(n) WHERE s_suppkey % 7 <> 0)
    SELECT fecha, estacion_id, sensors.sensor_id, l_quantity AS valor_promedio
    FROM pages JOIN sensors USING (sensor_id)
    WHERE place = 1 AND measured AND fecha BETWEEN DATE '1996-01-01' AND DATE '1997-12-30'
      AND visto >= CAST(fecha AS VARCHAR)""",
)
def readings_of_two_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """730 requested days in one pass over one page of items per sensor; sensors count up to the day they were last seen."""
    item = F.struct(
        F.when(F.col("l_partkey") % 9 != 0, F.col("l_quantity")).alias("value"),
        F.struct(F.lit(None).cast("string").alias("name"), F.lit("µg/m³").alias("units")).alias("parameter"),
        F.struct(F.struct(F.concat(F.col("l_shipdate").cast("date").cast("string"), F.lit("T00:00:00-05:00")).alias("local"))
                 .alias("datetimeFrom")).alias("period"),
        F.struct(F.lit(100.0).alias("percentComplete"), F.lit(24).cast("bigint").alias("observedCount")).alias("coverage"),
    )
    lines = table(spark, sf_dir, "lineitem").where("l_linenumber in (1, 3)")
    # a sensor's page; its items in the order of orders
    pages = lines.groupBy(F.concat(F.col("l_suppkey").cast("string"), F.col("l_linenumber").cast("string")).alias("sensor_id")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("l_orderkey", "l_partkey", item.alias("item")))), lambda x: x["item"]).alias("results")
    )
    locations = _locations(spark, sf_dir).withColumn(
        "datetimeLast", F.struct(F.when(F.col("id") % 5 == 0, "2023-12-31T23:00:00Z").otherwise("1996-06-30T05:00:00Z").alias("utc"))
    )
    days = spark.sql("select explode(sequence(date'1996-01-01', date'1997-12-30')) as fecha")
    found = readings_of_days(pages, known_sensors(locations), days)
    return found.select("fecha", "estacion_id", "sensor_id", "valor_promedio")


# ---------------------------------------------------------------- lake and sinks
@query(
    "partition_replace",
    """SELECT CAST(ts AS DATE) AS dia, event_id,
              CASE WHEN CAST(ts AS DATE) = DATE '2024-01-05' THEN -1 ELSE user_id END AS user_id
       FROM events
       WHERE CAST(ts AS DATE) NOT IN (DATE '2024-01-06', DATE '2024-01-07')
         AND NOT (CAST(ts AS DATE) = DATE '2024-01-08' AND event_type <> 'view')""",
)
def partition_replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days loaded, then one corrected, two emptied and one reduced."""
    folder = new_folder(spark, "replaced")
    day = F.col("ts").cast("date")
    rows = table(spark, sf_dir, "events").select(day.alias("dia"), "event_id", "user_id", "event_type")
    everything = rows.drop("event_type")
    replace_days(everything, folder, "dia", everything.select("dia").distinct())
    corrected = everything.where("dia = date'2024-01-05'").withColumn("user_id", F.lit(-1).cast("bigint"))
    replace_partition(corrected, folder, "dia", "2024-01-05")
    replace_partition(everything.where("false"), folder, "dia", "2024-01-06")
    reduced = rows.where("dia = date'2024-01-08' and event_type = 'view'").drop("event_type")
    days = spark.sql("select explode(array(date'2024-01-07', date'2024-01-08')) as dia")
    replace_days(reduced, folder, "dia", days)
    schema = T.StructType(everything.schema.fields)
    return spark.read.schema(schema).parquet(folder).select("dia", "event_id", "user_id")


@query(
    "day_table_replace",
    """SELECT 'before' AS lectura, CAST(ts AS DATE) AS dia, event_id, user_id FROM events
       UNION ALL
       SELECT 'after', CAST(ts AS DATE), event_id,
              CASE WHEN CAST(ts AS DATE) = DATE '2024-01-05' THEN -1 ELSE user_id END
       FROM events
       WHERE CAST(ts AS DATE) NOT IN (DATE '2024-01-06', DATE '2024-01-07')
         AND NOT (CAST(ts AS DATE) = DATE '2024-01-08' AND event_type <> 'view')""",
)
def day_table_replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One day corrected, two emptied and one reduced at once; a reader from before still sees all days as they were."""
    folder = new_folder(spark, "day-table")
    rows = table(spark, sf_dir, "events").select(F.col("ts").cast("date").alias("dia"), "event_id", "user_id", "event_type")
    everything = rows.drop("event_type")
    daytable.replace_days(everything, folder, "dia", everything.select("dia").distinct())
    before = daytable.read(spark, folder, "dia", everything.schema)
    changed = rows.where("dia = date'2024-01-05' or dia = date'2024-01-08' and event_type = 'view'").drop("event_type")
    changed = changed.withColumn("user_id", F.when(F.col("dia") == "2024-01-05", F.lit(-1).cast("bigint")).otherwise(F.col("user_id")))
    days = spark.sql("select explode(sequence(date'2024-01-05', date'2024-01-08')) as dia")
    daytable.replace_days(changed, folder, "dia", days)
    after = daytable.read(spark, folder, "dia", everything.schema)
    marked = lambda df, name: df.select(F.lit(name).alias("lectura"), "dia", "event_id", "user_id")
    return marked(before, "before").unionByName(marked(after, "after"))


@query(
    "row_positions",
    """SELECT o_orderkey, CAST(row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS BIGINT) AS posicion FROM orders""",
)
def row_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return with_position(orders, [F.desc("o_totalprice"), F.asc("o_orderkey")], "posicion").select("o_orderkey", "posicion")


@query("lineage_columns", "SELECT o_orderkey, o_custkey, 'orders' AS _archivo_origen FROM orders")
def lineage_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    file = F.regexp_extract("_metadata.file_path", r"([a-z]+)\.parquet", 1)
    return with_lineage(orders, ("o_orderkey", "o_custkey", "_archivo_origen"), file)


@query("lake_layout", "SELECT DISTINCT 'staged' AS capa, 'eventos' AS dominio, CAST(ts AS DATE) AS fecha FROM events")
def lake_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_folder(spark, "lake")
    rows = table(spark, sf_dir, "events").withColumn("fecha", F.col("ts").cast("date"))
    replace_days(rows, layer_folder(root, "staged", "eventos"), "fecha", rows.select("fecha").distinct())
    return list_objects(spark, root).select("capa", "dominio", "fecha").distinct()


@query(
    "retention_expired",
    """SELECT * FROM (
         SELECT o_orderkey, capa, CAST(o_orderdate AS DATE) AS escrito_en,
                CAST(CAST(o_orderdate AS DATE) + CASE capa WHEN 'raw' THEN 730 WHEN 'staged' THEN 180
                     WHEN 'cuarentena' THEN 90 END AS DATE) AS expira_el
         FROM (SELECT *, CASE o_orderpriority WHEN '1-URGENT' THEN 'raw' WHEN '2-HIGH' THEN 'staged'
                      WHEN '3-MEDIUM' THEN 'cuarentena' ELSE 'reportes' END AS capa FROM orders))
       WHERE expira_el <= DATE '1998-01-01'""",
)
def expired(spark: SparkSession, sf_dir: str) -> DataFrame:
    layer = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "raw")
        .when(F.col("o_orderpriority") == "2-HIGH", "staged")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "cuarentena")
        .otherwise("reportes")
    )
    objects = table(spark, sf_dir, "orders").select(
        "o_orderkey", layer.alias("capa"), F.col("o_orderdate").cast("date").alias("escrito_en")
    )
    return retention_expired(objects, F.lit("1998-01-01").cast("date"))


@query(
    "stream_ingest",
    f"""WITH {_DIRTY_SQL}
    SELECT dia AS fecha_atencion, f1 AS codigo_clinica, f2 AS distrito,
           CASE event_id % 4 WHEN 0 THEN '0-4' WHEN 1 THEN '5-17' WHEN 2 THEN '18-59' ELSE '60+' END AS grupo_edad,
           CASE event_id % 3 WHEN 0 THEN 'J45' WHEN 1 THEN 'J18.9' ELSE 'J06' END AS diagnostico_cie10,
           n AS num_atenciones
    FROM dirty WHERE f5 <> 'N/D' AND trim(f2) <> '' """,
)
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land one file per day and chunk, ingest them as a stream, return the raw table."""
    landing, lake, loaded, state = (new_folder(spark, n) for n in ("landed", "lake", "loaded", "state"))
    events = dirty_fields(table(spark, sf_dir, "events")).withColumns(
        {
            "f3": _get(_GROUPS, F.col("event_id") % 4),
            "f4": _get(_CODES, F.col("event_id") % 3),
            "fecha": F.col("ts").cast("date"),
            "chunk": F.floor(F.col("event_id") / CHUNK),
        }
    )
    quoted = F.when(
        F.col("f2").contains('"'), F.concat(F.lit('"'), F.replace("f2", F.lit('"'), F.lit('""')), F.lit('"'))
    ).otherwise(F.col("f2"))
    body = events.select("fecha", "chunk", "event_id", F.concat_ws(";", "f0", "f1", quoted, "f3", "f4", "f5").alias("value"))
    header = body.select("fecha", "chunk").distinct().select(
        "fecha", "chunk", F.lit(-1).cast("bigint").alias("event_id"), F.lit(";".join(_HEADER)).alias("value")
    )
    (
        body.unionByName(header)
        .repartition("fecha", "chunk")
        .sortWithinPartitions("fecha", "chunk", "event_id")
        .select("fecha", "chunk", "value")
        .write.partitionBy("fecha", "chunk")
        .text(landing)
    )
    ingest_landed(spark, f"{landing}/*/*", lake, loaded, state).awaitTermination()
    return raw_visits(spark, loaded).select(*schemas.VISIT_COLUMNS)

