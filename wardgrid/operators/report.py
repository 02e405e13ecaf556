"""Daily report lines for all days of the finished table at once.

Each line is a row with its place in the day's text, so a day is never gathered
into one value; only the list of places in alert, one line of the format, is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..errors import QualityGateError
from ..fixed_values import (
    CATEGORY_LABELS,
    MISSING_VALUE,
    REPORT_ALERT_LIST,
    REPORT_ALERTS,
    REPORT_COLUMNS,
    REPORT_CRITERIA,
    REPORT_MEASURED,
    REPORT_NO,
    REPORT_NONE,
    REPORT_PLACES,
    REPORT_TABLE_HEAD,
    REPORT_TABLE_RULE,
    REPORT_TITLE,
    REPORT_VISITS,
    REPORT_WORST,
    REPORT_YES,
)
from ..functions.rounding import round_binary
from ..functions.text import filled_text, text_map


def severity() -> Column:
    """Air value used for ordering: missing and zero both sort as -1."""
    reading = F.col("pm25_promedio_24h")
    return F.when(reading.isNull() | (reading == 0), F.lit(-1.0)).otherwise(reading)


def report_order() -> list[Column]:
    """Alerts first, then worst air, then most visits; the place name settles ties."""
    alert = F.coalesce("alerta_salud_publica", F.lit(False))
    return [F.desc(alert), F.desc(severity()), F.desc(F.coalesce("total_atenciones", F.lit(0))), F.asc("distrito")]


def report_rows(mart: DataFrame) -> DataFrame:
    """Report columns of every day; ``posicion`` is the row's place in its day's report, from 1.

    The order is data, so it outlives every later shuffle; a day has one row per place.
    """
    position = F.row_number().over(Window.partitionBy("fecha").orderBy(*report_order()))
    return mart.select("fecha", *REPORT_COLUMNS, position.alias("posicion"))


def report_header(mart: DataFrame) -> DataFrame:
    """Per day: places, visits, places with a reading, the worst one, places in alert."""
    alert = F.coalesce("alerta_salud_publica", F.lit(False))
    measured = F.col("pm25_promedio_24h").isNotNull()
    worst = F.min(
        F.when(measured, F.struct((-F.col("pm25_promedio_24h")).alias("neg"), F.col("distrito").alias("place")))
    )
    return mart.groupBy("fecha").agg(
        F.count(F.lit(1)).alias("distritos"),
        F.coalesce(F.sum("total_atenciones"), F.lit(0)).alias("atenciones"),
        F.count("pm25_promedio_24h").alias("con_pm25"),
        worst.alias("_worst"),
        F.count_if(alert).alias("alertas"),
        F.array_join(F.array_sort(F.collect_list(F.when(alert, F.col("distrito")))), ", ").alias("en_alerta"),
    ).select(
        "fecha",
        "distritos",
        "atenciones",
        "con_pm25",
        (-F.col("_worst.neg")).alias("peor_pm25"),
        F.col("_worst.place").alias("peor_distrito"),
        "alertas",
        "en_alerta",
    )


def _one_decimal(value: str, form: str = "%.1f") -> Column:
    return F.format_string(form, round_binary(value, 1))


def _or_dash(value: Column, text: Column) -> Column:
    return F.when(value.isNull(), REPORT_NONE).otherwise(text)


def _table_row() -> Column:
    label = F.coalesce(
        F.try_element_at(text_map(CATEGORY_LABELS), F.col("categoria_aire")),
        F.col("categoria_aire"),
        F.lit(MISSING_VALUE),
    )
    cells = [
        F.coalesce("distrito", F.lit(MISSING_VALUE)),
        F.coalesce(F.when(F.col("zona") != "", F.col("zona")), F.lit(REPORT_NONE)),
        *(
            _or_dash(F.col(c), F.col(c).cast("string"))
            for c in ("total_atenciones", "atenciones_menores_5", "atenciones_adultos_mayores")
        ),
        _or_dash(F.col("pm25_promedio_24h"), _one_decimal("pm25_promedio_24h")),
        label,
        _or_dash(
            F.col("variacion_vs_7d_pct"), F.concat(_one_decimal("variacion_vs_7d_pct", "%+.1f"), F.lit("%"))
        ),
        F.when(F.coalesce("alerta_salud_publica", F.lit(False)), REPORT_YES).otherwise(REPORT_NO),
    ]
    return F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |"))


def report_lines(mart: DataFrame, title: str = REPORT_TITLE) -> DataFrame:
    """The report of every day as rows (fecha, seccion, orden columns, linea).

    Sorting a day by ``seccion`` and the order columns gives its text. Heading
    and closing lines have their own section numbers; table rows share one.
    """
    head = report_header(mart)

    def count(name: str) -> Column:
        return F.col(name).cast("string")

    fixed = [
        F.concat(F.lit(f"# {title} — "), F.col("fecha").cast("string")),
        F.lit(""),
        filled_text(REPORT_PLACES, count("distritos")),
        filled_text(REPORT_VISITS, count("atenciones")),
        filled_text(REPORT_MEASURED, count("con_pm25")),
        F.when(F.col("con_pm25") > 0, filled_text(REPORT_WORST, _one_decimal("peor_pm25"), F.col("peor_distrito"))),
        filled_text(REPORT_ALERTS, count("alertas")),
        F.when(F.col("alertas") > 0, filled_text(REPORT_ALERT_LIST, F.col("en_alerta"))),
        F.lit(""),
        F.lit(REPORT_TABLE_HEAD),
        F.lit(REPORT_TABLE_RULE),
    ]
    table_section = len(fixed) + 1
    closing = {table_section + 1: "", table_section + 2: REPORT_CRITERIA}
    numbered = [F.struct(F.lit(i).alias("seccion"), line.alias("linea")) for i, line in enumerate(fixed, 1)]
    numbered += [F.struct(F.lit(i).alias("seccion"), F.lit(line).alias("linea")) for i, line in closing.items()]
    headings = (
        head.select("fecha", F.inline(F.array(*numbered)))
        .where(F.col("linea").isNotNull())
        .select(
            "fecha",
            "seccion",
            F.lit(False).alias("alerta"),
            F.lit(0.0).alias("gravedad"),
            F.lit(0).cast("long").alias("atenciones"),
            F.lit("").alias("distrito"),
            "linea",
        )
    )
    table = mart.select(
        "fecha",
        F.lit(table_section).alias("seccion"),
        F.coalesce("alerta_salud_publica", F.lit(False)).alias("alerta"),
        severity().alias("gravedad"),
        F.coalesce("total_atenciones", F.lit(0)).cast("long").alias("atenciones"),
        "distrito",
        _table_row().alias("linea"),
    )
    return headings.unionByName(table)


def ordered_lines(lines: DataFrame) -> DataFrame:
    return lines.orderBy(
        "fecha", "seccion", F.desc("alerta"), F.desc("gravedad"), F.desc("atenciones"), "distrito"
    )


def days_without_rows(mart: DataFrame, requested: DataFrame, day: str = "fecha") -> DataFrame:
    """Requested days the finished table has no row for."""
    return requested.join(mart.select("fecha").distinct(), requested[day] == mart["fecha"], "left_anti")


def require_days(mart: DataFrame, requested: DataFrame, day: str = "fecha", shown: int = 20) -> None:
    absent = days_without_rows(mart, requested, day).select(day).distinct()
    missing = [str(r[0]) for r in absent.orderBy(day).take(shown)]
    if missing:
        more = absent.count() - shown if len(missing) == shown else 0
        raise QualityGateError(f"the table has no rows for {', '.join(missing)}" + (f" and {more} more days" if more else ""))
