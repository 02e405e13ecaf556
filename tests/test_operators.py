"""Validation, deduplication, aggregation, grid, trend, report and checks on small frames."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from wardgrid import DEFAULTS, schemas
from wardgrid.errors import PartitionError, QualityGateError
from wardgrid.fixed_values import VISIT_COLUMNS
from wardgrid.operators import air_api, quality, report, validation
from wardgrid.operators.grid import calendar_of, dense_grid
from wardgrid.operators.reconcile import reconcile_totals
from wardgrid.operators.trends import air_category, alert_flag, percent_change, trailing_average, with_trailing
from wardgrid.plans.models import build_models, staged_air, staged_visits
from wardgrid.sources import lake
from wardgrid.sources.catalogue import district_aliases, districts

DAY = dt.date(2026, 10, 7)
GOOD = ("07/10/2026", "CLI-001", "Ate", "0-4", "J45", "5")


def checked(spark, *rows):
    schema = "n int, " + ", ".join(f"{c} string" for c in VISIT_COLUMNS)
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], schema)
    return validation.check_rows(df, validation.visit_rules(F.lit(DAY)))


def with_value(column, value):
    row = list(GOOD)
    row[VISIT_COLUMNS.index(column)] = value
    return tuple(row)


@pytest.mark.parametrize(
    ("row", "reason"),
    [
        (with_value("num_atenciones", "N/D"), "num_atenciones invalido 'N/D'"),
        (with_value("num_atenciones", "-3"), "num_atenciones invalido '-3'"),
        (with_value("num_atenciones", "3.5"), "num_atenciones invalido '3.5'"),
        (with_value("diagnostico_cie10", "z00"), "diagnostico_cie10 no respiratorio o invalido 'Z00'"),
        (with_value("grupo_edad", "bebes"), "grupo_edad invalido 'bebes'"),
        (with_value("grupo_edad", None), "grupo_edad invalido 'None'"),
        (with_value("fecha_atencion", "06/10/2026"), "fecha 2026-10-06 distinta al dia procesado"),
        (with_value("fecha_atencion", "31/02/2026"), "fecha invalida '31/02/2026'"),
        (with_value("distrito", "  "), "distrito vacio"),
        (("x", "", "", "", "", ""),
         "fecha invalida 'x'; codigo_clinica vacio; distrito vacio; grupo_edad invalido ''; "
         "diagnostico_cie10 no respiratorio o invalido ''; num_atenciones invalido ''"),
    ],
)
def test_rejected_rows_keep_raw_values_and_reasons(spark, row, reason):
    result = checked(spark, row)
    assert validation.valid_rows(result).count() == 0
    rejected = validation.quarantined_rows(result).first()
    assert rejected.motivo_rechazo == reason
    assert tuple(rejected[c] for c in VISIT_COLUMNS) == tuple(v or "" for v in row)


def test_valid_rows_are_cleaned(spark):
    row = validation.valid_rows(checked(spark, ("2026-10-07", " C ", "Ate", "60 +", " j18.10 ", "12.00"))).first()
    assert tuple(row[c] for c in VISIT_COLUMNS) == (DAY, "C", "Ate", "60+", "J18.10", 12)


def test_rejection_rate_gate(spark):
    bad = with_value("num_atenciones", "N/D")
    summary = validation.rejection_summary(checked(spark, GOOD, bad, bad))
    assert summary.first().asDict()["rechazadas"] == 2
    validation.enforce_rejection_rate(summary, 0.70)
    with pytest.raises(QualityGateError, match="cuarentena"):
        validation.enforce_rejection_rate(summary, 0.20)
    exact = validation.rejection_summary(checked(spark, GOOD, GOOD, GOOD, GOOD, bad))
    validation.enforce_rejection_rate(exact, 0.20)  # only a rate above the limit stops
    with pytest.raises(QualityGateError, match="no data rows"):
        validation.enforce_rejection_rate(validation.rejection_summary(checked(spark, GOOD).where("false")), 0.2)


def visit(day, clinic, place, group, code, n, row, loaded=dt.datetime(2026, 10, 8)):
    return (day, clinic, place, group, code, n, row, "f", loaded)


def test_latest_row_of_a_key_wins_and_spellings_stay_apart(spark):
    later = dt.datetime(2026, 10, 9)
    raw = spark.createDataFrame(
        [
            visit(DAY, "c1", "Ate", "0-4", "J45", 5, 2),
            visit(DAY, "C1 ", " ate", "0-4", "j45", 7, 3),
            visit(DAY, "C1", "ATE", "0-4", "J45", 9, 1, later),
            visit(DAY, "C1", "SJL", "60+", "J18", 1, 4),
            visit(DAY, "C1", "S.J.L.", "60 +", "J18", 2, 5),
        ],
        schemas.RAW_VISITS,
    )
    staged = staged_visits(raw)
    assert sorted((r.distrito_reportado, r.num_atenciones) for r in staged.collect()) == [
        ("ATE", 9), ("S.J.L.", 2), ("SJL", 1),
    ]
    plan = staged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2  # rows are reduced before the shuffle


def test_hot_key_is_reduced_in_every_task(spark):
    hot = spark.range(0, 200_000, 1, 16).select(
        F.lit(DAY).alias("fecha_atencion"),
        F.lit("C").alias("codigo_clinica"),
        F.when(F.col("id") % 3 == 0, F.lit("Ate")).otherwise(F.concat(F.lit("X"), F.col("id") % 1000)).alias("distrito"),
        F.lit("0-4").alias("grupo_edad"),
        F.lit("J45").alias("diagnostico_cie10"),
        F.col("id").alias("num_atenciones"),
        F.col("id").alias("_numero_fila"),
        F.lit("f").alias("_archivo_origen"),
        F.lit(dt.datetime(2026, 10, 8)).cast("timestamp_ntz").alias("_cargado_en"),
    )
    staged = staged_visits(hot)
    assert staged.where("distrito_reportado = 'ATE'").first().num_atenciones == 199_998
    assert staged.count() == 1001 - sum(all((i * 1000 + k) % 3 == 0 for i in range(200)) for k in range(1000))


def test_station_day(spark):
    t = dt.datetime(2026, 10, 8)
    def row(sensor, value, coverage, pollutant="PM25", name="N"):
        return (DAY, "s1", name, -12.0, -77.0, sensor, pollutant, "u", value, coverage, 1, "openaq", "f", t)
    raw = spark.createDataFrame(
        [row("a", 10.0, 90.0), row("a", 11.0, 80.0, name="M"), row("b", 12.5, None), row("c", None, 0.0), row("d", 99.0, 1.0, "pm10")],
        schemas.RAW_AIR,
    )
    r = staged_air(raw).first()
    assert (r.pm25_promedio_24h, r.cobertura_pct, r.sensores, r.estacion_nombre) == (11.17, 85.0, 2, "N")


def test_grid_has_every_pair_without_a_cartesian_product(spark):
    days = spark.createDataFrame([(DAY + dt.timedelta(i),) for i in range(40)], "fecha date")
    places = spark.range(200).select(F.col("id").cast("string").alias("ubigeo"))
    grid = dense_grid(days, places, "ubigeo")
    assert grid.count() == grid.distinct().count() == 8000
    plan = grid._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert calendar_of((days, "fecha"), (days, "fecha")).count() == 40


def trend(spark, counts, reading=20.0):
    df = spark.createDataFrame(
        [("p", DAY + dt.timedelta(i), n, reading) for i, n in enumerate(counts)],
        "ubigeo string, fecha date, total_atenciones bigint, pm double",
    )
    out = with_trailing(df, "ubigeo", "fecha", "total_atenciones", 7)
    return out.select(
        "fecha", trailing_average().alias("mean"), percent_change("total_atenciones").alias("change"),
        alert_flag("total_atenciones", air_category("pm", DEFAULTS), DEFAULTS).alias("alert"),
    ).orderBy("fecha").collect()


def test_rise_of_exactly_the_limit_is_an_alert(spark):
    rows = trend(spark, [5, 5, 5, 6])
    assert (rows[0].mean, rows[0].change, rows[0].alert) == (None, None, False)
    assert (rows[3].mean, rows[3].change, rows[3].alert) == (5.0, 20.0, True)
    for base in range(1, 60):  # every exact 20 % rise over 1 to 7 rows
        for n in (1, 3, 7):
            if (base * 6) % 5 == 0:
                assert trend_alert(base, n)


def trend_alert(base, n):
    return (base * 6 // 5) * n * 100 >= base * n * 120


def test_no_alert_within_guide_or_after_zeros(spark):
    assert not any(r.alert for r in trend(spark, [5, 9], reading=15.0))
    assert not any(r.alert for r in trend(spark, [0, 0, 9]))
    assert not any(r.alert for r in trend(spark, [5, 9], reading=None))
    assert [r.mean for r in trend(spark, range(9))][-1] == 4.0  # rows 1..7 before the last


def test_categories(spark):
    df = spark.createDataFrame([(None,), (15.0,), (15.01,), (50.0,), (50.01,)], "v double")
    assert [r[0] for r in df.select(air_category("v", DEFAULTS)).collect()] == [
        "SIN_COBERTURA", "DENTRO_GUIA_OMS", "SOBRE_GUIA_OMS", "SOBRE_GUIA_OMS", "SOBRE_ECA_PERU",
    ]


def test_models_end_to_end(spark):
    t = dt.datetime(2026, 10, 8)
    raw = spark.createDataFrame(
        [visit(DAY + dt.timedelta(d), f"C{c}", p, g, code, 5 + 20 * (d == 2), i)
         for d in (0, 1, 2) for i, (c, p, g, code) in enumerate(
             [(1, "Ate", "0-4", "J45"), (2, "Ate Vitarte", "60 +", "J18.1"), (1, "Callao", "0-4", "J45")])],
        schemas.RAW_VISITS,
    )
    air = spark.createDataFrame(
        [(DAY + dt.timedelta(2), s, s, lat, -76.92, s, "pm25", "u", v, c, 20, "openaq", "f", t)
         for s, lat, v, c in [("far", -12.09, 60.0, 90.0), ("near", -12.03, 30.0, 90.0), ("bad", -12.0262, 99.0, 40.0)]],
        schemas.RAW_AIR,
    )
    m = build_models(raw, air, districts(spark), district_aliases(spark))
    assert m.fact.count() == 36
    row = m.fact.where("ubigeo = '150103' and fecha = date'2026-10-09'").first()
    assert (row.total_atenciones, row.atenciones_menores_5, row.atenciones_adultos_mayores) == (50, 25, 25)
    assert (row.atenciones_asma, row.atenciones_neumonia, row.clinicas_reportantes) == (25, 25, 2)
    assert (row.pm25_promedio_24h, row.estacion_referencia) == (30.0, "near")
    assert (row.promedio_atenciones_7d_previos, row.variacion_vs_7d_pct, row.alerta_salud_publica) == (10.0, 400.0, True)
    mapped = m.visits.join(m.aliases, m.visits.distrito_reportado == m.aliases.alias_normalizado)
    assert reconcile_totals(mapped, "fecha_atencion", "num_atenciones", m.fact, "fecha", "total_atenciones").count() == 0
    lost = m.fact.where("fecha <> date'2026-10-08'")
    bad = reconcile_totals(mapped, "fecha_atencion", "num_atenciones", lost, "fecha", "total_atenciones").collect()
    assert [tuple(r) for r in bad] == [(dt.date(2026, 10, 8), 10, 0)]


# ------------------------------------------------------------------ air API
def location(key, mobile=False, last="2026-10-08T05:00:00Z", sensors=((1, "pm25"),)):
    return (key, f"S{key}", mobile, (-12.0, -77.0), (last, last) if last else None,
            [(i, n, (2, n, "u", n)) for i, n in sensors])


def test_sensor_selection(spark):
    rows = [
        location(101, sensors=((5001, "pm25"), (5002, "pm10"))),
        location(102, last="2025-03-01T05:00:00Z"),
        location(103, mobile=True),
        location(9, sensors=((2, "pm25"), (10, "pm25"))),
        location(104, last=None),
    ]
    df = spark.createDataFrame(rows, schemas.API_LOCATION)
    chosen = air_api.select_sensors(df, F.lit(DAY), 20).collect()
    assert [(r.estacion_id, r.sensor_id) for r in chosen] == [("101", "5001"), ("9", "10"), ("9", "2")]
    assert len(air_api.select_sensors(df, F.lit(DAY), 2).collect()) == 2


def day_item(local, value):
    return (value, None, (2, "pm25", "u", "x"), (None, None, (None, local), None), (24, None, 18, None, 75.0, 75.0))


def test_first_item_of_the_day_decides(spark):
    schema = schemas.T.StructType(
        [schemas.T.StructField(c, schemas.T.StringType()) for c in ("estacion_id", "estacion_nombre", "sensor_id")]
        + [schemas.T.StructField(c, schemas.T.DoubleType()) for c in ("latitud", "longitud")]
        + schemas.API_DAYS_PAGE.fields
    )
    pages = spark.createDataFrame(
        [
            ("1", "X", "a", -12.0, -77.0, [day_item("2026-10-06T00:00:00-05:00", 1.0), day_item("2026-10-07T00:00:00-05:00", 28.7465)]),
            ("2", "X", "b", -12.0, -77.0, [day_item("2026-10-07T00:00:00-05:00", None), day_item("2026-10-07T00:00:00-05:00", 3.0)]),
            ("3", "X", "c", -12.0, -77.0, []),
        ],
        schema,
    )
    rows = air_api.daily_readings(pages, F.lit(DAY)).collect()
    assert [(r.estacion_id, r.valor_promedio, r.cobertura_pct, r.n_observaciones) for r in rows] == [
        ("1", round(28.7465, 3), 75.0, 18)
    ]
    with pytest.raises(QualityGateError, match="no station"):
        air_api.require_readings(pages.where("false"), str(DAY))


# ------------------------------------------------------------------- report
REPORT = (
    "fecha date, distrito string, zona string, total_atenciones bigint, atenciones_menores_5 bigint, "
    "atenciones_adultos_mayores bigint, pm25_promedio_24h double, categoria_aire string, variacion_vs_7d_pct double, "
    "alerta_salud_publica boolean"
)


def test_report_text(spark):
    mart = spark.createDataFrame(
        [
            (DAY, "San Borja", "Lima Este", 10, 2, 1, 12.25, "DENTRO_GUIA_OMS", None, False),
            (DAY, "Ate", "Lima Este", 40, 2, 1, 38.5, "SOBRE_GUIA_OMS", 25.0, True),
            (DAY, "Comas", None, 10, 2, 1, None, "SIN_COBERTURA", -0.04, False),
            (DAY, "Zero", "Z", 11, 2, 1, 0.0, "DENTRO_GUIA_OMS", None, False),
        ],
        REPORT,
    )
    lines = [r.linea for r in report.ordered_lines(report.report_lines(mart)).collect()]
    assert lines[2:9] == [
        "- Distritos analizados: **4**",
        "- Atenciones respiratorias reportadas: **71**",
        "- Distritos con medicion de PM2.5: **3**",
        "- Mayor PM2.5 del dia: **38.5 µg/m³** en Ate",
        "- Distritos en ALERTA de salud publica: **1**",
        "  - Ate",
        "",
    ]
    assert lines[11:15] == [
        "| Ate | Lima Este | 40 | 2 | 1 | 38.5 | Sobre la guia OMS | +25.0% | SI |",
        "| San Borja | Lima Este | 10 | 2 | 1 | 12.2 | Dentro de la guia OMS | - | no |",
        "| Zero | Z | 11 | 2 | 1 | 0.0 | Dentro de la guia OMS | - | no |",
        "| Comas | - | 10 | 2 | 1 | - | Sin estacion cercana | -0.0% | no |",
    ]
    requested = spark.createDataFrame([(DAY,), (dt.date(2026, 1, 1),)], "fecha date")
    with pytest.raises(QualityGateError, match="2026-01-01"):
        report.require_days(mart, requested)


# ------------------------------------------------------------------- checks
def test_checks_store_violations_and_raise_only_on_errors(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("a", -2), (None, 3), ("z", 2000)], "k string, v int")
    parent = spark.createDataFrame([("a",)], "k string")
    rows = (quality.RowRule("no_negativo_v", quality.negative("v"), ("v",), quality.WARN),
            quality.RowRule("rango_v", quality.out_of_range("v", -5, 1000), ("v",), quality.WARN),
            quality.RowRule("no_nulo_k", quality.is_null("k"), (), quality.WARN))
    sets = (quality.SetRule("relacion", quality.orphans(df, "k", parent, "k"), quality.WARN),
            quality.SetRule("unico", quality.repeated_values(df, "k"), quality.WARN),
            quality.SetRule("dominio", quality.not_accepted(df, "k", ("a", "z")), quality.ERROR))
    checks = quality.TableChecks("t", df, rows, sets)
    got = {r.prueba: (r.fallas, r.estado) for r in quality.store_and_enforce(spark, [checks], str(tmp_path / "a")).collect()}
    assert got == {"no_negativo_v": (1, "warn"), "rango_v": (1, "warn"), "no_nulo_k": (1, "warn"),
                   "relacion": (1, "warn"), "unico": (1, "warn"), "dominio": (0, "pass")}
    assert spark.read.parquet(str(tmp_path / "a" / "t" / "relacion")).first().k == "z"
    failing = quality.TableChecks("t", df, (quality.RowRule("no_nulo_k", quality.is_null("k")),))
    with pytest.raises(QualityGateError, match="t.no_nulo_k: 1"):
        quality.store_and_enforce(spark, [failing], str(tmp_path / "b"))
    assert spark.read.parquet(str(tmp_path / "b" / "t" / "no_nulo_k")).count() == 1


def test_freshness(spark):
    df = spark.createDataFrame([(dt.datetime(2026, 10, 1),)], "t timestamp")
    for hours, status in ((36, "pass"), (37, "warn"), (73, "error")):
        as_of = F.lit(dt.datetime(2026, 10, 1) + dt.timedelta(hours=hours))
        assert quality.freshness(df, "t", as_of).first().estado == status
    assert quality.freshness(df.where("false"), "t", F.lit(dt.datetime(2026, 10, 1))).first().estado == "error"


# --------------------------------------------------------------------- lake
def test_partition_replace(spark, tmp_path):
    table = str(tmp_path / "t")
    def rows(day, *values):
        return spark.createDataFrame([(day, v) for v in values], "fecha date, v int")
    other = DAY + dt.timedelta(1)
    assert lake.replace_partition(rows(DAY, 1, 2), table, "fecha", DAY) == 2
    assert lake.replace_partition(rows(other, 9), table, "fecha", other) == 1
    assert lake.replace_partition(rows(DAY, 5), table, "fecha", DAY) == 1
    content = lambda: sorted((r.fecha, r.v) for r in spark.read.parquet(table).collect())
    assert content() == [(DAY, 5), (other, 9)]
    with pytest.raises(PartitionError, match="1 rows do not belong"):
        lake.replace_partition(rows(DAY, 7).union(rows(other, 8)), table, "fecha", DAY)
    failing = rows(DAY, 1).withColumn("v", F.raise_error(F.lit("broken source")).cast("int"))
    with pytest.raises(Exception, match="broken source"):
        lake.replace_partition(failing, table, "fecha", DAY)
    assert content() == [(DAY, 5), (other, 9)]  # an aborted replacement changes nothing
    assert lake.replace_partition(rows(DAY, 3).drop("fecha"), table, "fecha", DAY) == 1
    assert lake.replace_partition(rows(DAY).where("false"), table, "fecha", DAY) == 0
    assert content() == [(other, 9)]
    days = spark.createDataFrame([(DAY,), (other,)], "fecha date")
    lake.replace_days(rows(DAY, 4), table, "fecha", days)
    assert content() == [(DAY, 4)]
    with pytest.raises(PartitionError):
        lake.replace_days(rows(DAY, 4), table, "fecha", days.where(F.col("fecha") == other))


@pytest.mark.parametrize("name", ["RAW.T; DROP TABLE X", "RAW.T --", "1TABLA", "a.b.c.d", ""])
def test_dangerous_names_are_refused(name):
    with pytest.raises(ValueError, match="identifier"):
        lake.checked_name(name)


def test_lake_keys_and_retention(spark):
    assert lake.object_key("raw", "atenciones", "2026-10-07", "a.csv") == "raw/atenciones/fecha=2026-10-07/a.csv"
    with pytest.raises(ValueError):
        lake.object_key("temporal", "atenciones", "2026-10-07", "a.csv")
    objects = spark.createDataFrame(
        [(layer, dt.date(2026, 1, 1)) for layer in ("raw", "staged", "cuarentena", "reportes")], "capa string, escrito_en date"
    )
    for day, layers in (("2026-03-31", set()), ("2026-04-01", {"cuarentena"}), ("2029-01-01", {"raw", "staged", "cuarentena"})):
        expired = lake.retention_expired(objects, F.lit(day).cast("date"))
        assert {r.capa for r in expired.collect()} == layers


def test_grid_of_many_arrays_of_places(spark, monkeypatch):
    from wardgrid.operators import grid

    monkeypatch.setattr(grid, "CHUNK", 7)
    days = spark.createDataFrame([(DAY + dt.timedelta(i), i) for i in range(9)], "fecha date, n int")
    places = spark.range(50).select(F.col("id").cast("string").alias("ubigeo"), (F.col("id") * 2).alias("x.y"))
    found = grid.dense_grid(days, places, "ubigeo")
    assert found.columns == ["fecha", "n", "ubigeo", "x.y"]
    assert sorted(map(tuple, found.collect())) == sorted((DAY + dt.timedelta(i), i, str(k), 2 * k) for i in range(9) for k in range(50))
    for a, b in ((days.limit(0), places), (days, places.limit(0))):
        assert grid.dense_grid(a, b, "ubigeo").collect() == []
