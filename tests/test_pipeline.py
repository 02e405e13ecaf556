"""Landed files to report, in batch and as a stream."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from wardgrid import schemas
from wardgrid.errors import QualityGateError
from wardgrid.plans import pipeline
from wardgrid.plans.models import build_models
from wardgrid.plans.refresh import refresh_mart
from wardgrid.sources import daytable
from wardgrid.sources.catalogue import district_aliases, districts
from wardgrid.streaming.landing import ingest_landed

HEADER = "Fecha Atención;Cod. Clínica;Distrito;Grupo Edad;Diagnóstico CIE10;N° Atenciones"
DAYS = [dt.date(2026, 10, 1) + dt.timedelta(i) for i in range(4)]


def land(folder, day, rows):
    folder.mkdir(exist_ok=True)
    text = "\r\n".join([HEADER, *rows, ""])
    (folder / f"atenciones_{day}.csv").write_bytes(text.encode("cp1252"))


def visits(day, n):
    return [f"{day:%d/%m/%Y};CLI-{i};{place};60 +;J45;{n}" for i, place in enumerate(["Ate", "Ñuñoa", "S.J.L.", "ate vitarte"])]


def api_pages(folder, day, value):
    sensors = [{"id": 5001, "name": "x", "parameter": {"id": 2, "name": "pm25", "units": "µg/m³"}}]
    station = {"id": 101, "name": "Fija", "isMobile": False, "coordinates": {"latitude": -12.0262, "longitude": -76.919},
               "datetimeLast": {"utc": "2026-10-08T05:00:00Z"}, "sensors": sensors}
    (folder / "stations").mkdir(parents=True)
    (folder / "stations" / "1.json").write_text(json.dumps({"results": [station]}, indent=1))
    item = {"value": value, "parameter": sensors[0]["parameter"],
            "period": {"datetimeFrom": {"local": f"{day}T00:00:00-05:00"}},
            "coverage": {"percentComplete": 75.0, "observedCount": 18}}
    (folder / "days" / "sensor_id=5001").mkdir(parents=True)
    (folder / "days" / "sensor_id=5001" / "1.json").write_text(json.dumps({"results": [item]}, indent=1))
    return str(folder / "stations"), str(folder / "days")


def test_day_by_day_to_report(spark, tmp_path):
    lake, raw_visits, raw_air = (str(tmp_path / n) for n in ("lake", "rv", "ra"))
    for i, day in enumerate(DAYS):
        land(tmp_path / "in", day, visits(day, 5 if i < 3 else 6))
    summary = pipeline.stage_visits(spark, str(tmp_path / "in"), lake)
    assert {(r.fecha, r.validas) for r in summary.collect()} == {(d, 4) for d in DAYS}
    days = summary.select("fecha")
    for _ in range(2):  # loading twice gives the same table
        pipeline.load_visits(spark, lake, raw_visits, days)
    loaded = pipeline.raw_visits(spark, raw_visits)
    assert loaded.count() == 16
    row = loaded.where("_numero_fila = 3 and fecha_atencion = date'2026-10-02'").first()
    assert row.distrito == "Ñuñoa" and "staged/atenciones/fecha=2026-10-02" in row._archivo_origen

    for i, day in enumerate(DAYS):
        pipeline.stage_air(spark, *api_pages(tmp_path / f"api{i}", day, 20.5 + i), lake, day)
    pipeline.load_air(spark, lake, raw_air, days)
    built = pipeline.build_mart(spark, raw_visits, raw_air, str(tmp_path / "mart"), str(tmp_path / "audit"))
    last = built.fact.where("fecha = date'2026-10-04' and ubigeo = '150103'").first()
    assert (last.total_atenciones, last.pm25_promedio_24h, last.variacion_vs_7d_pct) == (12, 23.5, 20.0)
    assert last.alerta_salud_publica
    audit = spark.read.parquet(str(tmp_path / "audit" / "resultados"))
    assert audit.count() == 41
    assert [(r.prueba, r.fallas) for r in audit.where("fallas > 0").collect()] == [("distritos_sin_mapear", 1)]
    assert spark.read.parquet(str(tmp_path / "audit" / "stg_atenciones" / "distritos_sin_mapear")).first()[0] == "NUNOA"

    pipeline.publish_report(built.fact, lake, days.where("fecha = date'2026-10-04'"))
    file = next((tmp_path / "lake" / "reportes" / "reporte_md" / "fecha=2026-10-04").glob("*.txt"))
    text = file.read_text("utf-8").splitlines()
    assert text[0] == "# Reporte diario — 2026-10-04"
    assert "- Distritos en ALERTA de salud publica: **2**" in text and "  - Ate, San Juan de Lurigancho" in text
    assert text[-1].startswith("Criterios:")


def test_refresh_equals_a_full_build(spark, tmp_path):
    """Days added, changed and emptied, with gaps in the calendar."""
    rng = random.Random(5)
    all_days = [dt.date(2026, 3, 1) + dt.timedelta(i) for i in range(40) if i % 6 != 5]
    loaded = dt.datetime(2026, 10, 8)

    def raw(seed):
        r = random.Random(seed)
        rows = [(d, f"C{c}", p, "0-4", "J45", r.randrange(9), c, "f", loaded)
                for d in all_days for c in range(3) for p in ("Ate", "SJL") if r.random() < 0.8]
        air = [(d, "s", "S", -12.0262, -76.918, "1", "pm25", "u", r.randrange(0, 90) * 1.0, 90.0, 20, "openaq", "f", loaded)
               for d in all_days if r.random() < 0.7]
        return rows, air

    old_visits, old_air = raw(1)
    changed = sorted(rng.sample(all_days, 6))
    gone, absent = changed[1], changed[4]  # one loses its rows, one had none before
    old_visits = [v for v in old_visits if v[0] != absent]
    old_air = [a for a in old_air if a[0] != absent]
    new_visits, new_air = raw(2)
    mix = lambda old, new: [x for x in old if x[0] not in changed] + [
        x for x in new if x[0] in changed and x[0] != gone]
    frame = lambda rows, schema: spark.createDataFrame(rows, schema)
    names = (districts(spark), district_aliases(spark))
    v, a = mix(old_visits, new_visits), mix(old_air, new_air)
    fact = build_models(frame(old_visits, schemas.RAW_VISITS), frame(old_air, schemas.RAW_AIR), *names).fact
    mart = str(tmp_path / "mart")
    fact.write.partitionBy("fecha").parquet(mart)
    for rows, schema, column, name in ((v, schemas.RAW_VISITS, "fecha_atencion", "v"), (a, schemas.RAW_AIR, "fecha", "a")):
        frame(rows, schema).write.partitionBy(column).parquet(str(tmp_path / name))
    refresh_mart(spark, str(tmp_path / "v"), str(tmp_path / "a"), mart, changed)
    want = build_models(frame(v, schemas.RAW_VISITS), frame(a, schemas.RAW_AIR), *names).fact.drop("actualizado_en")
    got = daytable.read(spark, mart, "fecha", fact.schema).select(*want.columns)
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0


def test_layers_are_written_before_the_gate_stops(spark, tmp_path):
    land(tmp_path / "in", DAYS[0], [*visits(DAYS[0], 1), *visits(DAYS[0], "N/D")[:2]])
    with pytest.raises(QualityGateError, match="33.3%"):
        pipeline.stage_visits(spark, str(tmp_path / "in"), str(tmp_path / "lake"))
    rejected = spark.read.option("header", True).csv(str(tmp_path / "lake" / "cuarentena" / "atenciones"))
    assert [r.motivo_rechazo for r in rejected.collect()] == ["num_atenciones invalido 'N/D'"] * 2


def test_file_without_rows_is_refused(spark, tmp_path):
    land(tmp_path / "in", DAYS[0], [])
    with pytest.raises(QualityGateError, match="no data rows"):
        pipeline.stage_visits(spark, str(tmp_path / "in"), str(tmp_path / "lake"))


def test_stream_loads_new_and_resubmitted_days(spark, tmp_path):
    lake, table, state = (str(tmp_path / n) for n in ("lake", "t", "state"))

    def run():
        ingest_landed(spark, str(tmp_path / "in"), lake, table, state, files_per_batch=2).awaitTermination()
        got = pipeline.raw_visits(spark, table).groupBy("fecha_atencion").agg(F.sum("num_atenciones"))
        return {r[0]: r[1] for r in got.collect()}

    for day in DAYS[:3]:
        land(tmp_path / "in", day, visits(day, 5))
    assert run() == {d: 20 for d in DAYS[:3]}
    (tmp_path / "in" / f"atenciones_{DAYS[0]}.csv").rename(tmp_path / "in" / f"a_{DAYS[0]}.csv")
    land(tmp_path / "in", DAYS[3], visits(DAYS[3], 7))
    assert run() == {**{d: 20 for d in DAYS[:3]}, DAYS[3]: 28}
    land(tmp_path / "in", dt.date(2026, 10, 9), visits(DAYS[3], 7))  # rows of another day
    (tmp_path / "in" / "b_2026-10-10.csv").write_bytes(b"x\ny\n")
    land(tmp_path / "in", dt.date(2026, 10, 11), visits(dt.date(2026, 10, 11), 1))
    with pytest.raises(Exception, match="2026-10-09: 4 of 4 rows rejected|2026-10-10: file.*no separator"):
        ingest_landed(spark, str(tmp_path / "in"), lake, table, state).awaitTermination()
    refused = str(tmp_path / "refused")
    ingest_landed(spark, str(tmp_path / "in"), lake, table, state, refused_to=refused).awaitTermination()
    assert {r.fecha.day: r.total for r in spark.read.parquet(refused).collect()} == {9: 4, 10: 0}
    got = pipeline.raw_visits(spark, table).where("fecha_atencion > '2026-10-08'")
    assert {(r.fecha_atencion, r.num_atenciones) for r in got.collect()} == {(dt.date(2026, 10, 11), 1)}


def test_stream_keeps_all_files_of_a_day(spark, tmp_path):
    """Files of one day in several batches and starts, a resubmitted file, a name in capitals."""
    def landed(folder, number, n, ending="csv"):
        folder.mkdir(exist_ok=True)
        lines = [HEADER, f"{DAYS[0]:%d/%m/%Y};CLI-{number};Ate;60 +;J45;{n}", ""]
        (folder / f"c{number}_{DAYS[0]}.{ending}").write_text("\n".join(lines))

    for size in (1, 2, 1000):
        base = tmp_path / str(size)
        base.mkdir()
        lake, table, state = (str(base / n) for n in ("lake", "t", "state"))

        def run(lake=lake, table=table, state=state, size=size, base=base):
            ingest_landed(spark, str(base / "in"), lake, table, state, files_per_batch=size).awaitTermination()
            rows = pipeline.raw_visits(spark, table).collect()
            return sorted((r.codigo_clinica, r.num_atenciones) for r in rows)

        landed(base / "in", 1, 10)
        landed(base / "in", 2, 20, "CSV")
        assert run() == [("CLI-1", 10), ("CLI-2", 20)]
        landed(base / "in", 3, 30, "txt")
        assert run() == [("CLI-1", 10), ("CLI-2", 20), ("CLI-3", 30)]
        (base / "in" / f"c1_{DAYS[0]}.csv").unlink()
        landed(base / "in", 11, 11)
        assert run() == [("CLI-11", 11), ("CLI-2", 20), ("CLI-3", 30)]


def test_station_average_ignores_row_order(spark):
    import random

    from wardgrid.operators.stations import station_day

    rows = [(DAYS[0], s, f"{k}", "n", "f", (s * 7 + k * 13 % 17) / 1000 + k / 200, 75.05, 0.0, 0.0) for s in range(300) for k in range(8)]
    names = "fecha date, estacion_id long, sensor_id string, estacion_nombre string, fuente string, valor_promedio double, cobertura_pct double, latitud double, longitud double"
    results = []
    for seed in (1, 2):
        random.Random(seed).shuffle(rows)
        found = station_day(spark.createDataFrame(rows, names).repartition(3 + seed)).collect()
        results.append(sorted((r.estacion_id, r.pm25_promedio_24h, r.cobertura_pct) for r in found))
    assert results[0] == results[1]
    from decimal import ROUND_HALF_UP, Decimal

    for station, value, _ in results[0]:
        own = [Decimal(str(round(r[5], 6))) for r in rows if r[1] == int(station)]
        assert Decimal(str(value)) == (sum(own) / len(own)).quantize(Decimal("0.01"), ROUND_HALF_UP)


def test_all_landed_sensors_are_staged(spark, tmp_path):
    day = DAYS[0]
    stations, days = api_pages(tmp_path / "api", day, 1.5)
    page = json.loads((tmp_path / "api" / "stations" / "1.json").read_text())
    item = (tmp_path / "api" / "days" / "sensor_id=5001" / "1.json").read_text()
    sensor = page["results"][0]["sensors"][0]
    page["results"][0]["sensors"] = [{**sensor, "id": 6000 + i} for i in range(50)]
    (tmp_path / "api" / "stations" / "1.json").write_text(json.dumps(page))
    for i in range(50):
        folder = tmp_path / "api" / "days" / f"sensor_id={6000 + i}"
        folder.mkdir()
        (folder / "1.json").write_text(item)
    assert pipeline.stage_air(spark, stations, days, str(tmp_path / "lake"), day).count() == 50


def test_air_of_many_days_equals_day_by_day(spark, tmp_path):
    """Sensors that stopped, repeated and null items, days without readings; failing days are named with their reasons."""
    rng = random.Random(8)
    wanted = [dt.date(2026, 10, 1) + dt.timedelta(i) for i in range(12)]
    stations, folder = [], tmp_path / "api"
    for k in range(9):
        sensors = [{"id": 100 * k + s, "parameter": {"name": p}} for s, p in enumerate(["pm25", "pm10", "pm25"])]
        seen = {"utc": f"{wanted[k]}T05:00:00Z"} if k < 8 else None
        stations.append({"id": k, "name": f"S{k}", "isMobile": k == 7, "coordinates": {"latitude": 1.0, "longitude": k * 1.0}, "datetimeLast": seen, "sensors": sensors})
        for sensor in sensors:
            items = [
                {"value": None if rng.random() < 0.2 else rng.randrange(1000) / 7, "period": {"datetimeFrom": {"local": f"{d}T00:00:00"}}}
                for d in rng.choices([x for x in wanted if x != wanted[2]], k=20)
            ]
            (folder / "days" / f"sensor_id={sensor['id']}").mkdir(parents=True)
            (folder / "days" / f"sensor_id={sensor['id']}" / "1.json").write_text(json.dumps({"results": [*items, {"value": 1.0}]}))
    (folder / "stations").mkdir()
    (folder / "stations" / "1.json").write_text(json.dumps({"results": stations}))
    places = (str(folder / "stations"), str(folder / "days"))
    days = spark.createDataFrame([(d,) for d in [*wanted, wanted[0]]], "fecha date")
    with pytest.raises(QualityGateError) as caught:
        pipeline.stage_air(spark, *places, str(tmp_path / "all"), days)
    said = str(caught.value)
    assert f"no station reported pm25 for {wanted[2]}" in said and f"no active pm25 sensor for {wanted[7]}" in said
    together = pipeline.stage_air(spark, *places, str(tmp_path / "again"), days, strict=False)
    columns = [c for c in together.columns if c != "n_observaciones"]
    apart = []
    for day in wanted:
        try:
            apart += pipeline.stage_air(spark, *places, str(tmp_path / "one"), day).select(columns).collect()
        except QualityGateError:
            assert str(day) in said
    assert sorted(map(tuple, apart)) == sorted(map(tuple, together.select(columns).collect())) and len(apart) > 20
    for lake in ("all", "one"):
        stored = spark.read.schema(schemas.AIR_LINES).json(str(tmp_path / lake / "raw" / "calidad_aire"))
        assert sorted(map(tuple, stored.select("fecha", "sensor_id", "valor_promedio").collect())) == sorted((r.fecha, r.sensor_id, r.valor_promedio) for r in apart)


def test_station_average_of_odd_readings(spark):
    """Values beyond the type or no numbers are missing; a station's position does not depend on the order of rows."""
    from wardgrid.operators.stations import station_day

    names = "fecha date, estacion_id long, sensor_id string, estacion_nombre string, fuente string, valor_promedio double, cobertura_pct double, latitud double, longitud double"
    odd = [1e12, 1e13, -1e300, float("nan"), float("inf"), None]
    rows = [(DAYS[0], 1, f"s{i}", "n", "f", v, 50.0, 1.0, 2.0) for i, v in enumerate(odd)]
    rows += [(DAYS[0], 1, "ok", "n", "f", 10.0, 1e13, float("nan"), 2.5), (DAYS[0], 1, "ok2", "n", "f", 20.0, 70.0, 0.1, None)]
    rows += [(DAYS[0], 2, "only", "n", "f", 1e14, 1.0, 1.0, 1.0)]
    found = station_day(spark.createDataFrame(rows, names)).collect()
    assert [(r.estacion_id, r.pm25_promedio_24h, r.cobertura_pct, r.latitud, r.longitud, r.sensores) for r in found] == [("1", 15.0, 70.0, 0.1, 2.5, 2)]

    rng = random.Random(2)
    rows = [(DAYS[0], 7, str(k), "n", "f", 1.0, 1.0, rng.uniform(-12.2, -11.8), rng.uniform(-77.2, -76.8)) for k in range(3000)]
    seen = set()
    for parts in (1, 3, 11):
        rng.shuffle(rows)
        r = station_day(spark.createDataFrame(rows, names).repartition(parts)).first()
        seen.add((r.latitud, r.longitud))
    assert len(seen) == 1


def test_positions_over_ranges(spark):
    from wardgrid.operators.ranking import with_position

    values = [(random.Random(i).randrange(50), i) for i in range(5000)] + [(None, -1)]
    table = spark.createDataFrame(values, "v int, i int").repartition(13)
    found = with_position(table, [F.desc_nulls_last("v"), F.asc("i")], "place").collect()
    want = sorted(values, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    assert sorted((r.place, r.v, r.i) for r in found) == [(n, *r) for n, r in enumerate(want, 1)]
    assert with_position(table.limit(0), [F.asc("i")]).collect() == []


def test_late_files_cost_their_own_scan_only(spark, tmp_path, monkeypatch):
    """Files scanned before are not read again, unless they changed; gone ones take their rows along."""
    import os

    from wardgrid.streaming import landing

    scanned = []
    once = landing.scan_files

    def counted(session, paths, *more):
        scanned.append(sorted(p.rsplit("/", 1)[1] for p in paths))
        return once(session, paths, *more)

    monkeypatch.setattr(landing, "scan_files", counted)
    folder, (lake, table, state) = tmp_path / "in put%", (str(tmp_path / n) for n in ("lake", "t", "state"))
    folder.mkdir()

    def put(name, day, n):
        (folder / f"{name}_{day}.csv").write_text("\n".join([HEADER, f"{day:%d/%m/%Y};{name};Ate;60 +;J45;{n}", ""]))

    def run():
        scanned.clear()
        ingest_landed(spark, str(folder), lake, table, state).awaitTermination()
        return sorted((r.fecha_atencion.day, r.codigo_clinica, r.num_atenciones) for r in pipeline.raw_visits(spark, table).collect())

    put("a", DAYS[0], 1)
    put("b", DAYS[0], 2)
    put("c", DAYS[1], 3)
    assert run() == [(1, "a", 1), (1, "b", 2), (2, "c", 3)] and len(scanned) == 1
    put("late 1", DAYS[0], 4)
    assert run() == [(1, "a", 1), (1, "b", 2), (1, "late 1", 4), (2, "c", 3)] and scanned == [["late 1_2026-10-01.csv"]]
    put("b", DAYS[0], 20)  # in place: seen when its day is touched again
    os.utime(folder / "b_2026-10-01.csv", (2e9, 2e9))
    (folder / "a_2026-10-01.csv").unlink()
    put("e", DAYS[0], 5)
    assert run() == [(1, "b", 20), (1, "e", 5), (1, "late 1", 4), (2, "c", 3)]
    assert scanned == [["b_2026-10-01.csv", "e_2026-10-01.csv"]]
    assert run() and scanned == []
