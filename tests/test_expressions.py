"""Text, date, rounding and distance expressions."""

import datetime as dt
import math
import random
import unicodedata
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from wardgrid.functions.dates import business_day, parse_day, resolve_run_day
from wardgrid.functions.geo import haversine_km
from wardgrid.functions.rounding import ratio_half_up, round_binary
from wardgrid.functions.text import canonical_header, normalize_header, normalize_text, strip
from wardgrid.operators.proximity import nearest_per_key, radius_pairs


def evaluate(spark, values, kind, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_headers(spark):
    samples = ["N° Atenciones", "Fecha Atención", " Cod. Clínica ", "Diagnóstico CIE10", "Nº ½ ﬁn", "a°b", "__x--y__", "№"]
    expected = ["n_atenciones", "fecha_atencion", "cod_clinica", "diagnostico_cie10", "no_12_fin", "ab", "x_y", "no"]
    assert evaluate(spark, samples, "string", normalize_header) == expected
    assert evaluate(spark, ["Cie10", "Grupo Etario", "otra"], "string", canonical_header) == [
        "diagnostico_cie10", "grupo_edad", "otra",
    ]


def test_headers_follow_the_compatibility_decomposition(spark):
    rng = random.Random(3)
    samples = ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(160, 9000), 0xFB01])) for _ in range(12))
               for _ in range(200)]
    def plain(text):
        kept = unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode().lower()
        return "_".join("".join(c if c.isalnum() else " " for c in kept).split())
    assert evaluate(spark, samples, "string", normalize_header) == [plain(s) for s in samples]


def test_normalize_text(spark):
    assert evaluate(spark, ["San Martín de  Porres ", " ñaña\t ü "], "string", normalize_text) == [
        "SAN MARTIN DE PORRES", "NANA U",
    ]


def test_strip_removes_unicode_blanks(spark):
    samples = ["  x  ", "　 y\x1f\n", "  "]
    assert evaluate(spark, samples, "string", strip) == [s.strip() for s in samples]


def test_dates(spark):
    formats = ("%Y-%m-%d", "%d/%m/%Y", "%d-%m-%Y")
    samples = [
        "2026-10-07", "07/10/2026", "7/1/2026", "07-10-2026", " 07/10/2026 ", "2026-1-5", "31/02/2026", "29/02/2024",
        "29/02/2023", "07/10/26", "2026/10/07", "07-10/2026", "", "x", "0000-01-01", "2026-13-01", "2026-10-07T00:00",
        "00/10/2026", "2026-10- 7", "+2026-10-07", "٠٧/١٠/٢٠٢٦", "07/10/٢٠٢٦", "1٧/10/2026", "12026-01-01",
    ]

    def expected(text):
        for f in formats:
            try:
                return dt.datetime.strptime(text.strip(), f).date()
            except ValueError:
                pass
        return None

    assert evaluate(spark, samples, "string", parse_day) == [expected(s) for s in samples]


def test_business_day(spark):
    instants = [dt.datetime(2026, 10, 8, 11, tzinfo=dt.UTC), dt.datetime(2026, 10, 9, 2, tzinfo=dt.UTC)]
    days = evaluate(spark, instants, "timestamp", lambda c: business_day(c, "America/Lima"))
    assert days == [dt.date(2026, 10, 7)] * 2
    lima = ZoneInfo("America/Lima")
    assert resolve_run_day(None, instants[1]) == dt.date(2026, 10, 7)
    assert resolve_run_day("2026-09-15", dt.datetime(2026, 10, 8, tzinfo=lima)) == dt.date(2026, 9, 15)
    with pytest.raises(ValueError, match="YYYY-MM-DD"):
        resolve_run_day("15/09/2026")
    with pytest.raises(ValueError, match="time zone"):
        resolve_run_day(None, dt.datetime(2026, 10, 8))


@pytest.mark.parametrize("digits", [1, 3])
def test_round_binary_is_exact(spark, digits):
    rng = random.Random(digits)
    values = [0.0, -0.0, 12.25, 12.35, 2.675, 28.7465, 0.15, -0.15, 0.05, 1e15 + 0.3, 38.45, 38.25, -12.25, 0.25]
    values += [rng.randrange(-10**6, 10**6) / 10 ** (digits + 1) for _ in range(3000)]
    values += [rng.randrange(-10**6, 10**6) * 5 / 10 ** (digits + 1) for _ in range(3000)]
    got = evaluate(spark, values, "double", lambda c: round_binary(c, digits))
    assert got == [round(v, digits) for v in values]


def test_ratio_half_up(spark):
    from decimal import ROUND_HALF_UP, Decimal

    pairs = [(a, b) for a in range(-40, 41) for b in (1, 3, 7, 8, 20)]
    df = spark.createDataFrame(pairs, "a bigint, b bigint")
    for r in df.select("a", "b", ratio_half_up(F.col("a"), F.col("b"), 1).alias("x")).collect():
        assert r.x == float((Decimal(r.a) / Decimal(r.b)).quantize(Decimal("0.1"), ROUND_HALF_UP))


def _distance(a, b):
    (la, lo), (lb, lp) = [tuple(map(math.radians, p)) for p in (a, b)]
    h = math.sin((lb - la) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin((lp - lo) / 2) ** 2
    return 2 * 6371.0 * math.asin(math.sqrt(min(1.0, h)))


@pytest.mark.parametrize("radius", [0.5, 10.0, 400.0])
def test_radius_pairs_on_the_whole_globe(spark, radius):
    rng = random.Random(int(radius * 10))
    corners = [(89.99, 10.0), (90.0, 0.0), (-89.95, -170.0), (0.0, 180.0), (12.0, -180.0), (12.0, 179.999), (-12.05, -77.04)]
    spots = corners + [(math.degrees(math.asin(rng.uniform(-1, 1))), rng.uniform(-180, 180)) for _ in range(60)]

    def near(spot):
        scale = radius / 111
        lat = max(-90.0, min(90.0, spot[0] + rng.uniform(-1.3, 1.3) * scale))
        lon = spot[1] + rng.uniform(-1.3, 1.3) * scale / max(0.001, math.cos(math.radians(spot[0])))
        return lat, (lon + 180) % 360 - 180

    points = spots + [near(s) for s in spots for _ in range(8)]
    p = spark.createDataFrame([(i, *s) for i, s in enumerate(points)], "p int, plat double, plon double")
    q = spark.createDataFrame([(i, *s) for i, s in enumerate(spots)], "q int, qlat double, qlon double")
    pairs = radius_pairs(p, q, radius, point_position=("plat", "plon"), place_position=("qlat", "qlon"))
    rows = pairs.collect()
    got = {(r.p, r.q) for r in rows}
    assert len(rows) == len(got)
    for i, a in enumerate(points):
        for j, b in enumerate(spots):
            d = _distance(a, b)
            if abs(d - radius) > 1e-6:
                assert ((i, j) in got) == (d < radius), (a, b, d)
    plan = pairs._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_nearest_breaks_ties_by_id(spark):
    pairs = spark.createDataFrame(
        [("a", "s2", 1.0, 5), ("a", "s10", 1.0, 6), ("a", "s0", 2.0, 7), ("b", "s9", 3.0, 8)],
        "k string, s string, d double, x int",
    )
    got = nearest_per_key(pairs, ["k"], ["d", "s"], ["s", "d", "x"]).orderBy("k").collect()
    assert [tuple(r) for r in got] == [("a", "s10", 1.0, 6), ("b", "s9", 3.0, 8)]


def test_haversine_known_distance(spark):
    d = spark.range(1).select(haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0))).first()[0]
    assert d == pytest.approx(111.19493, abs=1e-4)
