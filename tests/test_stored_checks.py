"""Checks merged from stored days equal the checks of the whole tables."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from wardgrid import schemas
from wardgrid.errors import PartitionError
from wardgrid.operators.day_checks import day_states, failures_by_day, merged_checks
from wardgrid.operators.quality import (
    RowRule, SameTotals, SetRule, TableChecks, Total, domain_rule, is_null, negative, parent_rule, run_checks, unique_rule,
)
from wardgrid.operators.reconcile import reconcile_totals
from wardgrid.plans import stored_checks
from wardgrid.plans.checks import declared_checks
from wardgrid.plans.models import build_models
from wardgrid.sources import daytable
from wardgrid.sources.catalogue import district_aliases, districts

DAYS = [dt.date(2026, 3, 1) + dt.timedelta(i) for i in range(24)]
LOADED = dt.datetime(2026, 10, 8)


def results(frame):
    return sorted(tuple(r[c] for c in ("tabla", "prueba", "severidad", "fallas", "estado")) for r in frame.collect())


def small_checks(spark, rows, totals, known):
    """rows: (day, key, text, number); a table with every kind of rule."""
    data = spark.createDataFrame([(DAYS[d] if d is not None else None, *r) for d, *r in rows], "dia date, k int, t string, n bigint")
    other = spark.createDataFrame([(DAYS[d], n) for d, n in totals], "dia date, n bigint")
    parent = spark.createDataFrame([(k,) for k in known], "v string")
    joined = data.join(parent, F.col("t") == F.col("v"))
    same = SameTotals(Total("a", data, "dia", "n", "t", parent), Total("b", other, "dia", "n"))
    return [
        TableChecks("a", data, (RowRule("t_nulo", is_null("t")), RowRule("n_negativo", negative("n"))), (
            unique_rule("unico", data, ["dia", "k"]), domain_rule("dominio", data, "t", ("x", "y")),
            parent_rule("relacion", data, "t", parent, "v", "warn")), day="dia"),
        TableChecks("b", other, (RowRule("n_negativo", negative("n")),), day="dia"),
        TableChecks("suma", other, (), (SetRule("iguales", reconcile_totals(joined, "dia", "n", other, "dia", "n"), by_day=same),), day="dia"),
        TableChecks("p", parent, (RowRule("v_nulo", is_null("v")),)),
    ]


@pytest.mark.parametrize("seed", range(3))
def test_merged_states_equal_whole_checks(spark, seed):
    r = random.Random(seed)
    rows = [(r.randrange(6), r.randrange(4), r.choice(["x", "y", "z", "ñ ", "", None]), r.choice([1, 2, -1, None])) for _ in range(r.randrange(1, 60))]
    totals = [(r.randrange(8), r.choice([1, 3, None])) for _ in range(9)]
    checks = small_checks(spark, rows, totals, ["x", "z", "z", None] if seed else [])
    assert results(merged_checks(day_states(checks, {"a", "b"}), checks)) == results(run_checks(checks))


def test_empty_tables_and_named_days(spark):
    nothing = small_checks(spark, [], [], [])
    assert results(merged_checks(day_states(nothing, {"a", "b"}), nothing)) == results(run_checks(nothing))
    checks = small_checks(spark, [(0, 1, "x", 1), (1, 1, "q", -1), (3, 1, "q", 1), (3, 1, "x", 1)], [(0, 1), (3, 1), (5, 2)], ["x"])
    found = {(DAYS.index(r.fecha), r.tabla, r.prueba, r.valor, r.fallas) for r in failures_by_day(day_states(checks, {"a", "b"}), checks).collect()}
    assert found == {
        (1, "a", "n_negativo", None, 1), (3, "a", "unico", None, 1), (1, "a", "dominio", "q", 1), (3, "a", "dominio", "q", 1),
        (1, "a", "relacion", "q", 1), (3, "a", "relacion", "q", 1), (5, "suma", "iguales", None, 1),
    }
    assert ("a", "dominio", "error", 1, "error") in results(merged_checks(day_states(checks, {"a", "b"}), checks))


def test_rules_that_days_cannot_keep(spark, tmp_path):
    checks = small_checks(spark, [(None, 1, "x", 1)], [], ["x"])
    with pytest.raises(PartitionError, match="not requested"):  # a row without a day belongs to no stored day
        daytable.replace_days(day_states(checks, {"a"}), str(tmp_path / "s"), "fecha", spark.createDataFrame([], "fecha date"))
    data = checks[0].data
    with pytest.raises(ValueError, match="can repeat across days"):
        day_states([TableChecks("a", data, (), (unique_rule("u", data, ["k"]),), day="dia")], {"a"})
    with pytest.raises(ValueError, match="no rule by days for libre"):
        merged_checks(day_states(checks, {"a"}), [TableChecks("a", data, (), (SetRule("libre", data),), day="dia")])


def test_refreshed_states_equal_a_full_run(spark, tmp_path):
    """Days changed, added and emptied, odd values among them; then places and spellings change without a day read again."""
    def raw(seed):
        r = random.Random(seed)
        visits = [(d, f"C{c}", r.choice(["Ate", "SJL", "Nowhere", "N 2"]), r.choice(["0-4", "99"]), "J45", r.randrange(-1, 9), c, "f", LOADED)
                  for d in DAYS for c in range(3) if r.random() < 0.8]
        air = [(d, "s", "S", -12.0262, -76.918, "1", "pm25", "u", r.choice([5.0, 2000.0]), 90.0, 20, r.choice(["openaq", "odd"]), "f", LOADED)
               for d in DAYS if r.random() < 0.7]
        return visits, air

    paths = {n: str(tmp_path / n) for n in ("v", "a", "mart", "states")}
    changed = [DAYS[i] for i in (2, 3, 11, 23)]
    gone, absent = changed[1], changed[3]
    (old_v, old_a), (new_v, new_a) = raw(1), raw(2)
    old_v, old_a = ([x for x in rows if x[0] != absent] for rows in (old_v, old_a))
    now_v, now_a = ([x for x in old if x[0] not in changed] + [x for x in new if x[0] in changed and x[0] != gone] for old, new in ((old_v, new_v), (old_a, new_a)))
    area, names = districts(spark), district_aliases(spark)

    def full(v, a, names=names):
        return build_models(spark.createDataFrame(v, schemas.RAW_VISITS), spark.createDataFrame(a, schemas.RAW_AIR), area, names)

    first = full(old_v, old_a)
    days = first.fact.select("fecha").distinct()
    daytable.replace_days(first.fact, paths["mart"], "fecha", days)
    stored_checks.store_all_states(first, paths["states"])
    assert results(stored_checks.stored_results(spark, paths["states"], area, names)) == results(run_checks(declared_checks(first)))

    for rows, schema, column, name in ((now_v, schemas.RAW_VISITS, "fecha_atencion", "v"), (now_a, schemas.RAW_AIR, "fecha", "a")):
        spark.createDataFrame(rows, schema).write.partitionBy(column).parquet(paths[name])
    got = stored_checks.refresh_checked(spark, paths["v"], paths["a"], paths["mart"], paths["states"], changed)
    second = full(now_v, now_a)
    want = results(run_checks(declared_checks(second)))
    assert results(got) == want and any(r[3] for r in want)
    failing = stored_checks.stored_failures(spark, paths["states"], area, names)
    assert gone not in {r.fecha for r in failing.where("tabla like 'stg%'").collect()}

    # unknown spellings are compared with the dictionary at merging
    more = names.unionByName(spark.createDataFrame([("NOWHERE", names.first().ubigeo)], names.select("alias_normalizado", "ubigeo").schema), allowMissingColumns=True)
    unmapped = {r[1]: r[3] for r in results(stored_checks.stored_results(spark, paths["states"], area, more)) if r[0] == "stg_atenciones"}
    before = {r[1]: r[3] for r in want if r[0] == "stg_atenciones"}
    assert unmapped["distritos_sin_mapear"] == before["distritos_sin_mapear"] - 1
