"""Checks kept day by day: what a day adds to each check is stored, and stored days are merged.

A day keeps, per rule, a number of failing rows or keys (``filas``), the distinct values of a column
(``valor``), or sums (``suma``). Merging reads these rows only, a few per day and rule and one per distinct
value, so a changed day costs its own rows however long the history is. Values and texts are compared with
the dictionaries at merging, so a changed dictionary needs no day to be taken again.

Defined cases: null values are kept by no rule but those that count nulls; a day without rows keeps
nothing and fails nothing; rows without a day belong to no stored day, and storing them is an error.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from .quality import Allowed, SameTotals, TableChecks, Total, Unique, run_checks
from .reconcile import reconcile_totals

STATE = "fecha date, tabla string, prueba string, clase string, valor string, filas bigint, suma bigint"
_COUNT, _VALUE, _SUM = "filas", "valor", "suma"
_RULE = ["tabla", "prueba"]


def _rows(found: DataFrame, table: str, kind: str) -> DataFrame:
    """``found`` has fecha, prueba and some of valor, filas, suma."""
    missing = {"valor": "string", "filas": "bigint", "suma": "bigint"}
    columns = [F.col(c).cast(t) if c in found.columns else F.lit(None).cast(t).alias(c) for c, t in missing.items()]
    return found.select("fecha", F.lit(table).alias("tabla"), "prueba", F.lit(kind).alias("clase"), *columns)


def _row_rules(checks: TableChecks) -> DataFrame:
    counts = checks.data.groupBy(F.col(checks.day).alias("fecha")).agg(
        *(F.count_if(r.violated).alias(f"n{i}") for i, r in enumerate(checks.rows))
    )
    each = [F.struct(F.lit(r.name).alias("prueba"), F.col(f"n{i}").alias("filas")) for i, r in enumerate(checks.rows)]
    return _rows(counts.select("fecha", F.inline(F.array(*each))), checks.table, _COUNT)


def _unique(checks: TableChecks, name: str, rule: Unique) -> DataFrame:
    if checks.day not in rule.columns:
        raise ValueError(f"{checks.table}.{name}: a key without {checks.day} can repeat across days")
    repeated = checks.data.groupBy(*rule.columns).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    days = repeated.groupBy(F.col(checks.day).alias("fecha")).agg(F.count(F.lit(1)).alias("filas"))
    return _rows(days.withColumn("prueba", F.lit(name)), checks.table, _COUNT)


def _values(checks: TableChecks, rules: dict[str, Allowed]) -> DataFrame:
    """Distinct values of all columns that rules look at, in one pass."""
    each = [F.struct(F.lit(n).alias("prueba"), F.col(r.column).cast("string").alias("valor")) for n, r in rules.items()]
    values = checks.data.select(F.col(checks.day).alias("fecha"), F.inline(F.array(*each))).where("valor is not null")
    return _rows(values.groupBy("fecha", "prueba", "valor").agg(F.count(F.lit(1)).alias("filas")), checks.table, _VALUE)


def _total(name: str, total: Total) -> DataFrame:
    keys = {"fecha": F.col(total.day), "prueba": F.lit(name)} | ({"valor": F.col(total.text)} if total.text else {})
    sums = total.data.groupBy(*(c.alias(k) for k, c in keys.items())).agg(F.sum(total.value).alias("suma"))
    return _rows(sums if total.text is None else sums.where("valor is not null"), total.table, _SUM)


def day_states(all_checks: list[TableChecks], tables: set[str]) -> DataFrame:
    """The states of all days of ``tables``, as their checks' data have them."""
    parts: list[DataFrame] = []
    for checks in all_checks:
        of_table = checks.day is not None and checks.table in tables
        if of_table and checks.rows:
            parts.append(_row_rules(checks))
        if of_table and (allowed := {s.name: s.by_day for s in checks.sets if isinstance(s.by_day, Allowed)}):
            parts.append(_values(checks, allowed))
        for s in checks.sets:
            if of_table and isinstance(s.by_day, Unique):
                parts.append(_unique(checks, s.name, s.by_day))
            if isinstance(s.by_day, SameTotals):
                parts += [_total(s.name, t) for t in (s.by_day.left, s.by_day.right) if t.table in tables]
    return reduce(DataFrame.unionByName, parts)


def _by_day(all_checks: list[TableChecks]) -> list[TableChecks]:
    for c in all_checks:
        if c.day is not None and (unkept := [s.name for s in c.sets if s.by_day is None]):
            raise ValueError(f"{c.table}: no rule by days for {', '.join(unkept)}")
    return [c for c in all_checks if c.day is not None]


def _known(total: Total, states: DataFrame, name: str) -> DataFrame:
    own = states.where((F.col("clase") == _SUM) & (F.col("tabla") == total.table) & (F.col("prueba") == name))
    if total.known is None:
        return own
    known = total.known.toDF("_known")
    return own.join(known, F.col("valor") == F.col("_known"))


def failures_by_day(states: DataFrame, all_checks: list[TableChecks]) -> DataFrame:
    """fecha, tabla, prueba, valor, fallas: where and, for rules on values, with which value checks fail.

    The days that it names are the only ones to read for the failing rows.
    """
    spark, rules = states.sparkSession, _by_day(all_checks)
    result = ["fecha", *_RULE, "valor", "fallas"]
    counted = states.where((F.col("clase") == _COUNT) & (F.col("filas") > 0)).withColumn("fallas", F.col("filas"))
    parts = [counted.select(*result)]
    lists: list[tuple[str, str, str]] = []
    allowed: list[DataFrame] = []
    for c in rules:
        for s in c.sets:
            if isinstance(s.by_day, Allowed):
                if isinstance(s.by_day.values, DataFrame):
                    parent = s.by_day.values.toDF("valor").select(F.col("valor").cast("string")).distinct()
                    allowed.append(parent.select(F.lit(c.table).alias("tabla"), F.lit(s.name).alias("prueba"), "valor"))
                else:
                    lists += [(c.table, s.name, v) for v in s.by_day.values]
            if isinstance(s.by_day, SameTotals):
                left, right = (_known(t, states, s.name) for t in (s.by_day.left, s.by_day.right))
                differ = reconcile_totals(left, "fecha", "suma", right, "fecha", "suma")
                named = differ.withColumns({"tabla": F.lit(c.table), "prueba": F.lit(s.name), "valor": F.lit(None).cast("string")})
                parts.append(named.withColumn("fallas", F.lit(1).cast("bigint")).select(*result))
    allowed.append(spark.createDataFrame(lists, "tabla string, prueba string, valor string"))
    values = states.where(F.col("clase") == _VALUE).join(reduce(DataFrame.unionByName, allowed), [*_RULE, "valor"], "left_anti")
    parts.append(values.withColumn("fallas", F.col("filas")).select(*result))
    return reduce(DataFrame.unionByName, parts)


def merged_checks(states: DataFrame, all_checks: list[TableChecks]) -> DataFrame:
    """As ``run_checks`` on the whole tables: one row per check. Of ``all_checks`` only tables without days are read."""
    spark = states.sparkSession
    names = [(c.table, r.name, r.severity) for c in _by_day(all_checks) for r in (*c.rows, *c.sets)]
    declared = spark.createDataFrame(names, "tabla string, prueba string, severidad string")
    # a value counts once however many days have it; other failures add up
    found = failures_by_day(states, all_checks).groupBy(*_RULE).agg(
        (F.countDistinct("valor") + F.coalesce(F.sum(F.when(F.col("valor").isNull(), F.col("fallas"))), F.lit(0))).alias("fallas")
    )
    results = declared.join(found, _RULE, "left").fillna(0, ["fallas"])
    results = results.withColumn("estado", F.when(F.col("fallas") == 0, "pass").otherwise(F.col("severidad")))
    whole = [c for c in all_checks if c.day is None]
    return results.unionByName(run_checks(whole)) if whole else results

