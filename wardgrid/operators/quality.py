"""Reusable data-quality checks.

A check yields its violations as a DataFrame. Row rules of one table are counted
together in a single pass, and only the rules that fail are looked up again.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..errors import QualityGateError
from .resolve import unmatched_values

ERROR, WARN = "error", "warn"


# --------------------------------------------------------------- violations
def duplicates(df: DataFrame, columns: list[str]) -> DataFrame:
    """Key combinations that occur more than once."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("repeticiones")).where("repeticiones > 1")


def repeated_values(df: DataFrame, column: str) -> DataFrame:
    """Non-null values that occur more than once."""
    return duplicates(df.where(F.col(column).isNotNull()), [column])


def negative(column: str) -> Column:
    return F.col(column) < 0


def out_of_range(column: str, low: float, high: float) -> Column:
    """Outside the closed range; null is not a violation."""
    return F.col(column).isNotNull() & ((F.col(column) < F.lit(low)) | (F.col(column) > F.lit(high)))


def is_null(column: str) -> Column:
    return F.col(column).isNull()


def not_accepted(df: DataFrame, column: str, accepted: tuple[str, ...]) -> DataFrame:
    """Non-null values outside the domain, with their row count."""
    return (
        df.where(F.col(column).isNotNull() & ~F.col(column).isin(*accepted))
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("filas"))
    )


def orphans(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Foreign-key values without a parent, with their row count."""
    return unmatched_values(df, column, parent, parent_column)


def freshness(
    df: DataFrame, loaded_at: str, as_of: Column, warn_hours: int = 36, error_hours: int = 72
) -> DataFrame:
    """One row: latest load, its age and the status."""
    age = F.unix_micros(F.lit(as_of).cast("timestamp")) - F.unix_micros(F.col("ultimo").cast("timestamp"))
    hours = age / F.lit(3_600_000_000)
    status = (
        F.when(F.col("ultimo").isNull() | (hours > error_hours), ERROR).when(hours > warn_hours, WARN).otherwise("pass")
    )
    return df.agg(F.max(loaded_at).alias("ultimo")).select(
        "ultimo", hours.alias("antiguedad_horas"), status.alias("estado")
    )


# ------------------------------------------------------------- declarations
@dataclass(frozen=True)
class RowRule:
    """A condition that marks a row as a violation."""

    name: str
    violated: Column
    shown: tuple[str, ...] = ()
    severity: str = ERROR


@dataclass(frozen=True)
class Unique:
    """A key that holds the table's day: its repetitions lie within a day."""

    columns: tuple[str, ...]


@dataclass(frozen=True)
class Allowed:
    """Values of a column are the given ones or those of a parent; the days keep the distinct values."""

    column: str
    values: tuple[str, ...] | DataFrame


@dataclass(frozen=True)
class Total:
    """The sum of a column per day, of the rows whose text is known where ``known`` is given."""

    table: str
    data: DataFrame
    day: str
    value: str
    text: str | None = None
    known: DataFrame | None = None


@dataclass(frozen=True)
class SameTotals:
    """Two totals that must agree on every day."""

    left: Total
    right: Total


@dataclass(frozen=True)
class SetRule:
    """A DataFrame of violations that needs grouping or a join; ``by_day`` says how days keep what it needs."""

    name: str
    violations: DataFrame
    severity: str = ERROR
    by_day: Unique | Allowed | SameTotals | None = None


@dataclass(frozen=True)
class TableChecks:
    """All checks of one table; ``day`` names its day column, if it has one."""

    table: str
    data: DataFrame
    rows: tuple[RowRule, ...] = ()
    sets: tuple[SetRule, ...] = field(default=())
    day: str | None = None


def unique_rule(name: str, df: DataFrame, columns: list[str]) -> SetRule:
    return SetRule(name, duplicates(df, columns), by_day=Unique(tuple(columns)))


def domain_rule(name: str, df: DataFrame, column: str, accepted: tuple[str, ...]) -> SetRule:
    return SetRule(name, not_accepted(df, column, accepted), by_day=Allowed(column, accepted))


def parent_rule(
    name: str, df: DataFrame, column: str, parent: DataFrame, parent_column: str, severity: str = ERROR
) -> SetRule:
    return SetRule(name, orphans(df, column, parent, parent_column), severity, Allowed(column, parent.select(parent_column)))


# -------------------------------------------------------------------- runner
def _row_counts(checks: TableChecks) -> DataFrame:
    """Violations of every row rule of a table, counted in one scan."""
    counts = checks.data.agg(*(F.count_if(r.violated).alias(f"n{i}") for i, r in enumerate(checks.rows)))
    rows = [
        F.struct(
            F.lit(checks.table).alias("tabla"),
            F.lit(r.name).alias("prueba"),
            F.lit(r.severity).alias("severidad"),
            F.col(f"n{i}").alias("fallas"),
        )
        for i, r in enumerate(checks.rows)
    ]
    return counts.select(F.inline(F.array(*rows)))


def _set_counts(checks: TableChecks) -> list[DataFrame]:
    return [
        s.violations.agg(F.count(F.lit(1)).alias("fallas")).select(
            F.lit(checks.table).alias("tabla"),
            F.lit(s.name).alias("prueba"),
            F.lit(s.severity).alias("severidad"),
            "fallas",
        )
        for s in checks.sets
    ]


def run_checks(all_checks: list[TableChecks]) -> DataFrame:
    """One row per check: table, check, severity, failures, status."""
    parts: list[DataFrame] = []
    for checks in all_checks:
        if checks.rows:
            parts.append(_row_counts(checks))
        parts.extend(_set_counts(checks))
    results = reduce(DataFrame.unionByName, parts)
    return results.withColumn(
        "estado", F.when(F.col("fallas") == 0, "pass").otherwise(F.col("severidad"))
    )


def violations_of(checks: TableChecks, name: str) -> DataFrame:
    """The violating rows of one check of a table."""
    for rule in checks.rows:
        if rule.name == name:
            failing = checks.data.where(rule.violated)
            return failing.select(*rule.shown) if rule.shown else failing
    return next(s.violations for s in checks.sets if s.name == name)


def store_and_enforce(
    spark: SparkSession, all_checks: list[TableChecks], audit_root: str, run_at: dt.datetime | None = None
) -> DataFrame:
    """Run all checks, write results and violating rows, raise on a failed error check.

    Violations are written before raising, so that they can be inspected.
    """
    results = run_checks(all_checks)
    if run_at is not None:
        results = results.withColumn("ejecutado_en", F.lit(run_at))
    results.write.mode("overwrite").parquet(f"{audit_root}/resultados")
    results = spark.read.parquet(f"{audit_root}/resultados")
    failed = results.where("fallas > 0").collect()  # at most one row per declared check
    by_table = {c.table: c for c in all_checks}
    for row in failed:
        rows = violations_of(by_table[row.tabla], row.prueba)
        rows.write.mode("overwrite").parquet(f"{audit_root}/{row.tabla}/{row.prueba}")
    errors = [f"{r.tabla}.{r.prueba}: {r.fallas}" for r in failed if r.severidad == ERROR]
    if errors:
        raise QualityGateError("failed checks: " + "; ".join(sorted(errors)))
    return results
