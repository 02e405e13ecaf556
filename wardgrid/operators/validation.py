"""Row validation: every broken rule adds a reason, and a row is valid without any."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..errors import QualityGateError
from ..fixed_values import (
    AGE_GROUPS,
    COUNT_SHAPE,
    DIAGNOSIS_SHAPE,
    MISSING_VALUE,
    REASON_BAD_COUNT,
    REASON_BAD_DATE,
    REASON_BAD_DIAGNOSIS,
    REASON_EMPTY,
    REASON_NOT_IN_DOMAIN,
    REASON_OTHER_DAY,
    REASON_SEPARATOR,
    VISIT_COLUMNS,
)
from ..functions.dates import parse_day
from ..functions.once import filter_computed
from ..functions.text import ascii_digits, drop_whitespace, filled_text, strip

REASONS = "_motivos"
_CLEAN = "_limpio"


@dataclass(frozen=True)
class FieldRule:
    """How one column is cleaned, and what is wrong with it.

    ``reasons`` is given the cleaned column, which is computed once per row, and
    returns texts that are null when the rule is satisfied.
    """

    column: str
    clean: Column
    reasons: Callable[[Column], list[Column]]


def _given(column: str) -> Column:
    """The raw value, a missing one read as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def parse_count(value: Column | str) -> Column:
    """Whole non-negative count, '12' or '12.0'; null otherwise."""
    text = strip(value)
    number = ascii_digits(text).try_cast("double").try_cast("bigint")
    # up to 15 plain digits need no detour over a double
    return F.when(text.rlike("^[0-9]{1,15}$"), text.try_cast("bigint")).when(text.rlike(COUNT_SHAPE), number)


def day_rule(column: str, expected: Column) -> FieldRule:
    def reasons(day: Column) -> list[Column]:
        return [
            F.when(day.isNull(), filled_text(REASON_BAD_DATE, strip(_given(column)))),
            F.when(day.isNotNull() & ~day.eqNullSafe(expected), filled_text(REASON_OTHER_DAY, day.cast("string"))),
        ]

    return FieldRule(column, parse_day(_given(column)), reasons)


def filled_rule(column: str) -> FieldRule:
    reason = F.lit(REASON_EMPTY.format(column))
    return FieldRule(column, strip(_given(column)), lambda text: [F.when(text == "", reason)])


def domain_rule(column: str, domain: tuple[str, ...]) -> FieldRule:
    reason = filled_text(REASON_NOT_IN_DOMAIN, F.coalesce(F.col(column), F.lit(MISSING_VALUE)))
    return FieldRule(
        column, drop_whitespace(_given(column)), lambda text: [F.when(~text.isin(*domain), reason)]
    )


def diagnosis_rule(column: str) -> FieldRule:
    return FieldRule(
        column,
        F.upper(strip(_given(column))),
        lambda code: [F.when(~code.rlike(DIAGNOSIS_SHAPE), filled_text(REASON_BAD_DIAGNOSIS, code))],
    )


def count_rule(column: str) -> FieldRule:
    reason = filled_text(REASON_BAD_COUNT, strip(_given(column)))
    return FieldRule(column, parse_count(_given(column)), lambda count: [F.when(count.isNull(), reason)])


def visit_rules(expected_day: Column) -> list[FieldRule]:
    """The rules of the visits file, in the order their reasons are reported."""
    date, clinic, place, age, diagnosis, count = VISIT_COLUMNS
    return [
        day_rule(date, expected_day),
        filled_rule(clinic),
        filled_rule(place),
        domain_rule(age, AGE_GROUPS),
        diagnosis_rule(diagnosis),
        count_rule(count),
    ]


def check_rows(df: DataFrame, rules: list[FieldRule]) -> DataFrame:
    """Keep the raw columns and add ``_motivos`` (array) and ``_limpio`` (struct)."""
    cleaned = df.withColumn(_CLEAN, F.struct(*(rule.clean.alias(rule.column) for rule in rules)))
    found = [r for rule in rules for r in rule.reasons(F.col(f"{_CLEAN}.{rule.column}"))]
    return cleaned.withColumn(REASONS, F.array_compact(F.array(*found)))


def valid_rows(checked: DataFrame, columns: tuple[str, ...] = VISIT_COLUMNS) -> DataFrame:
    """Rows without reasons, with cleaned values in place of the raw ones."""
    kept = filter_computed(checked, F.size(REASONS) == 0)
    return kept.withColumns({c: F.col(f"{_CLEAN}.{c}") for c in columns}).drop(REASONS, _CLEAN)


def quarantined_rows(checked: DataFrame, columns: tuple[str, ...] = VISIT_COLUMNS) -> DataFrame:
    """Rejected rows with their raw values and the joined reasons."""
    rejected = filter_computed(checked, F.size(REASONS) > 0)
    raw = {c: F.coalesce(F.col(c), F.lit("")) for c in columns}
    return (
        rejected.withColumns(raw).withColumn("motivo_rechazo", F.array_join(REASONS, REASON_SEPARATOR)).drop(REASONS, _CLEAN)
    )


def rejection_summary(checked: DataFrame, *keys: str) -> DataFrame:
    """Valid and rejected counts, and the rejection rate, per key (or overall)."""
    rejected = F.sum(F.when(F.size(REASONS) > 0, 1).otherwise(0))
    return (
        checked.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("total"), F.coalesce(rejected, F.lit(0)).alias("rechazadas"))
        .withColumn("validas", F.col("total") - F.col("rechazadas"))
        .withColumn("tasa_rechazo", F.when(F.col("total") > 0, F.col("rechazadas") / F.col("total")).otherwise(0.0))
    )


def over_limit(summary: DataFrame, max_rate: float) -> DataFrame:
    """Summaries that must stop a load: no rows at all, or a rate strictly above the limit."""
    return summary.where((F.col("total") == 0) | (F.col("tasa_rechazo") > F.lit(float(max_rate))))


def enforce_rejection_rate(summary: DataFrame, max_rate: float) -> None:
    """Raise when any summary row is over the limit; the message shows one and says how many there are."""
    failing = over_limit(summary, max_rate)
    for row in failing.limit(1).collect():
        many = failing.count()
        more = f" (and {many - 1} more)" if many > 1 else ""
        if row.total == 0:
            raise QualityGateError(f"no data rows{more}")
        raise QualityGateError(
            f"{row.tasa_rechazo:.1%} of the rows were rejected ({row.rechazadas}/{row.total}), over the "
            f"limit of {max_rate:.0%}; see the 'cuarentena' layer{more}"
        )
