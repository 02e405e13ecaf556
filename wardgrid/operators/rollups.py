"""Counts per place and day, with conditional sums and distinct reporters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def sum_when(condition: Column, value: str) -> Column:
    return F.sum(F.when(condition, F.col(value)).otherwise(F.lit(0)))


def counts_by_place_day(
    visits: DataFrame,
    aliases: DataFrame,
    *,
    day: str,
    text: str,
    reporter: str,
    total: tuple[str, str],
    conditional: dict[str, Column],
    alias: str = "alias_normalizado",
    place: str = "ubigeo",
    reporters: str = "clinicas_reportantes",
) -> DataFrame:
    """Sum a count, its conditional parts and its distinct reporters per (day, place).

    The sums are taken per (day, text, reporter) before the dictionary is joined,
    and the distinct count is a second grouping by reporter. Every shuffle
    therefore carries pre-aggregated rows, also when one place has most of them.
    """
    source, total_name = total
    sums = {total_name: F.sum(source), **{n: sum_when(c, source) for n, c in conditional.items()}}
    per_text = visits.groupBy(day, text, reporter).agg(*(e.alias(n) for n, e in sums.items()))
    mapped = per_text.join(aliases, per_text[text] == aliases[alias], "inner")
    per_reporter = mapped.groupBy(day, place, reporter).agg(*(F.sum(n).alias(n) for n in sums))
    return per_reporter.groupBy(day, place).agg(
        *(F.sum(n).alias(n) for n in sums), F.count(reporter).alias(reporters)
    )
