"""Totals of two tables compared per day."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def reconcile_totals(
    left: DataFrame,
    left_day: str,
    left_value: str,
    right: DataFrame,
    right_day: str,
    right_value: str,
    names: tuple[str, str, str] = ("fecha", "total_staging", "total_mart"),
) -> DataFrame:
    """Days whose totals differ, a missing day counting as 0."""
    day, left_name, right_name = names
    a = left.groupBy(F.col(left_day).alias(day)).agg(F.sum(left_value).alias(left_name))
    b = right.groupBy(F.col(right_day).alias(day)).agg(F.sum(right_value).alias(right_name))
    return a.join(b, day, "full").fillna(0, [left_name, right_name]).where(F.col(left_name) != F.col(right_name))
