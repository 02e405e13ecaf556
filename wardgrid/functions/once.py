"""Filtering on computed columns without computing them twice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

_PIN = "_pin"


def filter_computed(df: DataFrame, condition: Column) -> DataFrame:
    """Filter on columns that were just computed.

    Spark pushes a filter below a projection by copying the projected
    expressions into it, where common parts are not shared; a chain of parsing
    steps then runs many times per row. It does not push a filter below a
    projection with a row id, so one that the filter refers to keeps it in place.
    """
    pinned = df.withColumn(_PIN, F.monotonically_increasing_id())
    return pinned.where((F.col(_PIN) >= 0) & condition).drop(_PIN)
