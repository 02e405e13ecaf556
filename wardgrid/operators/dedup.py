"""Latest-wins removal of resubmitted rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

_RANK = "_rank"


def keep_latest(df: DataFrame, keys: list[str], latest_first: list[Column]) -> DataFrame:
    """One row per key: the first in the given order.

    A rank filter of 1 lets Spark keep the best row of each key inside every map
    task (WindowGroupLimit, Partial) before the shuffle, so a key holding a
    large share of all rows sends one row per task.
    """
    window = Window.partitionBy(*keys).orderBy(*latest_first)
    return df.withColumn(_RANK, F.row_number().over(window)).where(F.col(_RANK) == 1).drop(_RANK)
