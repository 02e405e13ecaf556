"""Positions in a total order over all rows, without one task that sees them all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import write_through


def with_position(rows: DataFrame, order: list[Column], name: str = "position") -> DataFrame:
    """``rows`` with ``name``: 1 for the first row in ``order``, 2 for the next.

    Rows are dealt by range, counted per range, and numbered inside their range from the
    count of all ranges before it. The dealt rows are written once, so that counts and
    numbers agree whichever executor is lost. Rows equal in ``order`` share a range and
    are numbered in no particular order; end ``order`` with a unique column.
    """
    dealt = write_through(
        rows.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "dealt-by-range"
    )
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    offsets = dealt.groupBy("_range").agg(F.count("*").alias("_n")).select(
        "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return (
        dealt.withColumn("_inside", inside)
        .join(offsets, "_range")
        .withColumn(name, F.col("_inside") + F.col("_before"))
        .drop("_range", "_inside", "_before")
    )
