"""Resolve free-text keys through a dictionary, and audit the ones it lacks.

No broadcast is forced: Spark compares the dictionary's size with its threshold,
broadcasts it below and sorts and merges (splitting skewed keys) above.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def resolve_alias(df: DataFrame, aliases: DataFrame, text: str, alias: str) -> DataFrame:
    """Inner join: rows whose text is not in the dictionary are left out."""
    return df.join(aliases, df[text] == aliases[alias], "inner").drop(aliases[alias])


def unmatched_values(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Non-null values of ``column`` absent from the parent, with their row count.

    Counted per value before the anti join, so the join sees each value once per
    map task however often it occurs.
    """
    counted = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("filas"))
    parents = parent.select(F.col(parent_column).alias("_parent")).distinct()
    return counted.join(parents, counted[column] == parents["_parent"], "left_anti")
