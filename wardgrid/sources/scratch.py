"""Intermediate tables in the shared folder.

A written table cuts lineage, survives the loss of executors and gives later
plans a known size, so Spark itself decides by that size whether to broadcast.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from ..session import shared_folder


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/wardgrid/{name}-{uuid.uuid4().hex}"


def write_through(df: DataFrame, name: str) -> DataFrame:
    """Write once, read back: the rest of the plan starts from the written table."""
    spark = df.sparkSession
    folder = new_folder(spark, name)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def write_all_through(tables: dict[str, DataFrame]) -> list[DataFrame]:
    """Write independent tables at the same time, so that one small job does not hold up the others."""
    spark = next(iter(tables.values())).sparkSession
    with ThreadPoolExecutor(len(tables)) as pool:
        started = [
            pool.submit(inheritable_thread_target(spark)(write_through), df, name) for name, df in tables.items()
        ]
        return [s.result() for s in started]
