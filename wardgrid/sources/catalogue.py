"""Place catalogue and alias dictionary: fixed small tables.

They are handed over as Arrow tables, which Spark keeps as local relations of
known size, so joins with them are broadcast by Spark's own size check.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .. import schemas
from ..fixed_values import DISTRICT_ALIASES, DISTRICTS


def small_table(spark: SparkSession, rows: tuple[tuple, ...], schema: T.StructType) -> DataFrame:
    columns = {f.name: [r[i] for r in rows] for i, f in enumerate(schema.fields)}
    return spark.createDataFrame(pa.table(columns, schema=to_arrow_schema(schema)), schema)


def districts(spark: SparkSession) -> DataFrame:
    return small_table(spark, DISTRICTS, schemas.DISTRICTS)


def district_aliases(spark: SparkSession) -> DataFrame:
    return small_table(spark, DISTRICT_ALIASES, schemas.ALIASES)
