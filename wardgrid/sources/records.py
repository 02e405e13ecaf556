"""Plain record files: JSON lines and standard CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def write_json_lines(df: DataFrame, folder: str, mode: str = "errorifexists") -> None:
    """One object per line; nulls are written so that every line has all keys."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(folder)


def read_json_lines(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(folder)


# every record file is UTF-8, comma separated, with a header and doubled quotes
_CSV = {"header": "true", "quote": '"', "escape": '"', "encoding": "UTF-8"}


# Files are bounded in rows because a field may hold a line end, and such files can
# only be read whole.
CSV_WRITE = {
    **_CSV,
    "emptyValue": "",
    "nullValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "maxRecordsPerFile": "1000000",
}


def write_csv(df: DataFrame, folder: str, columns: tuple[str, ...], mode: str = "errorifexists") -> None:
    """Columns that are not listed are left out, null becomes empty."""
    df.select(*columns).write.mode(mode).options(**CSV_WRITE).csv(folder)


def read_csv(
    spark: SparkSession, folder: str, columns: tuple[str, ...], day_folder: str | None = None
) -> DataFrame:
    """All columns as text; an empty field is an empty text, as written.

    ``day_folder`` names a date partition column of the folder. The path of the
    file each row came from is in ``_archivo``.
    """
    fields = [T.StructField(c, T.StringType()) for c in columns]
    if day_folder:
        fields.append(T.StructField(day_folder, T.DateType()))
    return (
        spark.read.schema(T.StructType(fields))
        .options(**_CSV, multiLine="true")
        .csv(folder)
        .select("*", F.col("_metadata.file_path").alias("_archivo"))
        .fillna("", list(columns))
    )
