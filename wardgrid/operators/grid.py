"""Complete day-by-place grid."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def calendar_of(*sources: tuple[DataFrame, str], name: str = "fecha") -> DataFrame:
    """Distinct days seen in any source; each source is made distinct before the union."""
    days = [df.select(F.col(c).alias(name)).distinct() for df, c in sources]
    united = days[0]
    for other in days[1:]:
        united = united.union(other)
    return united.distinct()


#: Places that one row carries.
CHUNK = 1024


def dense_grid(calendar: DataFrame, places: DataFrame, place_key: str) -> DataFrame:
    """Every day with every place.

    Places are gathered to arrays of about ``CHUNK``, and each day meets each array once, by an
    equi-join on its number; the product is unfolded where the days are. So days times
    arrays, and the places, are all that is moved: with up to ``CHUNK`` places, days and places.
    Days are dealt over all tasks first, so that the unfolding is spread. The arrays are few rows, which
    Spark broadcasts by their size.
    """
    chunks = max(1, -(-places.count() // CHUNK))
    held = F.struct(*(F.col(f"`{c}`") for c in places.columns))
    number = F.pmod(F.xxhash64(place_key), F.lit(chunks)).cast("int")
    arrays = places.groupBy(number.alias("_chunk")).agg(F.collect_list(held).alias("_places"))
    tasks = int(calendar.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    meeting = calendar.withColumn("_chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))).repartition(tasks)
    met = meeting.join(arrays, "_chunk").select(*calendar.columns, F.explode("_places").alias("_place"))
    return met.select(*calendar.columns, "_place.*")


def fill_grid(
    grid: DataFrame,
    keys: list[str],
    counts: DataFrame,
    count_columns: list[str],
    readings: DataFrame,
) -> DataFrame:
    """Left-join both measures onto the grid: a missing count is 0, a missing reading stays null."""
    return grid.join(counts, keys, "left").join(readings, keys, "left").fillna(0, count_columns)
