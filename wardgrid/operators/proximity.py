"""Radius join and nearest match.

A distance has no equality to join on, so both sides are put on a latitude-aware
grid: points get one cell, places get the few cells their circle touches, and an
equi-join on the cell proposes pairs that the exact distance then filters. Work
grows with the points near a place, never with places x points.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.geo import cell_of, cells_within, haversine_km


def radius_pairs(
    points: DataFrame,
    places: DataFrame,
    radius_km: float,
    *,
    point_position: tuple[str, str],
    place_position: tuple[str, str],
    distance: str = "distancia_km",
) -> DataFrame:
    """Pairs within the radius, with all columns of both sides and the distance.

    Column names of the two sides must differ.
    """
    band, cell = cell_of(*point_position, radius_km)
    located = points.where(F.col(point_position[0]).isNotNull() & F.col(point_position[1]).isNotNull())
    located = located.withColumns({"_band": band, "_cell": cell})
    near = F.explode(cells_within(*place_position, radius_km))
    spread = (
        places.where(F.col(place_position[0]).isNotNull() & F.col(place_position[1]).isNotNull())
        .withColumn("_near", near)
        .withColumns({"_band": F.col("_near.band"), "_cell": F.col("_near.cell")})
        .drop("_near")
    )
    return (
        located.join(spread, ["_band", "_cell"])
        .drop("_band", "_cell")
        .withColumn(distance, haversine_km(*place_position, *point_position))
        .where(F.col(distance) <= F.lit(float(radius_km)))
    )


def nearest_per_key(
    pairs: DataFrame, keys: list[str], order: list[str], carried: list[str]
) -> DataFrame:
    """The pair with the smallest ``order`` columns per key.

    A minimum over one struct is pre-aggregated in every map task, so the shuffle
    carries one candidate per key and task.
    """
    best = F.min(F.struct(*order, *(c for c in carried if c not in order))).alias("_best")
    picked = pairs.groupBy(*keys).agg(best)
    return picked.select(*keys, *(F.col(f"_best.{c}").alias(c) for c in carried))
