"""Great-circle distance and a latitude-aware grid for radius joins."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

from .text import col

EARTH_RADIUS_KM = 6371.0
_SLACK = 1 + 1e-9  # keeps points exactly on a cell or radius border inside


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    lat1, lon1, lat2, lon2 = (F.radians(col(c)) for c in (lat1, lon1, lat2, lon2))
    half_chord = F.pow(F.sin((lat2 - lat1) / 2), F.lit(2)) + F.cos(lat1) * F.cos(lat2) * F.pow(
        F.sin((lon2 - lon1) / 2), F.lit(2)
    )
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.least(F.lit(1.0), half_chord)))


def _step_degrees(radius_km: float) -> float:
    return math.degrees(radius_km / EARTH_RADIUS_KM) * _SLACK


def _band(latitude: Column, step: float) -> Column:
    return F.floor((latitude + 90) / F.lit(step))


def _cells_in_band(band: Column, step: float) -> Column:
    """Cells around the globe in one band: about ``step`` wide at its poleward edge."""
    south = band * F.lit(step) - 90
    poleward = F.least(F.lit(90.0), F.greatest(F.abs(south), F.abs(south + F.lit(step))))
    return F.greatest(F.lit(1), F.floor(F.cos(F.radians(poleward)) * F.lit(360.0 / step)))


def _cell(longitude: Column, cells: Column) -> Column:
    return F.floor((longitude + 180) / 360 * cells)


def cell_of(latitude, longitude, radius_km: float) -> tuple[Column, Column]:
    """Grid cell of a point: (band, cell within the band)."""
    step = _step_degrees(radius_km)
    band = _band(col(latitude), step)
    cells = _cells_in_band(band, step)
    return band, F.pmod(_cell(col(longitude), cells), cells)


def cells_within(latitude, longitude, radius_km: float) -> Column:
    """Array of (band, cell) structs that can hold a point within the radius.

    Three bands; in each, the cells under the widest longitude span of the
    circle. A circle over a pole takes whole bands, and cell numbers wrap at the
    antimeridian, so neither needs special data.
    """
    step = _step_degrees(radius_km)
    latitude, longitude = col(latitude), col(longitude)
    spread = F.sin(F.radians(F.lit(step))) / F.cos(F.radians(latitude))
    over_pole = (F.abs(latitude) + F.lit(step)) >= 90
    span = F.when(over_pole | (spread >= 1), F.lit(180.0)).otherwise(
        F.degrees(F.asin(F.least(F.lit(1.0), spread))) * F.lit(_SLACK)
    )

    def cells_of_band(offset: Column) -> Column:
        band = _band(latitude, step) + offset
        cells = _cells_in_band(band, step)
        west = _cell(longitude - span, cells)
        east = F.least(_cell(longitude + span, cells), west + cells - 1)
        return F.transform(
            F.sequence(west, east),
            lambda c: F.struct(band.alias("band"), F.pmod(c, cells).alias("cell")),
        )

    return F.flatten(F.transform(F.array(*(F.lit(i) for i in (-1, 0, 1))), cells_of_band))
