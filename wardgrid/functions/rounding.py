"""Rounding whose ties are decided exactly."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import col

_SPLITTER = float(2**27 + 1)  # Veltkamp splitting constant for doubles


def round_binary(value: Column | str, digits: int) -> Column:
    """Round the double's exact binary value, true ties to even.

    ``F.round`` rounds the shortest decimal spelling (2.675 -> 2.68); this one
    rounds the stored number (2.67499999... -> 2.67). The comparison with the
    midpoint is made exact by splitting the value in two halves whose products
    with the scale are exact.
    """
    value = col(value).cast("double")
    scale = float(10**digits)
    below = F.floor(value * scale).cast("double")
    carried = value * _SPLITTER
    high = carried - (carried - value)
    low = value - high
    side = (high * (2 * scale) - (below * 2 + 1)) + low * (2 * scale)
    nearest = F.when(side < 0, below).when(side > 0, below + 1).otherwise(F.rint((below + 0.5)))
    rounded = F.when((value < 0) & (nearest == 0), F.lit(-0.0)).otherwise(nearest / scale)
    return F.when(F.abs(value) >= 2.0**43, value).otherwise(rounded)


def ratio_half_up(numerator: Column, denominator: Column, digits: int) -> Column:
    """Exact integer ratio rounded half away from zero; denominator must be > 0."""
    doubled = F.abs(numerator) * F.lit(2 * 10**digits) + denominator
    steps = F.call_function("div", doubled, denominator * 2)
    size = steps / F.lit(float(10**digits))
    return F.when((numerator < 0) & (size > 0), -size).otherwise(size)
