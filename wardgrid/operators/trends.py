"""Comparison with the preceding rows, air category and alert.

Counts are integers, so the preceding rows are kept as (sum, rows) and every
comparison is made on integers: a rise of exactly the limit is an alert.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..fixed_values import NO_COVERAGE, OVER_GUIDE, OVER_STANDARD, WITHIN_GUIDE
from ..functions.rounding import ratio_half_up
from ..params import Parameters

SUM, ROWS = "_suma_previa", "_filas_previas"


def with_trailing(
    df: DataFrame, key: str, order: str, value: str, rows: int, by_days: bool = False
) -> DataFrame:
    """Add sum and row count of the ``rows`` rows before each one, itself excluded.

    Counts rows, as dates absent from the calendar have none; ``by_days`` counts
    calendar days instead. On the dense grid all keys have equally many rows.
    """
    if by_days:
        frame = Window.partitionBy(key).orderBy(F.unix_date(order)).rangeBetween(-rows, -1)
    else:
        frame = Window.partitionBy(key).orderBy(order).rowsBetween(-rows, -1)
    return df.withColumns({SUM: F.sum(value).over(frame), ROWS: F.count(value).over(frame)})


def trailing_average(digits: int = 1) -> Column:
    """Average of the preceding rows; null without any."""
    return F.when(F.col(ROWS) > 0, ratio_half_up(F.col(SUM), F.col(ROWS), digits))


def percent_change(value: str, digits: int = 1) -> Column:
    """Change against the unrounded average in percent; null unless that is positive."""
    rise = (F.col(value) * F.col(ROWS) - F.col(SUM)) * 100
    return F.when(F.col(SUM) > 0, ratio_half_up(rise, F.col(SUM), digits))


def air_category(reading: Column | str, params: Parameters) -> Column:
    reading = F.col(reading) if isinstance(reading, str) else reading
    return (
        F.when(reading.isNull(), NO_COVERAGE)
        .when(reading <= F.lit(params.guide_limit), WITHIN_GUIDE)
        .when(reading <= F.lit(params.standard_limit), OVER_GUIDE)
        .otherwise(OVER_STANDARD)
    )


def over_guide(category: Column | str) -> Column:
    category = F.col(category) if isinstance(category, str) else category
    return category.isin(OVER_GUIDE, OVER_STANDARD)


def alert_flag(value: str, category: Column | str, params: Parameters) -> Column:
    """Air over the guide and the count at least ``rise_pct`` above the average."""
    risen = F.col(value) * F.col(ROWS) * 100 >= F.col(SUM) * F.lit(100 + params.rise_pct)
    return F.coalesce(over_guide(category) & (F.col(SUM) > 0) & risen, F.lit(False))
