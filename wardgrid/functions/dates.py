"""Date expressions."""

from __future__ import annotations

import datetime as dt
from zoneinfo import ZoneInfo

from pyspark.sql import Column, functions as F

from .text import ascii_digits, col, strip

# digits that are not fixed by the calendar may be of any script
_DAY = r"3[01]|[12]\p{Nd}|0[1-9]|[1-9]| [1-9]"
_MONTH = "1[0-2]|0[1-9]|[1-9]"
_YEAR = r"\p{Nd}{4}"
_DAY_FIRST_SHAPE = f"^({_DAY})([/-])({_MONTH})\\2({_YEAR})$"
_ISO_SHAPE = f"^({_YEAR}-(?:{_MONTH})-(?:{_DAY}))$"
_ASCII_ISO_SHAPE = f"^((?!0000)[0-9]{{4}}-(?:{_MONTH})-[0-9]{{1,2}})$"


def parse_day(value: Column | str) -> Column:
    """Date written as year-month-day, day/month/year or day-month-year, else null.

    Padded and unpadded parts are accepted, two-digit years and impossible days
    are not. One cast does the calendar check for all three shapes.
    """
    # a chain in which each step is used once, because Spark evaluates a step as
    # often as it is named; only an empty extract casts to null
    year_first = F.regexp_replace(strip(value), _DAY_FIRST_SHAPE, "$4-$3-$1")
    usual = F.regexp_extract(year_first, _ASCII_ISO_SHAPE, 1).try_cast("date")
    unusual = ascii_digits(F.replace(F.regexp_extract(year_first, _ISO_SHAPE, 1), F.lit("- "), F.lit("-")))
    odd = col(value).rlike(r"[^\x00-\x7F]|- ")
    return F.coalesce(usual, F.when(odd & ~unusual.startswith("0000"), unusual.try_cast("date")))


def business_day(instant: Column | str, zone: str, explicit: Column | str | None = None) -> Column:
    """Day a run processes: the explicit one, else the day before in local time."""
    wall_clock = F.convert_timezone(
        F.current_timezone(), F.lit(zone), col(instant).cast("timestamp").cast("timestamp_ntz")
    )
    previous = F.date_sub(wall_clock.cast("date"), 1)
    if explicit is None:
        return previous
    return F.coalesce(col(explicit).cast("date"), previous)


def resolve_run_day(
    explicit: str | None, reference: dt.datetime | None = None, zone: str = "America/Lima"
) -> dt.date:
    """Driver-side form of :func:`business_day` for the argument of a single run."""
    if explicit:
        try:
            return dt.date.fromisoformat(explicit.strip())
        except ValueError:
            raise ValueError(f"run day {explicit!r} is not written as YYYY-MM-DD") from None
    local = ZoneInfo(zone)
    moment = reference if reference is not None else dt.datetime.now(local)
    if moment.utcoffset() is None:
        raise ValueError("the reference time needs a time zone")
    return moment.astimezone(local).date() - dt.timedelta(days=1)
