"""Calendar arithmetic on dates and instants."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ISO weekday numbers are the positions in this list, from 1.
WEEKDAYS = (
    "Monday",
    "Tuesday",
    "Wednesday",
    "Thursday",
    "Friday",
    "Saturday",
    "Sunday",
)


def weekday_number(name: str) -> int:
    """ISO number (Monday = 1) of an English weekday name."""
    if name not in WEEKDAYS:
        raise ValueError(f"{name!r} is not a weekday; use one of {', '.join(WEEKDAYS)}")
    return WEEKDAYS.index(name) + 1


def shifted_weekday(number: int, lag: int) -> int:
    """ISO weekday ``lag`` days before weekday ``number``."""
    return (number - 1 - lag) % 7 + 1


def iso_weekday(date: Column) -> Column:
    return F.weekday(date) + 1


def latest_monday(as_of: Column) -> Column:
    """The Monday of the week ``as_of`` falls in."""
    return F.date_sub(as_of, F.weekday(as_of))


def utc_instant(text: Column) -> Column:
    """Parse a date or timestamp text; without an explicit zone it is read as UTC.

    A date alone is its midnight.  Text that is no instant gives NULL.
    """
    alone = text.rlike(r"^\s*\d{4}-\d{1,2}-\d{1,2}\s*$")
    zoned = text.rlike(r"(Z|[+-]\d\d:?\d\d)$")
    whole = (
        F.when(alone, F.concat(F.trim(text), F.lit("T00:00:00Z")))
        .when(zoned, text)
        .otherwise(F.concat(text, F.lit("Z")))
    )
    return F.try_to_timestamp(whole)


def local_time(instant: Column, zone: str = "America/Chicago") -> Column:
    """Wall-clock reading of an instant in ``zone`` (a timestamp without zone)."""
    return F.convert_timezone(
        F.current_timezone(), F.lit(zone), instant.cast("timestamp_ntz")
    )
