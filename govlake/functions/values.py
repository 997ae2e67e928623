"""Small value rules shared by the layers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(12,2)"


def tidy_lower(value: Column) -> Column:
    return F.lower(F.trim(value))


def tidy_upper(value: Column) -> Column:
    return F.upper(F.trim(value))


def present(value: Column) -> Column:
    """TRUE or FALSE, never NULL: the exact complement of "missing or blank"."""
    return F.coalesce(F.trim(value) != "", F.lit(False))


def money(value: Column) -> Column:
    return value.try_cast(MONEY)


def day(value: Column) -> Column:
    return value.try_cast("date")


def birth_year(value: Column) -> Column:
    """Date text to year: the day and month are never written downstream."""
    return F.year(day(value))


def decade(year: Column) -> Column:
    return (F.floor(year / 10) * 10).cast("int")


def decade_band(year: Column) -> Column:
    return F.concat(decade(year).cast("string"), F.lit("s"))


def as_date(value: dt.date | str) -> Column:
    return F.lit(str(value)).cast("date")


def as_time(value: dt.datetime | str | None) -> Column:
    """A pinned timestamp, or the query's own start time when none is given."""
    return F.current_timestamp() if value is None else F.lit(str(value)).cast("timestamp")

