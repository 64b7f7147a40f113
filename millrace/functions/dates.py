"""Calendar and epoch helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def age_years(born: Column, on: Column) -> Column:
    """Completed calendar years between two dates.

    Someone born on 29 February turns a year older on 1 March of a common year;
    ``months_between`` would count them a day early.
    """
    def month_day(day: Column) -> Column:
        return F.month(day) * 100 + F.dayofmonth(day)

    not_yet = (month_day(on) < month_day(born)).cast("int")
    return F.year(on) - F.year(born) - not_yet


def from_millis(millis: Column) -> Column:
    return F.timestamp_millis(millis)


def full_name(*parts: str) -> Column:
    return F.concat_ws(" ", *parts)
