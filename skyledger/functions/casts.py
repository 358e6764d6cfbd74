"""Casts from the all-string raw table: a bad value is NULL, never an error.

The same result with ANSI mode on or off, so no job has to change the setting.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_int(c: Column) -> Column:
    """``'3' -> 3``, ``'650.7' -> 650`` (fraction cut off), ``'' -> NULL``."""
    return F.coalesce(c.try_cast("int"), c.try_cast("double").try_cast("int"))


def to_long(c: Column) -> Column:
    return F.coalesce(c.try_cast("bigint"), c.try_cast("double").try_cast("bigint"))


def to_float(c: Column) -> Column:
    return c.try_cast("float")


def to_double(c: Column) -> Column:
    return c.try_cast("double")


def to_bool(c: Column) -> Column:
    return c.try_cast("boolean")


def to_date(c: Column) -> Column:
    """``yyyy-MM-dd`` and nothing else, so a date and its dimension row agree.

    A plain cast is several times as fast as a parse with a format but takes other
    spellings too; a date that prints as it was written was in this one.
    """
    day = c.try_cast("date")
    return F.when(day.cast("string") == c, day)


def whole_minutes(seconds: Column) -> Column:
    """Seconds (text or number) to whole minutes, fraction cut off."""
    return (seconds.try_cast("double") / F.lit(60.0)).try_cast("int")
