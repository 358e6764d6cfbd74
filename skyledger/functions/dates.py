"""Calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_parts(c: Column) -> list[Column]:
    """Calendar columns of a date; Sunday is day 1, weeks are ISO weeks."""
    return [
        F.year(c).alias("year"),
        F.month(c).alias("month"),
        F.dayofmonth(c).alias("day"),
        F.quarter(c).alias("quarter"),
        F.dayofweek(c).alias("day_of_week"),
        F.dayofyear(c).alias("day_of_year"),
        F.weekofyear(c).alias("week_of_year"),
    ]


def lead_days(flight_date: Column, search_date: Column) -> Column:
    return F.datediff(flight_date, search_date)
