"""Future price scenarios and buy recommendations."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions import lead_days
from skyledger.operators.keys import assert_unique
from skyledger.operators.skew import lookup_join

ROUTE = ("departure_airport_fk", "arrival_airport_fk")
FIRST_DAY, LAST_DAY, STEP_DAYS = 1, 180, 5


def as_date(day: str | dt.date | Column) -> Column:
    return day if isinstance(day, Column) else F.to_date(F.lit(str(day)))


def future_dates(as_of: str | dt.date | Column) -> Column:
    """Array of the dates to predict: every fifth day of the next 180."""
    return F.sequence(
        F.date_add(as_date(as_of), FIRST_DAY),
        F.date_add(as_date(as_of), LAST_DAY),
        F.make_dt_interval(days=F.lit(STEP_DAYS)),
    )


def scenario_grid(
    routes: DataFrame, as_of: str | dt.date, carry: Sequence[str] = ()
) -> DataFrame:
    """Each route on each future date, with the features of the fare model.

    The dates are an array on the route row, so nothing is joined. Airline and
    aircraft are left open (NULL), which the model treats like an unseen value.
    ``carry`` keeps more columns of ``routes``, such as a threshold.
    """
    date = F.col("date")
    return routes.select(
        *ROUTE, *carry, F.explode(future_dates(as_of)).alias("date")
    ).select(
        *ROUTE,
        *carry,
        "date",
        lead_days(date, as_date(as_of)).alias("search_to_flight_days"),
        F.dayofweek(date).alias("flight_day_of_week"),
        F.month(date).alias("flight_month"),
        F.weekofyear(date).alias("flight_week_of_year"),
        F.lit(None).cast("int").alias("airline_fk"),
        F.lit(None).cast("int").alias("aircraft_fk"),
    )


def recommend(
    predictions: DataFrame, rules: DataFrame | None = None, carry: Sequence[str] = ()
) -> DataFrame:
    """Rounded price and whether it is at most the threshold of its route.

    ``carry`` keeps more columns of ``predictions`` (or the threshold).

    Without ``rules`` the threshold is a column of ``predictions`` already. A route
    without a threshold gets 0. Two rules for one route are an error.
    """
    if rules is not None:
        rules = assert_unique(
            rules.select(*ROUTE, "best_buy_threshold"), ROUTE, "the price rules"
        )
        predictions = lookup_join(predictions, rules, ROUTE)
    buy = F.col("prediction") <= F.col("best_buy_threshold")
    return predictions.select(
        F.col("date").alias("flight_date"),
        *ROUTE,
        F.round("prediction", 2).alias("predicted_fare"),
        F.when(buy, 1).otherwise(0).alias("recommendation"),
        *carry,
    )
