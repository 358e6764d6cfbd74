"""Training features and the "best time to buy" label."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.operators.skew import lookup_join
from skyledger.sources.scratch import materialize

# A fare within 5 % of the lowest one seen for its leg is a good time to buy.
BEST_BUY_MARGIN = 1.05


def fare_features(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Fact rows with a known flight date and the calendar features of that date."""
    calendar = dim_date.select(
        F.col("date_fk").alias("flight_date_fk"),
        F.col("day_of_week").alias("flight_day_of_week"),
        F.col("month").alias("flight_month"),
        F.col("week_of_year").alias("flight_week_of_year"),
    )
    return lookup_join(fact, calendar, ["flight_date_fk"], "inner").select(
        "leg_id",
        "total_fare",
        "search_to_flight_days",
        "departure_airport_fk",
        "arrival_airport_fk",
        "airline_fk",
        "aircraft_fk",
        "flight_day_of_week",
        "flight_month",
        "flight_week_of_year",
    )


def best_time_label(features: DataFrame, leg: str = "leg_id") -> DataFrame:
    """Add ``is_best_time_to_buy``: 1 if the fare is near the lowest of its leg.

    The lowest fare is aggregated per leg first and joined back, instead of a
    window that would put all rows of a leg into one task. The lowest fares are
    stored: they are broadcast if few, and else the adaptive planner splits the
    rows of a hot leg, or those without one, over tasks. Pass a stored table, as it
    is read twice. A row without a fare gets 0.
    """
    lowest = materialize(
        features.groupBy(F.col(leg).alias("_leg")).agg(F.min("total_fare").alias("_lowest")),
        "lowest-fares",
    )
    near = F.col("total_fare") <= F.col("_lowest") * BEST_BUY_MARGIN
    return (
        features.join(lowest, F.col(leg).eqNullSafe(F.col("_leg")))
        .withColumn("is_best_time_to_buy", F.when(near, 1).otherwise(0))
        .drop("_leg", "_lowest")
    )


def route_price_rule(fares: DataFrame) -> DataFrame:
    """Best-buy threshold per route: the lowest fare plus the same margin."""
    return fares.groupBy("departure_airport_fk", "arrival_airport_fk").agg(
        (F.min("total_fare") * BEST_BUY_MARGIN).alias("best_buy_threshold")
    )
