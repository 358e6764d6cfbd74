"""The ticket fact: segments with the keys of all dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions import (
    lead_days,
    lookup_key,
    to_bool,
    to_date,
    to_float,
    to_int,
    whole_minutes,
)
from skyledger.operators.dimensions import FLIGHT_DETAILS, Dimensions
from skyledger.operators.keys import UNKNOWN
from skyledger.operators.segments import explode_segments
from skyledger.operators.skew import lookup_join, which_fit_broadcast

FACT_KEYS = (
    "search_date_fk",
    "flight_date_fk",
    "airline_fk",
    "departure_airport_fk",
    "arrival_airport_fk",
    "aircraft_fk",
    "flight_details_fk",
)
FACT_PARTITIONS = ("year", "month", "day")


def fact_segments(raw: DataFrame, on_null: str = "drop") -> DataFrame:
    """Segments with typed measures and normalised codes, before any lookup."""
    packed = {
        "departure_airport": "segments_departure_airport",
        "arrival_airport": "segments_arrival_airport",
        "airline_code": "segments_airline_code",
        "distance": "segments_distance",
        "duration": "segments_duration_in_seconds",
        "equipment_description": "segments_equipment_description",
    }
    itinerary = raw.select(
        "leg_id",
        to_date(F.col("search_date")).alias("search_date"),
        to_date(F.col("flight_date")).alias("flight_date"),
        to_float(F.col("base_fare")).alias("base_fare"),
        to_float(F.col("total_fare")).alias("total_fare"),
        to_int(F.col("seats_remaining")).alias("seats_remaining"),
        "fare_basis_code",
        "segments_cabin_code",
        to_bool(F.col("is_basic_economy")).alias("is_basic_economy"),
        to_bool(F.col("is_refundable")).alias("is_refundable"),
        *packed.values(),
    )
    carry = [c for c in itinerary.columns if c not in packed.values()]
    rows = explode_segments(itinerary, packed, carry, on_null, with_index=False)
    codes = ("departure_airport", "arrival_airport", "airline_code", "equipment_description")
    return rows.withColumns({c: lookup_key(F.col(c)) for c in codes})


def _keys(dim: DataFrame, code: Column, key: str) -> DataFrame:
    return dim.select(code.alias("_code"), F.col(key).alias("_key"))


def star_fact(raw: DataFrame, dims: Dimensions, on_null: str = "drop") -> DataFrame:
    """``fact_flight_ticket``, one row per segment.

    Fares are those of the itinerary and repeat on each of its segments; see
    ``itinerary_fares`` for sums. Dimensions that fit are broadcast, so the
    segments are not shuffled.
    """
    date = _keys(dims.date, F.col("full_date"), "date_fk")
    airline = _keys(dims.airline, lookup_key(F.col("airline_code")), "airline_fk")
    airport = _keys(dims.airport, lookup_key(F.col("iata_code")), "airport_fk")
    aircraft = _keys(
        dims.aircraft, lookup_key(F.col("equipment_description")), "aircraft_fk"
    )
    details = dims.flight_details.select(*FLIGHT_DETAILS, "flight_details_fk")
    sides = [date, airline, airport, aircraft, details]
    fits = dict(zip(map(id, sides), which_fit_broadcast(sides)))
    lookups = {
        "search_date": (date, "search_date_fk"),
        "flight_date": (date, "flight_date_fk"),
        "airline_code": (airline, "airline_fk"),
        "departure_airport": (airport, "departure_airport_fk"),
        "arrival_airport": (airport, "arrival_airport_fk"),
        "equipment_description": (aircraft, "aircraft_fk"),
    }
    rows = fact_segments(raw, on_null)
    for code, (side, key) in lookups.items():
        named = side.withColumnsRenamed({"_code": code, "_key": key})
        rows = lookup_join(rows, named, [code], small=fits[id(side)])
    rows = lookup_join(rows, details, FLIGHT_DETAILS, small=fits[id(details)])
    return rows.select(
        *[F.coalesce(F.col(k), F.lit(UNKNOWN)).alias(k) for k in FACT_KEYS],
        "leg_id",
        "base_fare",
        "total_fare",
        "seats_remaining",
        to_int(F.col("distance")).alias("total_travel_distance"),
        whole_minutes(F.col("duration")).alias("total_duration_in_minutes"),
        lead_days(F.col("flight_date"), F.col("search_date")).alias(
            "search_to_flight_days"
        ),
        F.year("flight_date").alias("year"),
        F.month("flight_date").alias("month"),
        F.dayofmonth("flight_date").alias("day"),
    )


def itinerary_fares(fact: DataFrame) -> DataFrame:
    """One row per itinerary and search, for sums and averages of fares."""
    return fact.groupBy("leg_id", "search_date_fk", "flight_date_fk").agg(
        F.min("base_fare").alias("base_fare"),
        F.min("total_fare").alias("total_fare"),
        F.sum("total_duration_in_minutes").cast("int").alias("total_duration_in_minutes"),
        F.count(F.lit(1)).cast("int").alias("segments"),
    )
