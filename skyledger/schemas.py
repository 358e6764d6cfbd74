"""Raw table layouts. Raw columns are text; operators cast what they use."""

from __future__ import annotations

from pyspark.sql import types as T

SEGMENT_SEPARATOR = "||"


def _text(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


ITINERARY_COLUMNS = (
    "leg_id",
    "search_date",
    "flight_date",
    "starting_airport",
    "destination_airport",
    "fare_basis_code",
    "elapsed_days",
    "is_basic_economy",
    "is_refundable",
    "is_non_stop",
    "base_fare",
    "total_fare",
    "seats_remaining",
    "total_travel_distance",
)

# One value per segment, joined by SEGMENT_SEPARATOR.
PACKED_COLUMNS = (
    "segments_departure_time_epoch_seconds",
    "segments_departure_time_raw",
    "segments_arrival_time_epoch_seconds",
    "segments_arrival_time_raw",
    "segments_arrival_airport",
    "segments_departure_airport",
    "segments_airline_name",
    "segments_airline_code",
    "segments_equipment_description",
    "segments_duration_in_seconds",
    "segments_distance",
    "segments_cabin_code",
)

RAW_ITINERARIES = _text(*ITINERARY_COLUMNS, *PACKED_COLUMNS)
RAW_AIRPORTS = _text("ident", "iata_code", "name", "municipality", "iso_country")
