"""Small hand-made raw rows."""

from __future__ import annotations

from skyledger.schemas import RAW_ITINERARIES

DEFAULTS = {
    "leg_id": "L1",
    "search_date": "2022-04-16",
    "flight_date": "2022-05-01",
    "starting_airport": "SFO",
    "destination_airport": "PHL",
    "fare_basis_code": "Y1",
    "elapsed_days": "0",
    "is_basic_economy": "False",
    "is_refundable": "False",
    "is_non_stop": "False",
    "base_fare": "100.0",
    "total_fare": "123.5",
    "seats_remaining": "4",
    "total_travel_distance": "2500",
    "segments_departure_time_epoch_seconds": "1651400000||1651410000",
    "segments_departure_time_raw": "d1||d2",
    "segments_arrival_time_epoch_seconds": "1651405000||1651420000",
    "segments_arrival_time_raw": "a1||a2",
    "segments_arrival_airport": "DEN||PHL",
    "segments_departure_airport": "SFO||DEN",
    "segments_airline_name": "United||Delta",
    "segments_airline_code": "UA||DL",
    "segments_equipment_description": "Boeing||Airbus",
    "segments_duration_in_seconds": "5000||10059",
    "segments_distance": "1000||1500",
    "segments_cabin_code": "coach||coach",
}


def raw(spark, *rows: dict):
    """Raw itineraries with these values in place of the default ones."""
    full = [{**DEFAULTS, **r} for r in rows]
    values = [tuple(r[n] for n in RAW_ITINERARIES.names) for r in full]
    return spark.createDataFrame(values, RAW_ITINERARIES)


def airports(spark, *codes):
    rows = [(f"K{i}", c, f"name {i}", f"city {i}", "US") for i, c in enumerate(codes)]
    return spark.createDataFrame(
        rows,
        "ident string, iata_code string, name string, municipality string, "
        "iso_country string",
    )


def same_rows(a, b) -> bool:
    b = b.select(*a.columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
