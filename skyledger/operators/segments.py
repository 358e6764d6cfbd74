"""Packed itineraries to one row per flight segment."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions import to_bool, to_date, to_float, to_int, to_long
from skyledger.schemas import SEGMENT_SEPARATOR

_SEPARATOR_PATTERN = r"\|\|"
assert SEGMENT_SEPARATOR == "||"


# One character that hardly any text holds: a list cut at it needs no pattern.
_MARK = "\x01"


def unpack(c: Column | str, on_null: str = "drop") -> Column:
    """The values of a packed list. A list of one value is taken as it is."""
    c = F.col(c) if isinstance(c, str) else c
    marked = F.replace(c, F.lit(SEGMENT_SEPARATOR), F.lit(_MARK))
    values = (
        F.when(~F.contains(c, F.lit(SEGMENT_SEPARATOR)), F.array(c))
        .when(F.contains(c, F.lit(_MARK)), F.split(c, _SEPARATOR_PATTERN))
        .when(c.isNotNull(), F.split(marked, _MARK))
    )
    if on_null == "keep":
        return F.coalesce(values, F.array().cast("array<string>"))
    return values


def explode_segments(
    df: DataFrame,
    packed: Mapping[str, str],
    carry: Sequence[str] = (),
    on_null: str = "drop",
    with_index: bool = True,
    count_from: str | None = None,
) -> DataFrame:
    """One row per segment of each itinerary.

    ``packed`` maps output column to packed input column, ``carry`` lists columns
    repeated on each segment. Lists are matched by position and short ones padded
    with NULL. An itinerary with a NULL list is dropped, or with
    ``on_null="keep"`` the list counts as empty. ``count_from`` names the output
    column whose list length becomes ``total_segments``. Only columns named here
    are read, and nothing is shuffled.
    """
    if on_null not in ("drop", "keep"):
        raise ValueError(on_null)
    lists = {out: unpack(F.col(src), on_null) for out, src in packed.items()}
    # Fields of the zipped structs are called like the columns that go in.
    rows = df.select(*carry, *[v.alias(f"_list_{k}") for k, v in lists.items()])
    keep = list(carry)
    if count_from is not None:
        rows = rows.withColumn("total_segments", F.size(f"_list_{count_from}"))
        keep.append("total_segments")
    zipped = F.arrays_zip(*[f"_list_{k}" for k in lists])
    if with_index:
        rows = rows.select(*keep, F.posexplode(zipped).alias("_pos", "_seg"))
        keep.append((F.col("_pos") + 1).alias("segment_index"))
    else:
        rows = rows.select(*keep, F.explode(zipped).alias("_seg"))
    return rows.select(*keep, *[F.col(f"_seg._list_{k}").alias(k) for k in lists])


def _dated(raw: DataFrame, carry: Sequence[str]) -> DataFrame:
    """Typed itinerary columns; rows without both dates are dropped up front."""
    return raw.select(
        to_date(F.col("search_date")).alias("search_date"),
        to_date(F.col("flight_date")).alias("flight_date"),
        "leg_id",
        F.col("starting_airport").alias("journey_start_airport"),
        F.col("destination_airport").alias("journey_final_destination"),
        to_float(F.col("total_fare")).alias("total_fare"),
        to_bool(F.col("is_non_stop")).alias("is_non_stop"),
        *carry,
    ).where(F.col("search_date").isNotNull() & F.col("flight_date").isNotNull())


_CONTEXT = (
    "search_date",
    "flight_date",
    "leg_id",
    "journey_start_airport",
    "journey_final_destination",
    "total_fare",
    "is_non_stop",
)


# Output column of the segment fact and of the wide table, and its packed source.
FACT_LISTS = {
    "segment_departure_airport": "segments_departure_airport",
    "segment_arrival_airport": "segments_arrival_airport",
    "segment_airline_name": "segments_airline_name",
    "segment_duration_seconds": "segments_duration_in_seconds",
    "segment_distance": "segments_distance",
    "segment_cabin_code": "segments_cabin_code",
    "segment_equipment_description": "segments_equipment_description",
}
WIDE_LISTS = {
    "segment_departure_airport": "segments_departure_airport",
    "segment_arrival_airport": "segments_arrival_airport",
    "segment_airline_name": "segments_airline_name",
    "segment_duration_seconds": "segments_duration_in_seconds",
    "segment_departure_time_raw": "segments_departure_time_raw",
    "segment_arrival_time_raw": "segments_arrival_time_raw",
    "segment_departure_epoch": "segments_departure_time_epoch_seconds",
    "segment_arrival_epoch": "segments_arrival_time_epoch_seconds",
}


def segment_fact(raw: DataFrame, on_null: str = "drop") -> DataFrame:
    """``fact_flight_segments``: segments with distance, cabin and equipment."""
    rows = explode_segments(
        _dated(raw, tuple(FACT_LISTS.values())),
        FACT_LISTS,
        _CONTEXT,
        on_null,
        count_from="segment_departure_airport",
    )
    return rows.select(
        "search_date",
        "flight_date",
        "leg_id",
        "segment_index",
        "segment_departure_airport",
        "segment_arrival_airport",
        "segment_airline_name",
        to_int(F.col("segment_duration_seconds")).alias("segment_duration_seconds"),
        to_int(F.col("segment_distance")).alias("segment_distance"),
        "segment_cabin_code",
        "segment_equipment_description",
        "total_fare",
        "is_non_stop",
        "total_segments",
        "journey_start_airport",
        "journey_final_destination",
    )


def wide_flights(raw: DataFrame, on_null: str = "drop") -> DataFrame:
    """``wide_flight_analytics``: segments with departure and arrival times.

    ``trip_key`` is a hash of what the itinerary was loaded with, the same for all
    its segments: it tells trips apart that share a leg, or have none.
    """
    lists = tuple(WIDE_LISTS.values())
    trip = F.xxhash64("leg_id", "total_fare", *lists).alias("trip_key")
    rows = explode_segments(
        _dated(raw, (*lists, trip)),
        WIDE_LISTS,
        (*_CONTEXT, "trip_key"),
        on_null,
        count_from="segment_departure_airport",
    )
    return rows.select(
        "search_date",
        "flight_date",
        "leg_id",
        "segment_index",
        "journey_start_airport",
        "journey_final_destination",
        "total_fare",
        "is_non_stop",
        "total_segments",
        "segment_departure_airport",
        "segment_arrival_airport",
        "segment_airline_name",
        to_int(F.col("segment_duration_seconds")).alias("segment_duration_seconds"),
        "segment_departure_time_raw",
        "segment_arrival_time_raw",
        to_long(F.col("segment_departure_epoch")).alias("segment_departure_epoch"),
        to_long(F.col("segment_arrival_epoch")).alias("segment_arrival_epoch"),
        "trip_key",
    )


def flights_view(wide: DataFrame) -> DataFrame:
    """The columns connection search needs, one flight per segment.

    The fare is that of the whole itinerary, as in the ticket fact. A flight is
    there again for each search that saw it, hence the search date.
    """
    return wide.select(
        "leg_id",
        F.col("segment_departure_airport").alias("departure_airport_code"),
        F.col("segment_arrival_airport").alias("arrival_airport_code"),
        F.col("segment_departure_epoch").alias("departure_epoch"),
        F.col("segment_arrival_epoch").alias("arrival_epoch"),
        F.col("total_fare").cast("double").alias("total_fare"),
        (F.col("segment_duration_seconds") / 60).cast("int").alias(
            "total_duration_in_minutes"
        ),
        "flight_date",
        "search_date",
    )


def serving_segments(segments: DataFrame) -> DataFrame:
    """The narrow table that is served: one row per leg and search date.

    All segments of an itinerary agree on these columns, so the first stands for
    the others before anything is shuffled.
    """
    return segments.where(F.col("segment_index") == 1).select(
        "leg_id",
        "total_segments",
        F.when(F.col("is_non_stop"), "1").otherwise("0").alias("is_non_stop"),
        "search_date",
    ).distinct()
