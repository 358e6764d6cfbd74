"""Itinerary search: put segments back together and show route and times."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions import to_bool, to_date, to_float, to_int
from skyledger.functions.text import PATH_SEPARATOR
from skyledger.operators.segments import WIDE_LISTS, unpack
from skyledger.operators.skew import semi_join
from skyledger.sources.scratch import materialize

TIME_SEPARATOR = " -- "
STOP_SEPARATOR = " | "
PRICE_ORDER = ("total_fare", "search_date", "flight_date", "leg_id")

# Column headings of the printed report.
REPORT_HEADINGS = {
    "leg_id": "leg_id",
    "total_fare": "总价",
    "full_path": "完整路径",
    "total_flight_minutes": "总飞行分钟",
    "timeline": "航段时间线 (出发 -- 到达)",
}


def _report(s: Column) -> list[Column]:
    """Route, flying minutes and timeline of an ordered array of segment structs.

    Minutes are NULL if a duration is missing; segments with a time missing are
    left out of the timeline.
    """
    seconds = F.aggregate(
        s["segment_duration_seconds"], F.lit(0.0), lambda total, x: total + x
    )
    times = F.zip_with(
        s["segment_departure_time_raw"],
        s["segment_arrival_time_raw"],
        lambda d, a: F.concat(d, F.lit(TIME_SEPARATOR), a),
    )
    return [
        F.concat_ws(
            PATH_SEPARATOR,
            s["segment_departure_airport"],
            F.element_at(s, -1)["segment_arrival_airport"],
        ).alias("full_path"),
        (seconds / 60).try_cast("int").alias("total_flight_minutes"),
        F.concat_ws(STOP_SEPARATOR, times).alias("timeline"),
    ]


def select_itineraries(
    wide: DataFrame,
    search_date: str | dt.date | None = None,
    flight_date: str | dt.date | None = None,
    start: str | None = None,
    destination: str | None = None,
    requests: DataFrame | None = None,
) -> DataFrame:
    """Segments of itineraries with a transfer that answer the search.

    The dates are partition columns of the wide table, so only the folders asked
    for are read. ``requests`` asks many searches at once: rows of
    ``search_date, flight_date, start, destination``.
    """
    rows = wide.where(~F.col("is_non_stop"))
    if search_date is not None:
        rows = rows.where(F.col("search_date") == F.to_date(F.lit(str(search_date))))
    if flight_date is not None:
        rows = rows.where(F.col("flight_date") == F.to_date(F.lit(str(flight_date))))
    if start is not None:
        rows = rows.where(F.col("journey_start_airport") == F.upper(F.lit(start)))
    if destination is not None:
        rows = rows.where(
            F.col("journey_final_destination") == F.upper(F.lit(destination))
        )
    if requests is not None:
        asked = requests.select(
            "search_date",
            "flight_date",
            F.upper("start").alias("journey_start_airport"),
            F.upper("destination").alias("journey_final_destination"),
        )
        rows = semi_join(rows, materialize(asked.distinct(), "searches"))
    return rows


def reassemble(segments: DataFrame) -> DataFrame:
    """One row per itinerary: price, route, flying time and timeline.

    A group is one itinerary of one search, told by its fare and ``trip_key`` as
    well, so it has a handful of segments even if many itineraries share a leg or
    have none. Copies of a segment row, from a search that was loaded twice, count
    once and are merged before the shuffle, however many there are.
    """
    # The hash first: sorting by it settles nearly all comparisons on one number.
    trip = ("trip_key", "search_date", "flight_date", "leg_id", "total_fare")
    # Structs made before the aggregate are made in generated code, and stay as they are.
    segment = F.struct(
        "segment_index",
        "segment_departure_airport",
        "segment_arrival_airport",
        "segment_departure_time_raw",
        "segment_arrival_time_raw",
        "segment_duration_seconds",
    )
    grouped = (
        segments.select(*trip, segment.alias("_segment"))
        .groupBy(*trip)
        .agg(F.sort_array(F.collect_set("_segment")).alias("_s"))
    )
    return grouped.select(
        "search_date", "flight_date", "leg_id", "total_fare", *_report(F.col("_s"))
    )


def itinerary_search(
    wide: DataFrame,
    search_date: str | dt.date | None = None,
    flight_date: str | dt.date | None = None,
    start: str | None = None,
    destination: str | None = None,
    requests: DataFrame | None = None,
) -> DataFrame:
    """Itineraries with a transfer, cheapest first. ``.limit(n)`` gives a top n."""
    found = select_itineraries(
        wide, search_date, flight_date, start, destination, requests
    )
    return reassemble(found).orderBy(*PRICE_ORDER)


def packed_itineraries(raw: DataFrame) -> DataFrame:
    """The same answer from the packed table, whose rows are whole itineraries.

    Needs no shuffle: the way to go when all itineraries are wanted. A raw row that
    was loaded twice appears twice.
    """
    typed = raw.select(
        to_date(F.col("search_date")).alias("search_date"),
        to_date(F.col("flight_date")).alias("flight_date"),
        "leg_id",
        to_float(F.col("total_fare")).alias("total_fare"),
        to_bool(F.col("is_non_stop")).alias("_non_stop"),
        *[unpack(src).alias(name) for name, src in WIDE_LISTS.items()],
    ).where(
        F.col("search_date").isNotNull()
        & F.col("flight_date").isNotNull()
        & ~F.col("_non_stop")
    )
    seconds = "segment_duration_seconds"
    zipped = typed.dropna(subset=list(WIDE_LISTS)).withColumn(
        seconds, F.transform(seconds, to_int)
    )
    zipped = zipped.withColumn("_s", F.arrays_zip(*WIDE_LISTS))
    return zipped.select(
        "search_date", "flight_date", "leg_id", "total_fare", *_report(F.col("_s"))
    )


def with_report_headings(found: DataFrame) -> DataFrame:
    return found.select(*[F.col(k).alias(v) for k, v in REPORT_HEADINGS.items()])
