from __future__ import annotations

from skyledger.operators.itineraries import (
    REPORT_HEADINGS,
    itinerary_search,
    packed_itineraries,
    with_report_headings,
)
from skyledger.operators.segments import wide_flights
from skyledger.sources.tables import replace_path
from tests.data import raw, same_rows


def source(spark):
    return raw(
        spark,
        {},
        {"leg_id": "cheap", "total_fare": "99"},
        {"leg_id": "direct", "is_non_stop": "True"},
        {"leg_id": "unknown", "is_non_stop": None},
        {"leg_id": "other day", "flight_date": "2022-05-02"},
        {"leg_id": "elsewhere", "destination_airport": "JFK"},
        {"leg_id": "no minutes", "segments_duration_in_seconds": "5000||"},
        {"leg_id": "no time", "segments_departure_time_raw": "d1"},
        {"leg_id": "no price", "total_fare": "n/a"},
        {"leg_id": "no list", "segments_airline_name": None},
    )


def test_report(spark):
    row = itinerary_search(wide_flights(raw(spark, {}))).first()
    assert row.full_path == "SFO -> DEN -> PHL"
    assert row.total_flight_minutes == 250
    assert row.timeline == "d1 -- a1 | d2 -- a2"
    assert row.total_fare == 123.5


def test_copies_of_a_row_count_once(spark):
    wide = wide_flights(raw(spark, *[{} for _ in range(50)]))
    assert same_rows(itinerary_search(wide), itinerary_search(wide_flights(raw(spark, {}))))


def test_search_one_route_and_day(spark):
    found = itinerary_search(
        wide_flights(source(spark)), "2022-04-16", "2022-05-01", "sfo", "phl"
    )
    rows = found.collect()
    assert [r.leg_id for r in rows] == ["no price", "cheap", "L1", "no minutes", "no time"]
    by_leg = {r.leg_id: r for r in rows}
    assert by_leg["no minutes"].total_flight_minutes is None
    assert by_leg["no time"].timeline == "d1 -- a1"
    assert list(with_report_headings(found).columns) == list(REPORT_HEADINGS.values())


def test_many_requests_at_once(spark):
    requests = spark.createDataFrame(
        [("2022-04-16", "2022-05-02", "sfo", "phl"), ("2022-04-16", "2022-05-01", "sfo", "jfk")],
        "search_date string, flight_date string, start string, destination string",
    ).selectExpr(
        "to_date(search_date) search_date",
        "to_date(flight_date) flight_date",
        "start",
        "destination",
    )
    found = itinerary_search(wide_flights(source(spark)), requests=requests)
    assert sorted(r.leg_id for r in found.collect()) == ["elsewhere", "other day"]


def test_segments_are_grouped_by_hash_as_made(spark):
    """The sort of the groups begins with a number, and no struct is made in the aggregate."""
    plan = itinerary_search(wide_flights(source(spark)))._jdf.queryExecution().executedPlan()
    grouped = [x for x in plan.toString().splitlines() if "ObjectHashAggregate" in x]
    assert len(grouped) == 2
    for line in grouped:
        assert line.split("keys=[")[1].startswith("trip_key")
        assert "collect_set(_segment" in line and "struct" not in line


def test_packed_rows_give_the_same_answer_without_a_shuffle(spark):
    packed = packed_itineraries(source(spark))
    assert same_rows(itinerary_search(wide_flights(source(spark))), packed)
    assert "Exchange" not in packed._jdf.queryExecution().executedPlan().toString()


def test_search_reads_only_its_partition(spark, tmp_path):
    wide = replace_path(
        wide_flights(source(spark)), str(tmp_path / "wide"), ["search_date", "flight_date"]
    )
    found = itinerary_search(wide, "2022-04-16", "2022-05-02", "SFO", "PHL")
    assert [r.leg_id for r in found.collect()] == ["other day"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "search_date" in filters and "flight_date" in filters


def test_trips_that_share_a_leg_or_have_none(spark):
    rows = [
        {"total_fare": "100"}, {"total_fare": "200"}, {"total_fare": "200"},
        {"leg_id": None, "segments_airline_name": "A||B"},
        {"leg_id": None, "segments_airline_name": "C||D"},
    ]
    found = itinerary_search(wide_flights(raw(spark, *rows))).collect()
    assert [(r.leg_id, r.total_fare) for r in found] == [
        ("L1", 100.0), (None, 123.5), (None, 123.5), ("L1", 200.0)
    ]
    assert all(r.full_path == "SFO -> DEN -> PHL" for r in found)
