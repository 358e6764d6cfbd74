from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from skyledger.operators.segments import (
    explode_segments,
    flights_view,
    segment_fact,
    serving_segments,
    unpack,
    wide_flights,
)
from tests.data import raw

PACKED = {
    "dep": "segments_departure_airport",
    "seconds": "segments_duration_in_seconds",
    "plane": "segments_equipment_description",
}


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_order_index_and_count(spark):
    df = explode_segments(raw(spark, {}), PACKED, ["leg_id"], count_from="dep")
    assert df.columns == [
        "leg_id",
        "total_segments",
        "segment_index",
        "dep",
        "seconds",
        "plane",
    ]
    assert rows(df) == [
        ("L1", 2, 1, "SFO", "5000", "Boeing"),
        ("L1", 2, 2, "DEN", "10059", "Airbus"),
    ]


def test_null_list_drops_the_itinerary(spark):
    source = raw(spark, {"segments_equipment_description": None})
    assert explode_segments(source, PACKED, ["leg_id"]).isEmpty()


def test_null_list_kept_as_empty(spark):
    source = raw(spark, {"segments_equipment_description": None})
    df = explode_segments(source, PACKED, ["leg_id"], on_null="keep")
    assert [r.plane for r in df.collect()] == [None, None]


def test_short_list_is_padded(spark):
    source = raw(spark, {"segments_duration_in_seconds": "5000"})
    df = explode_segments(source, PACKED, ["leg_id"])
    assert [r.seconds for r in df.orderBy("segment_index").collect()] == ["5000", None]


def test_empty_text_is_one_empty_value(spark):
    source = raw(spark, {v: "" for v in PACKED.values()})
    df = explode_segments(source, PACKED, with_index=False)
    assert rows(df) == [("", "", "")]


def test_trailing_empty_values_stay(spark):
    source = raw(spark, {"segments_duration_in_seconds": "5000||"})
    df = explode_segments(source, PACKED)
    assert [r.seconds for r in df.orderBy("segment_index").collect()] == ["5000", ""]


def test_unknown_policy(spark):
    with pytest.raises(ValueError):
        explode_segments(raw(spark, {}), PACKED, on_null="other")


def test_segment_fact(spark):
    source = raw(
        spark,
        {},
        {"leg_id": "bad date", "search_date": "x"},
        {"leg_id": "no date", "flight_date": None},
        {
            "leg_id": "L2",
            "segments_departure_airport": "SFO",
            "segments_distance": "12.9",
            "total_fare": "",
            "is_non_stop": "yes",
        },
    )
    df = segment_fact(source)
    assert df.where("leg_id like '% date'").isEmpty()
    first = df.where("leg_id = 'L1' and segment_index = 1").first()
    assert first.search_date == dt.date(2022, 4, 16)
    assert (first.segment_distance, first.segment_cabin_code) == (1000, "coach")
    assert (first.total_fare, first.is_non_stop, first.total_segments) == (123.5, False, 2)
    other = df.where("leg_id = 'L2' and segment_index = 1").first()
    assert (other.segment_distance, other.total_fare) == (12, None)
    assert (other.is_non_stop, other.total_segments) == (True, 1)


def test_wide_flights_and_view(spark):
    wide = wide_flights(raw(spark, {}))
    first = wide.where("segment_index = 1").first()
    assert first.segment_departure_epoch == 1651400000
    assert first.segment_departure_time_raw == "d1"
    flight = flights_view(wide).where("departure_airport_code = 'DEN'").first()
    assert flight.total_duration_in_minutes == 167
    assert flight.total_fare == 123.5


def test_no_shuffle_and_pruned_columns(spark, tmp_path):
    raw(spark, {}).write.parquet(str(tmp_path / "raw"))
    df = segment_fact(spark.read.parquet(str(tmp_path / "raw")))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert "segments_departure_time_raw" not in plan
    assert "elapsed_days" not in plan


def test_serving_segments(spark):
    source = raw(spark, {}, {}, {"leg_id": "L2", "is_non_stop": "True"})
    df = serving_segments(segment_fact(source)).drop("search_date")
    assert rows(df) == [("L1", 2, "0"), ("L2", 2, "1")]
    assert serving_segments(
        segment_fact(raw(spark, {"is_non_stop": None}))
    ).first().is_non_stop == "0"


def test_every_segment_index_once(spark):
    source = raw(spark, *[{"leg_id": f"L{i}"} for i in range(20)])
    counts = segment_fact(source).groupBy("leg_id").agg(
        F.sort_array(F.collect_list("segment_index")).alias("i")
    )
    assert all(r.i == [1, 2] for r in counts.collect())


def test_lists_are_cut_without_a_pattern(spark, capsys):
    texts = ["a", "", "a||b||c", "||", "|||", "||||", "a|b||", "\x01", "a\x01b||c", "\x01||\x01", "ä||ö", None]
    df = spark.createDataFrame([(t,) for t in texts], "v string").repartition(1)
    cut = df.select("v", unpack("v").alias("kept"), unpack("v", "keep").alias("filled"))
    for r in cut.collect():
        assert r.kept == (None if r.v is None else r.v.split("||"))
        assert r.filled == (r.kept or [])
    cut.explain()
    plan = capsys.readouterr().out
    assert "split(replace(v" in plan and "Contains(v" in plan
