from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from skyledger.operators import dimensions as dims
from skyledger.operators.fact import (
    FACT_KEYS,
    fact_segments,
    itinerary_fares,
    star_fact,
)
from skyledger.operators.keys import assert_unique, dense_key, natural_key
from skyledger.operators.skew import (
    fits_broadcast,
    listed_values,
    lookup_join,
    semi_join,
    which_fit_broadcast,
)
from skyledger.schemas import RAW_ITINERARIES
from tests.data import airports, raw, same_rows


def test_airport_codes_are_cleaned_and_unique(spark):
    source = airports(spark, '"SFO"', " sfo", "DEN", None, "  ", '""', '" "')
    rows = dims.dim_airport(source).orderBy("airport_fk").collect()
    assert [(r.iata_code, r.airport_fk) for r in rows] == [("DEN", 1), ("SFO", 2)]


def test_airline_dimension_sees_members_inside_lists(spark):
    source = raw(
        spark,
        {},
        {"segments_airline_code": " ua ||B6", "segments_airline_name": "United||JetBlue"},
    )
    rows = dims.dim_airline(source).orderBy("airline_fk").collect()
    assert [r.airline_name for r in rows] == ["JetBlue", "Delta", "United"]
    assert [r.airline_fk for r in rows] == [1, 2, 3]
    packed = dims.dim_airline(source, packed=True).collect()
    assert {r.airline_code.strip() for r in packed} == {"UA||DL", "ua ||B6"}


def test_airline_without_names_stays(spark):
    source = raw(spark, {"segments_airline_name": None})
    assert dims.dim_airline(source).count() == 2


def test_aircraft_dimension(spark):
    source = raw(spark, {}, {"segments_equipment_description": "boeing|| "})
    rows = dims.dim_aircraft(source).orderBy("aircraft_fk").collect()
    assert [r.equipment_description for r in rows] == ["Airbus", "Boeing"]
    assert dims.dim_aircraft(source, packed=True).count() == 2


def test_flight_details_drop_incomplete_rows(spark):
    source = raw(spark, {}, {}, {"is_refundable": "maybe"}, {"fare_basis_code": None})
    rows = dims.dim_flight_details(source).collect()
    assert len(rows) == 1 and rows[0].flight_details_fk == 1


def test_date_dimension(spark):
    source = raw(spark, {}, {"search_date": "2022-05-01"}, {"search_date": "oops"})
    rows = dims.dim_date(source).orderBy("date_fk").collect()
    assert [r.full_date for r in rows] == [dt.date(2022, 4, 16), dt.date(2022, 5, 1)]
    assert (rows[1].day_of_week, rows[1].week_of_year, rows[1].quarter) == (1, 17, 2)


def test_ranked_in_ranges_as_in_one_task(spark):
    members = spark.range(0, 1000).select(
        F.concat(F.lit("m"), F.xxhash64("id").cast("string")).alias("code")
    )
    one = dense_key(members, ["code"], "fk")
    many = dense_key(members, ["code"], "fk", single_task_rows=10, ranges=7)
    assert same_rows(one, many)
    assert many.agg(F.min("fk"), F.max("fk"), F.countDistinct("fk")).first() == (
        1,
        1000,
        1000,
    )


def test_natural_keys_do_not_move(spark):
    few = natural_key(spark.createDataFrame([("a",), ("b",)], "code string"), ["code"], "fk")
    more = natural_key(spark.createDataFrame([("0",), ("a",)], "code string"), ["code"], "fk")
    key = {r.code: r.fk for r in few.collect()}
    assert {r.code: r.fk for r in more.collect()}["a"] == key["a"]
    assert 0 not in key.values()
    stable = dims.dim_airline(raw(spark, {}), stable=True)
    assert stable.count() == 2 and not stable.where("airline_fk = 0").count()


def test_assert_unique(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    assert same_rows(assert_unique(df, ["k"], "test"), df)
    with pytest.raises(Exception, match="more than one row per k in test"):
        assert_unique(df.unionAll(df), ["k"], "test").collect()


def build(spark, source, *codes):
    built = dims.build_dimensions(source, airports(spark, *codes))
    return built, star_fact(source, built)


def test_star_fact_values(spark):
    source = raw(spark, {"seats_remaining": "3.0"})
    built, fact = build(spark, source, "SFO", "DEN")
    row = fact.where("departure_airport_fk = 2").first()
    assert (row.total_duration_in_minutes, row.total_travel_distance) == (83, 1000)
    assert (row.search_to_flight_days, row.seats_remaining) == (15, 3)
    assert (row.year, row.month, row.day) == (2022, 5, 1)
    assert row.search_date_fk == 1 and row.flight_date_fk == 2
    assert all(row[k] >= 1 for k in FACT_KEYS)
    # PHL is no known airport.
    assert fact.where("departure_airport_fk = 1").first().arrival_airport_fk == 0


def test_fact_rows_equal_exploded_rows(spark):
    source = raw(
        spark,
        *[{"leg_id": f"L{i}", "segments_airline_code": " ua ||DL"} for i in range(5)],
        *[{"leg_id": f"M{i}", "search_date": "?"} for i in range(5)],
    )
    _, fact = build(spark, source, "SFO", " sfo ", '"SFO"', "PHL", "PHL", None)
    assert fact.count() == fact_segments(source).count() == 20
    assert fact.where("leg_id like 'M%' and search_date_fk <> 0").isEmpty()
    assert fact.where("airline_fk = 0").isEmpty()


def test_itinerary_grain(spark):
    _, fact = build(spark, raw(spark, {}), "SFO")
    rows = itinerary_fares(fact).collect()
    assert len(rows) == 1
    assert (rows[0].total_fare, rows[0].segments) == (123.5, 2)
    assert rows[0].total_duration_in_minutes == 83 + 167


def test_lookups_are_broadcast(spark):
    _, fact = build(spark, raw(spark, {}), "SFO")
    plan = fact._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 7 and "SortMergeJoin" not in plan


def skewed(spark):
    """A third of the rows on one key, a few NULL keys, keys without a partner."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None)
    left = spark.range(3000).select("id", key.otherwise(F.col("id") % 40).alias("k"))
    right = spark.range(35).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    return left, right


@pytest.mark.parametrize("how", ["left", "inner"])
def test_lookup_join_on_both_sides_of_the_bound(spark, how):
    left, right = skewed(spark)
    plain = left.join(right, "k", how)
    assert same_rows(plain, lookup_join(left, right, ["k"], how, small=False))
    assert same_rows(plain, lookup_join(left, right, ["k"], how))


def test_joins_beyond_the_bound_read_each_side_once(spark, tmp_path):
    left, right = skewed(spark)
    left.write.parquet(f"{tmp_path}/left")
    right.select("k").write.parquet(f"{tmp_path}/keys")
    stored, keys = (spark.read.parquet(f"{tmp_path}/{t}") for t in ("left", "keys"))
    joined = lookup_join(stored, right, ["k"], small=False)
    kept = semi_join(stored, keys, small=False)
    for df in (joined, kept):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 2 and "TakeOrdered" not in plan
    assert same_rows(left.join(right, "k", "left"), joined)


def test_listed_values(spark):
    df = spark.range(500).select((F.col("id") % 3).alias("few"), F.col("id").alias("many"))
    found = listed_values(df)
    assert sorted(found["few"]) == [0, 1, 2] and "many" not in found


def test_semi_join_beyond_the_bound(spark):
    left, right = skewed(spark)
    keys = right.select("k")
    plain = left.join(keys, "k", "left_semi")
    assert same_rows(plain, semi_join(left, keys))
    assert same_rows(plain, semi_join(left, keys, small=False))
    assert same_rows(plain, semi_join(left, keys, small=True, values={}))
    two = right.where("v < 200")
    wide = left.withColumn("v", F.col("k") * 10)
    assert same_rows(wide.join(two, ["k", "v"], "left_semi"), semi_join(wide, two))


def test_broadcast_bound(spark):
    texts = spark.range(100).select(F.lit("x" * 1000).alias("t"))
    assert fits_broadcast(texts)
    assert not fits_broadcast(texts, max_rows=99)
    assert not fits_broadcast(texts, max_bytes=50_000)
    nested = texts.select(F.array("t", "t").alias("a"), F.struct("t").alias("s"))
    assert not fits_broadcast(nested, max_bytes=250_000)
    assert not fits_broadcast(texts.select(F.col("t").cast("binary")), max_bytes=50_000)
    assert which_fit_broadcast([texts, texts.limit(0)], max_rows=50) == [False, True]


def test_lookup_join_rejects_other_kinds(spark):
    left, right = skewed(spark)
    with pytest.raises(ValueError):
        lookup_join(left, right, ["k"], "outer")


def test_all_dimensions_come_from_one_scan(spark, tmp_path):
    rows = [
        {"segments_airline_code": "B1||b1 ", "segments_airline_name": "One||Uno"},
        {"segments_airline_code": None, "segments_equipment_description": "||  ||X"},
        {"fare_basis_code": None, "search_date": "bad", "is_refundable": "maybe"},
        {"segments_airline_code": "B2||B3", "segments_airline_name": "Two"},
        {"segments_equipment_description": None, "search_date": None},
    ]
    raw(spark, *rows).repartition(2).write.parquet(f"{tmp_path}/raw")
    source = spark.read.schema(RAW_ITINERARIES).parquet(f"{tmp_path}/raw")
    plan = dims.tagged_members(source)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    scanned = plan.split("ReadSchema")[1]
    assert "segments_distance" not in scanned and "total_fare" not in scanned
    built = dims.build_dimensions(source, airports(spark, "AAA"))
    assert same_rows(built.airline, dims.dim_airline(source))
    assert same_rows(built.aircraft, dims.dim_aircraft(source))
    assert same_rows(built.flight_details, dims.dim_flight_details(source))
    assert same_rows(built.date, dims.dim_date(source))


def test_members_are_made_in_generated_code(spark):
    """No lambda per row, and a row with lists of different lengths, or none, loses nothing."""
    source = raw(
        spark,
        {"segments_airline_code": "B1||B2||B3", "segments_airline_name": "One",
         "segments_equipment_description": "X||Y"},
        {"segments_airline_code": None, "segments_airline_name": None,
         "segments_equipment_description": None, "fare_basis_code": "Z"},
    )
    members = dims.tagged_members(source)
    plan = members._jdf.queryExecution().executedPlan().toString()
    assert "lambdafunction" not in plan and "array_distinct" not in plan
    found = {(r.dimension, *[v for v in r["values"] if v is not None]) for r in members.collect()}
    assert found == {
        ("airline", "B1", "One"), ("airline", "B2"), ("airline", "B3"),
        ("aircraft", "X"), ("aircraft", "Y"),
        ("flight_details", "Y1", "coach||coach", "false", "false"),
        ("flight_details", "Z", "coach||coach", "false", "false"),
        ("date", "2022-04-16"), ("date", "2022-05-01"),
    }
