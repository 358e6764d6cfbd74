"""Inputs of the library, derived from the given tables with Spark.

Definitions: FIXTURES.md. The oracle SQL derives the same rows by itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skyledger.schemas import RAW_ITINERARIES, SEGMENT_SEPARATOR
from skyledger.sources.scratch import materialize

_stored: dict[tuple[str, str, str], DataFrame] = {}


def stored(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived table, written once per application and data folder."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _stored:
        _stored[key] = materialize(DERIVED[name](spark, sf_dir), name, COMPRESSION.get(name))
    return _stored[key]


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def airport(nation: Column) -> Column:
    return F.concat(F.lit("A"), F.lpad(nation.cast("string"), 2, "0"))


def money(cents: Column) -> Column:
    """Cents as text with two decimals, the same in every engine."""
    return F.concat(
        F.floor(cents / 100).cast("string"),
        F.lit("."),
        F.lpad((cents % 100).cast("string"), 2, "0"),
    )


def cents(price: Column) -> Column:
    return F.round(price * 100).cast("bigint")


def flag(c: Column) -> Column:
    return F.when(c, "True").otherwise("False")


def epoch_text(epoch: Column) -> Column:
    """Epoch seconds as UTC text, whatever the time zone of the session."""
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return (start + F.make_dt_interval(secs=epoch)).cast("string")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineitems with the attributes of their supplier, part, order and customer."""
    supplier = given(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("from_nation")
    )
    part = given(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), "p_brand", "p_type"
    )
    customer = given(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("to_nation")
    )
    orders = (
        given(spark, sf_dir, "orders")
        .join(customer, "o_custkey")
        .withColumnRenamed("o_orderkey", "l_orderkey")
    )
    return (
        given(spark, sf_dir, "lineitem")
        .join(supplier, "l_suppkey")
        .join(part, "l_partkey")
        .join(orders, "l_orderkey")
    )


def _cabin(c: Column) -> Column:
    return F.when(c == "A", "coach").when(c == "N", "business").otherwise("first")


def _seconds() -> Column:
    return F.col("l_quantity").cast("int") * 300 + 1800


def raw_itineraries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """one packed row per order. An order has a handful of lines."""
    order = Window.partitionBy("l_orderkey").orderBy(
        "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"
    )
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    step = _seconds() + 3600 + (F.col("l_partkey") % 600) * 60
    flight_date = F.date_add(
        F.col("o_orderdate").cast("date"), (F.col("l_orderkey") % 180 + 1).cast("int")
    )
    departs = (
        F.unix_date(flight_date).cast("bigint") * 86400
        + 21600
        + F.coalesce(F.sum(step).over(earlier), F.lit(0))
    )
    segments = (
        _lines(spark, sf_dir)
        .withColumns(
            {
                "i": F.row_number().over(order),
                "next_nation": F.coalesce(
                    F.lead("from_nation").over(order), F.col("to_nation")
                ),
                "departs": departs,
                "flight_date": flight_date,
            }
        )
        .withColumn("arrives", F.col("departs") + _seconds())
    )
    segment = F.struct(
        "i",
        airport(F.col("from_nation")).alias("dep"),
        airport(F.col("next_nation")).alias("arr"),
        F.col("p_brand").alias("airline"),
        F.concat(F.lit("B"), F.regexp_replace("p_brand", r"\D", "")).alias("code"),
        F.col("p_type").alias("equipment"),
        _seconds().cast("string").alias("seconds"),
        (F.col("l_quantity").cast("int") * 50).alias("miles"),
        _cabin(F.col("l_returnflag")).alias("cabin"),
        "departs",
        "arrives",
    )
    once = (
        "o_orderdate",
        "o_totalprice",
        "o_orderpriority",
        "o_orderstatus",
        "flight_date",
    )
    orders = segments.groupBy(F.col("l_orderkey").alias("k")).agg(
        F.sort_array(F.collect_list(segment)).alias("s"),
        *[F.first(c).alias(c) for c in once],
    )

    def packed(values: Column) -> Column:
        return F.array_join(values, SEGMENT_SEPARATOR)

    def as_text(field: str) -> Column:
        return F.transform(F.col(f"s.{field}"), lambda x: x.cast("string"))

    price = cents(F.col("o_totalprice"))
    first, last = F.element_at("s", 1), F.element_at("s", -1)
    columns = {
        "leg_id": F.col("k").cast("string"),
        "search_date": F.col("o_orderdate").cast("date").cast("string"),
        "flight_date": F.col("flight_date").cast("string"),
        "starting_airport": first["dep"],
        "destination_airport": last["arr"],
        "fare_basis_code": F.concat(F.substring("o_orderpriority", 1, 1), "o_orderstatus"),
        "elapsed_days": (
            F.floor(last["arrives"] / 86400) - F.floor(first["departs"] / 86400)
        ).cast("string"),
        "is_basic_economy": flag(F.col("o_orderpriority").startswith("5")),
        "is_refundable": flag(F.col("o_orderstatus") == "F"),
        "is_non_stop": flag(F.size("s") == 1),
        "base_fare": money(F.floor((price * 9 + 5) / 10)),
        "total_fare": money(price),
        "seats_remaining": (F.col("k") % 10).cast("string"),
        "total_travel_distance": F.aggregate(
            F.col("s.miles"), F.lit(0), lambda a, m: a + m
        ).cast("string"),
        "segments_departure_time_epoch_seconds": packed(as_text("departs")),
        "segments_departure_time_raw": packed(F.transform(F.col("s.departs"), epoch_text)),
        "segments_arrival_time_epoch_seconds": packed(as_text("arrives")),
        "segments_arrival_time_raw": packed(F.transform(F.col("s.arrives"), epoch_text)),
        "segments_arrival_airport": packed(F.col("s.arr")),
        "segments_departure_airport": packed(F.col("s.dep")),
        "segments_airline_name": packed(F.col("s.airline")),
        "segments_airline_code": packed(F.col("s.code")),
        "segments_equipment_description": packed(F.col("s.equipment")),
        "segments_duration_in_seconds": packed(F.col("s.seconds")),
        "segments_distance": packed(as_text("miles")),
        "segments_cabin_code": packed(F.col("s.cabin")),
    }
    return orders.select(*[columns[n].alias(n) for n in RAW_ITINERARIES.names])


def dirty_itineraries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1b: F1 with faults put in by order number."""
    k = F.col("leg_id").cast("bigint")

    def faulty(n: int, name: str, value: Column) -> Column:
        return F.when(k % n == 0, value).otherwise(F.col(name)).alias(name)

    codes = F.transform(
        F.split("segments_airline_code", r"\|\|"),
        lambda c: F.concat(F.lit(" "), F.lower(c), F.lit(" ")),
    )
    seconds = F.split("segments_duration_in_seconds", r"\|\|")
    short = F.slice(seconds, F.lit(1), F.size(seconds) - 1)
    faults = {
        "segments_equipment_description": (97, F.lit(None).cast("string")),
        "segments_duration_in_seconds": (89, F.array_join(short, SEGMENT_SEPARATOR)),
        "segments_airline_code": (83, F.array_join(codes, SEGMENT_SEPARATOR)),
        "search_date": (79, F.lit("bad")),
        "seats_remaining": (73, F.lit("3.0")),
        "is_refundable": (71, F.lit("maybe")),
    }
    raw = stored(spark, sf_dir, "raw_itineraries")
    return raw.select(
        *[faulty(faults[c][0], c, faults[c][1]) if c in faults else c for c in raw.columns]
    )


def raw_airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One quoted code per nation, and one faulty or repeated code per region."""
    nation = given(spark, sf_dir, "nation").select(
        F.concat(F.lit("K"), airport(F.col("n_nationkey"))).alias("ident"),
        F.concat(F.lit('"'), airport(F.col("n_nationkey")), F.lit('"')).alias("iata_code"),
        F.col("n_name").alias("name"),
        F.concat(F.lit("City "), F.col("n_nationkey").cast("string")).alias("municipality"),
        F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("iso_country"),
    )
    n = F.col("r_regionkey")
    region = given(spark, sf_dir, "region").select(
        F.concat(F.lit("X"), n.cast("string")).alias("ident"),
        F.when(n == 0, F.lit(None).cast("string"))
        .when(n == 1, "  ")
        .when(n == 2, '""')
        .when(n == 3, '"a03"')
        .otherwise("A04 ")
        .alias("iata_code"),
        F.col("r_name").alias("name"),
        F.lit(None).cast("string").alias("municipality"),
        F.concat(F.lit("R"), n.cast("string")).alias("iso_country"),
    )
    return nation.unionByName(region)


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """one flight per lineitem."""
    minute = (
        F.col("l_partkey") * 37 + F.col("l_linenumber") * 101 + F.col("l_orderkey") * 13
    ) % 1440
    minutes = (F.col("l_quantity").cast("int") * 10 + 60).cast("int")
    key = [
        F.col(c).cast("string")
        for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    ]
    day = F.col("l_shipdate").cast("date")
    return (
        _lines(spark, sf_dir)
        .select(
            F.concat_ws("-", *key, cents(F.col("l_extendedprice")).cast("string")).alias(
                "leg_id"
            ),
            airport(F.col("from_nation")).alias("departure_airport_code"),
            airport(F.col("to_nation")).alias("arrival_airport_code"),
            (F.unix_date(day).cast("bigint") * 86400 + minute * 60).alias(
                "departure_epoch"
            ),
            F.col("l_extendedprice").alias("total_fare"),
            minutes.alias("total_duration_in_minutes"),
            day.alias("flight_date"),
        )
        .withColumn(
            "arrival_epoch",
            F.col("departure_epoch") + F.col("total_duration_in_minutes") * 60,
        )
    )


def fare_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fares of one leg (part) seen on many dates, as one-segment raw rows."""
    search = F.col("l_shipdate").cast("date")
    price = cents(F.col("l_extendedprice"))
    columns = {
        "leg_id": F.col("l_partkey").cast("string"),
        "search_date": search.cast("string"),
        "flight_date": F.date_add(search, (F.col("l_orderkey") % 180 + 1).cast("int")).cast(
            "string"
        ),
        "fare_basis_code": F.concat(F.substring("o_orderpriority", 1, 1), "o_orderstatus"),
        "is_basic_economy": flag(F.col("o_orderpriority").startswith("5")),
        "is_refundable": flag(F.col("o_orderstatus") == "F"),
        "is_non_stop": F.lit("True"),
        "base_fare": money(price),
        "total_fare": money(price),
        "seats_remaining": (F.col("l_orderkey") % 10).cast("string"),
        "segments_arrival_airport": airport(F.col("to_nation")),
        "segments_departure_airport": airport(F.col("from_nation")),
        "segments_airline_name": F.col("p_brand"),
        "segments_airline_code": F.concat(
            F.lit("B"), F.regexp_replace("p_brand", r"\D", "")
        ),
        "segments_equipment_description": F.col("p_type"),
        "segments_duration_in_seconds": _seconds().cast("string"),
        "segments_distance": (F.col("l_quantity").cast("int") * 50).cast("string"),
        "segments_cabin_code": _cabin(F.col("l_returnflag")),
    }
    none = F.lit(None).cast("string")
    return _lines(spark, sf_dir).select(
        *[columns.get(n, none).alias(n) for n in RAW_ITINERARIES.names]
    )


def itinerary_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """travel paths, some with extra white space, NULL or empty."""
    k = F.col("leg_id").cast("bigint")
    path = F.concat_ws(
        " -> ",
        F.split("segments_departure_airport", r"\|\|"),
        F.col("destination_airport"),
    )
    untidy = F.concat(F.lit(" "), F.replace(path, F.lit(" -> "), F.lit("  -> \t")))
    return stored(spark, sf_dir, "raw_itineraries").select(
        "leg_id",
        F.when(k % 101 == 0, F.lit(None).cast("string"))
        .when(k % 103 == 0, "")
        .when(k % 7 == 0, untidy)
        .otherwise(path)
        .alias("full_path"),
    )


def generated_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """query texts with and without words before SELECT, and all that was said."""
    k = F.col("o_orderkey")
    long = F.concat(
        F.lit("SQLQuery: select * from orders where o_orderkey = "),
        k.cast("string"),
        F.lit(" "),
    )
    made = given(spark, sf_dir, "orders").select(
        k.alias("id"),
        F.when(k % 3 == 0, long)
        .when(k % 3 == 1, "  Select 1")
        .otherwise(" no query here ")
        .alias("text"),
    )
    said = given(spark, sf_dir, "conversations").select(
        (-1 - F.col("conv_id") * 100_000 - F.col("turn")).alias("id"), "text"
    )
    return made.unionByName(said)


DERIVED = {
    "raw_itineraries": raw_itineraries,
    "dirty_itineraries": dirty_itineraries,
    "raw_airports": raw_airports,
    "flights": flights,
    "fare_history": fare_history,
    "itinerary_details": itinerary_details,
    "generated_queries": generated_queries,
}

# Each flight has an id of its own, a text that makes most of what is stored.
COMPRESSION = {"flights": "zstd"}
