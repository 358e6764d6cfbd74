"""One query per operator of the library, over whole derived tables."""

from __future__ import annotations

import datetime as dt
import uuid
from functools import reduce

from pyspark.ml import Pipeline
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.functions import clean_path, extract_select
from skyledger.operators import connections as conn
from skyledger.operators import dimensions as dims
from skyledger.operators.fact import FACT_PARTITIONS, itinerary_fares, star_fact
from skyledger.operators.flight_layout import FlightLayout, store_layout
from skyledger.operators.features import best_time_label, fare_features, route_price_rule
from skyledger.operators.itineraries import itinerary_search, packed_itineraries
from skyledger.operators.keys import dense_key
from skyledger.operators.model import (
    CATEGORICAL,
    NUMERICAL,
    as_expression,
    feature_stages,
    fit_numeric_trees,
    load_model,
    sample_rows,
    save_model,
    split_rows,
    train_fare_model,
    tree_table,
)
from skyledger.operators.reports import rmse, stitched_share
from skyledger.operators.scoring import ROUTE, future_dates, recommend, scenario_grid
from skyledger.operators.segments import (
    explode_segments,
    flights_view,
    segment_fact,
    serving_segments,
    wide_flights,
)
from skyledger.operators.skew import lookup_join
from skyledger.sources.lookup_files import (
    AIRPORT_COLUMNS,
    airports_table,
    countries_table,
    load_lookup_csv,
)
from skyledger.sources.scratch import materialize, scratch_root
from skyledger.sources.tables import (
    on_day,
    read_day,
    read_days,
    read_partition,
    read_table,
    register_table,
    replace_partitions,
    replace_path,
    write_json_lines,
)
from workload.derive import given, stored

AS_OF = "2022-01-01"
SCAN_DAY = "1998-06-15"
SEARCH_DAY = "1995-03-07"
FIRST_MONTH, LAST_MONTH = "1992-01-01", "1998-12-01"

_dirty_features: dict[tuple[str, str], DataFrame] = {}
_warehouses: dict[tuple[str, str, str], tuple[DataFrame, dims.Dimensions]] = {}


def two_decimals(name: str) -> Column:
    return F.round(F.col(name).cast("double"), 2).alias(name)


def _with_rounded_fares(df: DataFrame) -> DataFrame:
    fares = [c for c in df.columns if c.endswith("_fare")]
    return df.select(*[two_decimals(c) if c in fares else c for c in df.columns])


def _dimensions(spark: SparkSession, d: str, raw: str) -> dims.Dimensions:
    return dims.build_dimensions(stored(spark, d, raw), stored(spark, d, "raw_airports"))


_fact_paths: dict[tuple[str, str, str], str] = {}


def _warehouse(
    spark: SparkSession, d: str, raw: str
) -> tuple[DataFrame, dims.Dimensions]:
    """Ticket fact and dimensions of a raw table, stored once per application.

    By day where days are asked for; training features are read as a whole.
    """
    key = (spark.sparkContext.applicationId, d, raw)
    if key not in _warehouses:
        built = _dimensions(spark, d, raw)
        fact = star_fact(stored(spark, d, raw), built)
        if raw == "raw_itineraries":
            path = f"{scratch_root(spark)}/fact-{raw}-{len(_warehouses)}"
            fact = materialize(fact, f"fact-{raw}-rows")
            _warehouses[key] = (replace_path(fact, path, FACT_PARTITIONS), built)
            _fact_paths[key] = path
        else:
            _warehouses[key] = (materialize(fact, f"fact-{raw}"), built)
    return _warehouses[key]


def _features(spark: SparkSession, d: str, raw: str = "fare_history") -> DataFrame:
    fact, built = _warehouse(spark, d, raw)
    return fare_features(fact, built.date)


def segments(spark: SparkSession, d: str) -> DataFrame:
    return explode_segments(
        stored(spark, d, "raw_itineraries"),
        {
            "departure_airport": "segments_departure_airport",
            "arrival_airport": "segments_arrival_airport",
            "airline_name": "segments_airline_name",
            "equipment": "segments_equipment_description",
            "seconds": "segments_duration_in_seconds",
        },
        carry=["leg_id"],
        count_from="departure_airport",
    )


def segments_kept(spark: SparkSession, d: str) -> DataFrame:
    """Faulty rows, with a missing list counted as empty instead of dropped."""
    return explode_segments(
        stored(spark, d, "dirty_itineraries"),
        {
            "departure_airport": "segments_departure_airport",
            "equipment": "segments_equipment_description",
            "seconds": "segments_duration_in_seconds",
        },
        carry=["leg_id"],
        on_null="keep",
    )


def segment_facts(spark: SparkSession, d: str) -> DataFrame:
    return _with_rounded_fares(segment_fact(stored(spark, d, "raw_itineraries")))


def wide(spark: SparkSession, d: str) -> DataFrame:
    rows = wide_flights(stored(spark, d, "raw_itineraries")).drop("trip_key")
    return _with_rounded_fares(rows)


def serving(spark: SparkSession, d: str) -> DataFrame:
    return serving_segments(segment_fact(stored(spark, d, "raw_itineraries")))


def flights_of_wide(spark: SparkSession, d: str) -> DataFrame:
    return _with_rounded_fares(
        flights_view(wide_flights(stored(spark, d, "raw_itineraries")))
    )


def dim_airport(spark: SparkSession, d: str) -> DataFrame:
    return dims.dim_airport(stored(spark, d, "raw_airports"))


def dim_airline(spark: SparkSession, d: str) -> DataFrame:
    return dims.dim_airline(stored(spark, d, "dirty_itineraries"))


def dim_aircraft(spark: SparkSession, d: str) -> DataFrame:
    return dims.dim_aircraft(stored(spark, d, "raw_itineraries"))


def dim_flight_details(spark: SparkSession, d: str) -> DataFrame:
    return dims.dim_flight_details(stored(spark, d, "dirty_itineraries"))


def dim_date(spark: SparkSession, d: str) -> DataFrame:
    return dims.dim_date(stored(spark, d, "dirty_itineraries"))


def dim_date_ranges(spark: SparkSession, d: str) -> DataFrame:
    """The same dates, keyed range by range as if they were too many for one task."""
    members = dims.dim_date(stored(spark, d, "dirty_itineraries")).drop("date_fk")
    members = materialize(members, "dates")
    return dense_key(members, ["full_date"], "date_fk", single_task_rows=100)


def dimensions_at_once(spark: SparkSession, d: str) -> DataFrame:
    """Keys and codes of the dimensions that one pass over the raw table gives."""
    built = _dimensions(spark, d, "dirty_itineraries")
    parts = [
        built.airline.select(F.lit("airline"), "airline_fk", "airline_code"),
        built.aircraft.select(F.lit("aircraft"), "aircraft_fk", "equipment_description"),
        built.flight_details.select(
            F.lit("flight_details"), "flight_details_fk", F.concat_ws("|", *dims.FLIGHT_DETAILS)
        ),
        built.date.select(F.lit("date"), "date_fk", F.col("full_date").cast("string")),
    ]
    return reduce(DataFrame.unionAll, parts).toDF("dimension", "key", "member")


def star(spark: SparkSession, d: str) -> DataFrame:
    raw = stored(spark, d, "raw_itineraries")
    return _with_rounded_fares(star_fact(raw, _dimensions(spark, d, "raw_itineraries")))


def lookup_normalized(spark: SparkSession, d: str) -> DataFrame:
    """Faulty rows against the dimensions of the clean ones."""
    raw = stored(spark, d, "dirty_itineraries")
    return _with_rounded_fares(star_fact(raw, _dimensions(spark, d, "raw_itineraries")))


def fares_per_itinerary(spark: SparkSession, d: str) -> DataFrame:
    fact, _ = _warehouse(spark, d, "raw_itineraries")
    return _with_rounded_fares(itinerary_fares(fact))


def partition_scan(spark: SparkSession, d: str) -> DataFrame:
    """One day of the stored ticket fact."""
    fact, _ = _warehouse(spark, d, "raw_itineraries")
    return _with_rounded_fares(fact.where(on_day(SCAN_DAY)))


_days_tables: dict[tuple[str, str], str] = {}


def _fact_table(spark: SparkSession, d: str) -> str:
    """The stored ticket fact under a name in the catalog."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _days_tables:
        _warehouse(spark, d, "raw_itineraries")
        _days_tables[key] = f"fact_flight_ticket_{uuid.uuid4().hex[:8]}"
        register_table(spark, _days_tables[key], _fact_paths[(*key, "raw_itineraries")])
    return _days_tables[key]


def day_scan(spark: SparkSession, d: str) -> DataFrame:
    """One day of the fact by its catalog name, through SQL."""
    return _with_rounded_fares(read_day(spark, _fact_table(spark, d), SCAN_DAY))


def days_scan(spark: SparkSession, d: str) -> DataFrame:
    """The first days of months before 1994 on which an order was made, from a table of them."""
    days = given(spark, d, "orders").select(F.col("o_orderdate").cast("date").alias("day"))
    first = days.where((F.dayofmonth("day") == 1) & (F.year("day") < 1994)).distinct()
    return _with_rounded_fares(read_days(spark, _fact_table(spark, d), first))


def replace_days(spark: SparkSession, d: str) -> DataFrame:
    """A fare table by month, loaded twice: the second load replaces the months it has.

    Every third month is loaded again, at twice the fare and without some of its legs;
    the others stay as they were. The table is refreshed and read back.
    """
    name = f"fares_by_month_{uuid.uuid4().hex[:8]}"
    by = ["fare_year", "fare_month"]
    fares = stored(spark, d, "flights").select(
        "leg_id",
        "total_fare",
        F.year("flight_date").alias("fare_year"),
        F.month("flight_date").alias("fare_month"),
    )
    again = fares.where("fare_month % 3 = 0 AND leg_id NOT LIKE '%7'").withColumn(
        "total_fare", F.col("total_fare") * 2
    )
    mode = "spark.sql.sources.partitionOverwriteMode"
    old = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        path = f"{scratch_root(spark)}/{name}"
        replace_path(fares, path, by)
        register_table(spark, name, path)
        replace_partitions(again, name, by)
    finally:
        spark.conf.set(mode, old)
    return _with_rounded_fares(read_table(spark, name, refresh=True))


def search(spark: SparkSession, d: str) -> DataFrame:
    wide_table = wide_flights(stored(spark, d, "raw_itineraries"))
    return _with_rounded_fares(itinerary_search(wide_table))


def search_partition(spark: SparkSession, d: str) -> DataFrame:
    """One search date of the stored wide table, read through its folder.

    Stored by search date alone: nearly every itinerary of the test tables has a
    flight date of its own.
    """
    wide_table = wide_flights(stored(spark, d, "raw_itineraries"))
    path = f"{scratch_root(spark)}/wide-{uuid.uuid4().hex[:8]}"
    schema = replace_path(wide_table, path, ["search_date"]).schema
    day = dt.date.fromisoformat(SEARCH_DAY)
    rows = read_partition(spark, path, schema, search_date=day)
    return _with_rounded_fares(itinerary_search(rows, search_date=SEARCH_DAY))


def search_twice(spark: SparkSession, d: str) -> DataFrame:
    """Every leg loaded a second time at another fare: both trips are found."""
    raw = stored(spark, d, "raw_itineraries")
    again = raw.withColumn("total_fare", F.col("base_fare"))
    return _with_rounded_fares(itinerary_search(wide_flights(raw.unionAll(again))))


def search_requests(spark: SparkSession, d: str) -> DataFrame:
    """All searches that were made, answered from the wide table."""
    raw = stored(spark, d, "raw_itineraries")
    requests = raw.select(
        F.to_date("search_date").alias("search_date"),
        F.to_date("flight_date").alias("flight_date"),
        F.lower("starting_airport").alias("start"),
        F.lower("destination_airport").alias("destination"),
    )
    return _with_rounded_fares(itinerary_search(wide_flights(raw), requests=requests))


def search_packed(spark: SparkSession, d: str) -> DataFrame:
    return _with_rounded_fares(packed_itineraries(stored(spark, d, "raw_itineraries")))


def cheapest(spark: SparkSession, d: str) -> DataFrame:
    return search(spark, d).limit(20)


def _monthly_requests(flights: DataFrame) -> DataFrame:
    """All routes that are flown, asked for the first day of each month."""
    days = F.sequence(F.lit(FIRST_MONTH).cast("date"), F.lit(LAST_MONTH).cast("date"),
                      F.expr("interval 1 month"))
    return (
        flights.select(
            F.col("departure_airport_code").alias("origin"),
            F.col("arrival_airport_code").alias("destination"),
        )
        .where("origin <> destination")
        .distinct()
        .select("*", F.explode(days).alias("flight_date"))
    )


def _one_transfer(spark: SparkSession, d: str) -> DataFrame:
    flights = stored(spark, d, "flights")
    requests = _monthly_requests(flights)
    return conn.one_transfer(flights, requests, same_day=False).drop("leg3")


def one_transfer(spark: SparkSession, d: str) -> DataFrame:
    return _with_rounded_fares(_one_transfer(spark, d))


def json_trips(spark: SparkSession, d: str) -> DataFrame:
    """Trips written as compressed JSON lines and read back."""
    trips = _one_transfer(spark, d)
    path = f"{scratch_root(spark)}/trips-{uuid.uuid4().hex[:8]}"
    write_json_lines(trips, path, compression="gzip")
    return _with_rounded_fares(spark.read.schema(trips.schema).json(path))


def two_transfers(spark: SparkSession, d: str) -> DataFrame:
    flights = stored(spark, d, "flights")
    requests = _monthly_requests(flights)
    return _with_rounded_fares(conn.two_transfers(flights, requests, same_day=False))


def _regional_requests(spark: SparkSession, d: str) -> DataFrame:
    """All routes between two nations of one region."""
    nation = given(spark, d, "nation")

    def code(n: str) -> Column:
        return F.concat(F.lit("A"), F.lpad(F.col(n).cast("string"), 2, "0"))

    a = nation.select(code("n_nationkey").alias("origin"), "n_regionkey")
    b = nation.select(code("n_nationkey").alias("destination"), "n_regionkey")
    return a.join(b, "n_regionkey").where("origin <> destination").drop("n_regionkey")


def connections(spark: SparkSession, d: str) -> DataFrame:
    return _with_rounded_fares(
        conn.connections(
            stored(spark, d, "flights"), _regional_requests(spark, d), same_day=False
        )
    )


_layouts: dict[tuple[str, str], FlightLayout] = {}


def _layout(spark: SparkSession, d: str) -> FlightLayout:
    """The flights stored for connection searches, once per application and folder."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _layouts:
        name = f"flights_{uuid.uuid4().hex[:8]}"
        path = f"{scratch_root(spark)}/{name}"
        _layouts[key] = store_layout(stored(spark, d, "flights"), name, path=path)
    return _layouts[key]


def _flown(flights: DataFrame, *more: str) -> DataFrame:
    return flights.select(
        F.col("departure_airport_code").alias("origin"),
        F.col("arrival_airport_code").alias("destination"),
        *more,
    )


def one_transfer_everywhere(spark: SparkSession, d: str) -> DataFrame:
    """Trips with one transfer on all flown routes, from the stored layout."""
    layout, requests = _layout(spark, d), _flown(stored(spark, d, "flights"))
    found = conn.one_transfer(layout, requests, same_day=False)
    return _with_rounded_fares(found.drop("leg3"))


def connections_everywhere(spark: SparkSession, d: str) -> DataFrame:
    """Ways with a transfer on every flown route and day, from the stored layout."""
    layout = _layout(spark, d)
    requests = _flown(stored(spark, d, "flights"), "flight_date")
    return _with_rounded_fares(conn.connections(layout, requests, same_day=False))


def connections_same_day(spark: SparkSession, d: str) -> DataFrame:
    """Ways with a transfer to replace each direct flight, on its own day."""
    flights = stored(spark, d, "flights")
    return _with_rounded_fares(conn.connections(flights, _flown(flights, "flight_date")))


def paths(spark: SparkSession, d: str) -> DataFrame:
    return stored(spark, d, "itinerary_details").select(
        "leg_id", clean_path(F.col("full_path")).alias("full_path")
    )


def features(spark: SparkSession, d: str) -> DataFrame:
    return _with_rounded_fares(_features(spark, d))


def label(spark: SparkSession, d: str) -> DataFrame:
    rows = materialize(_features(spark, d), "features")
    return _with_rounded_fares(best_time_label(rows))


def _route_fares(spark: SparkSession, d: str) -> DataFrame:
    return stored(spark, d, "flights").select(
        F.substring("departure_airport_code", 2, 2).cast("bigint").alias(
            "departure_airport_fk"
        ),
        F.substring("arrival_airport_code", 2, 2).cast("bigint").alias(
            "arrival_airport_fk"
        ),
        "total_fare",
    )


def route_rule(spark: SparkSession, d: str) -> DataFrame:
    rule = route_price_rule(_route_fares(spark, d))
    return rule.withColumn("best_buy_threshold", F.round("best_buy_threshold", 4))


def date_grid(spark: SparkSession, d: str) -> DataFrame:
    """The dates to predict as seen from each day on which a search was made."""
    raw = stored(spark, d, "raw_itineraries")
    days = raw.select(F.to_date("search_date").alias("as_of")).distinct()
    return days.select("as_of", F.explode(future_dates(F.col("as_of"))).alias("date"))


def scenarios(spark: SparkSession, d: str) -> DataFrame:
    return scenario_grid(route_price_rule(_route_fares(spark, d)), AS_OF)


def recommendations(spark: SparkSession, d: str) -> DataFrame:
    """A stand-in price that grows with the lead time, against the route rules."""
    rules = materialize(route_price_rule(_route_fares(spark, d)), "rules")
    grid = scenario_grid(rules, AS_OF, carry=["best_buy_threshold"])
    price = F.col("best_buy_threshold") * (950 + F.col("search_to_flight_days")) / 1000
    priced = grid.withColumn("prediction", price).drop("best_buy_threshold")
    return recommend(priced, rules)


def stitched(spark: SparkSession, d: str) -> DataFrame:
    report = stitched_share(segment_fact(stored(spark, d, "raw_itineraries")))
    return report.withColumn("stitched_share", F.round("stitched_share", 6))


def fare_error(spark: SparkSession, d: str) -> DataFrame:
    """Error of the mean fare of a route as a prediction, per origin."""
    fares = _route_fares(spark, d)
    route = ["departure_airport_fk", "arrival_airport_fk"]
    means = materialize(
        fares.groupBy(*route).agg(F.avg("total_fare").alias("mean_fare")), "means"
    )
    return (
        lookup_join(fares, means, route, "inner")
        .groupBy("departure_airport_fk")
        .agg(F.round(rmse(F.col("total_fare"), F.col("mean_fare")), 4).alias("rmse"))
    )


def _prepared(spark: SparkSession, d: str, stages: slice) -> DataFrame:
    """The features of the faulty rows, stored once, after some stages of the model."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _dirty_features:
        rows = _features(spark, d, "dirty_itineraries")
        _dirty_features[key] = materialize(rows, "dirty-features")
    rows = _dirty_features[key]
    return Pipeline(stages=feature_stages()[stages]).fit(rows).transform(rows)


def impute_mean(spark: SparkSession, d: str) -> DataFrame:
    return _prepared(spark, d, slice(0, 1)).select(
        "leg_id", *NUMERICAL, *[f"{c}_imputed" for c in NUMERICAL]
    )


def index_categories(spark: SparkSession, d: str) -> DataFrame:
    return _prepared(spark, d, slice(1, 2)).select(
        "leg_id", *[c for c in CATEGORICAL], *[f"{c}_index" for c in CATEGORICAL]
    )


def feature_vectors(spark: SparkSession, d: str) -> DataFrame:
    """Length of each feature vector and the places and values that are not 0."""
    rows = _prepared(spark, d, slice(None)).select(
        "leg_id", F.unwrap_udt("features").alias("v")
    )
    values = F.col("v.values")
    dense = F.col("v.type") == 1
    places = F.when(dense, F.sequence(F.lit(0), F.size(values) - 1)).otherwise(
        F.col("v.indices")
    )
    entries = F.zip_with(
        places,
        values,
        lambda i, v: F.when(
            v != 0, F.concat_ws(":", i.cast("string"), v.cast("int").cast("string"))
        ),
    )
    return rows.select(
        "leg_id",
        F.when(dense, F.size(values)).otherwise(F.col("v.size")).alias("size"),
        F.array_join(entries, " ").alias("entries"),
    )


def sample(spark: SparkSession, d: str) -> DataFrame:
    flights = stored(spark, d, "flights")
    rows = sample_rows(flights, 0.1, identity=["leg_id"])
    return rows.select("leg_id", two_decimals("total_fare"))


def split(spark: SparkSession, d: str) -> DataFrame:
    train, test = split_rows(stored(spark, d, "flights"), identity=["leg_id"])
    return (
        train.select("leg_id", F.lit("train").alias("part"))
        .unionAll(test.select("leg_id", F.lit("test").alias("part")))
    )


def train_score(spark: SparkSession, d: str) -> DataFrame:
    """Fit the model on the labelled fares, score all routes, and check what is fixed.

    Prices have no SQL form. That each is there and decides its recommendation, that the
    model read from disk and the one exported as an expression give the same ones, and
    that the error on the test rows is that of the exported one and below twice the
    spread of all fares (they are drawn at random), has one. ``q_stump`` and
    ``q_stump_score`` hold a model that has a SQL form against it.
    """
    rows = materialize(_features(spark, d), "features")
    trained = train_fare_model(rows, fraction=0.1)
    path = f"{scratch_root(spark)}/model-{uuid.uuid4().hex[:8]}"
    save_model(trained.model, path)
    rules = materialize(route_price_rule(rows), "rules")
    grid = scenario_grid(rules, AS_OF, carry=["best_buy_threshold"])
    exported = as_expression(trained.model, rows.schema)
    priced = load_model(path).transform(grid.withColumn("_exported", exported))
    off = F.abs(F.col("_exported") - F.col("prediction"))
    spread = rows.agg(F.stddev_pop("total_fare")).first()[0]
    error = trained.predictions.agg(rmse(F.col("total_fare"), exported)).first()[0]
    good = trained.rmse < 2 * spread and abs(error - trained.rmse) < 1e-6
    buy = F.round("predicted_fare", 2) <= F.col("best_buy_threshold")
    return recommend(
        priced.withColumn("_off", off), carry=["best_buy_threshold", "_off"]
    ).select(
        *ROUTE,
        "flight_date",
        (F.col("_off") < 1e-6).alias("same_when_loaded"),
        (
            (buy == (F.col("recommendation") == 1))
            | (F.abs(F.col("predicted_fare") - F.col("best_buy_threshold")) < 0.01)
        ).alias("follows_rule"),
        F.lit(bool(good)).alias("error_bounded"),
    )


# Columns with few different values, so that every split between two is tried.
STUMP_FEATURES = (
    "flight_day_of_week",
    "flight_month",
    "departure_airport_fk",
    "arrival_airport_fk",
)


def stump(spark: SparkSession, d: str) -> DataFrame:
    """One tree of depth 1 on the labelled fares: its split, its leaves and its error."""
    names = [*STUMP_FEATURES, "airline_fk", "aircraft_fk"]
    rows = materialize(_features(spark, d), "features")
    model = fit_numeric_trees(rows, names, maxIter=1, maxDepth=1)
    root, left, right = tree_table(model, spark).orderBy("node").collect()
    price = as_expression(model, rows.schema)
    return rows.agg(
        F.lit(root.feature).alias("feature"),
        F.lit(root.threshold).alias("threshold"),
        F.round(F.lit(left.value), 4).alias("left_mean"),
        F.round(F.lit(right.value), 4).alias("right_mean"),
        F.count(F.lit(1)).alias("fares"),
        F.round(rmse(F.col("total_fare").cast("double"), price), 4).alias("rmse"),
    )


def stump_score(spark: SparkSession, d: str) -> DataFrame:
    """All scenarios priced by a tree of depth 1, as an expression, with recommendations."""
    rows = materialize(_features(spark, d), "features")
    model = fit_numeric_trees(rows, STUMP_FEATURES, maxIter=1, maxDepth=1)
    rules = route_price_rule(rows)
    grid = scenario_grid(rules, AS_OF, carry=["best_buy_threshold"])
    return recommend(grid.withColumn("prediction", as_expression(model, grid.schema)))


def lookup_csv(spark: SparkSession, d: str) -> DataFrame:
    """Customers written as an airport file, with faults, then loaded and cleaned."""
    k = F.col("c_custkey")
    rows = given(spark, d, "customer").select(
        "c_mktsegment",
        F.when(k % 5 == 0, F.concat(F.lit('a "b"\n'), "c_name")).otherwise(F.col("c_name")),
        F.when(k % 7 == 0, F.lit("bad")).otherwise(F.col("c_acctbal").cast("string")),
        F.when(k % 11 != 0, k.cast("string")),
        F.when(k % 3 == 0, F.lit("NA")).otherwise(F.lit("DE")),
        F.lit("R, 1"),
        F.when(k % 2 == 0, F.concat(F.lit("City "), F.col("c_nationkey").cast("string"))),
        F.lit("not wanted"),
    )
    path = f"{scratch_root(spark)}/airports-{uuid.uuid4().hex[:8]}"
    named = rows.toDF(*AIRPORT_COLUMNS, "extra")
    named.write.option("header", True).option("escape", '"').csv(path)
    return airports_table(load_lookup_csv(spark, path, AIRPORT_COLUMNS))


def lookup_countries(spark: SparkSession, d: str) -> DataFrame:
    """Customers written as a file of codes and names, with empty rows, and cleaned.

    Its two columns have other names, and rows without a value in either are dropped.
    """
    k = F.col("c_custkey")
    rows = given(spark, d, "customer").select(
        F.when(k % 9 != 0, F.concat(F.lit("C"), k.cast("string"))).alias("Kod"),
        F.when(k % 6 != 0, F.concat(F.lit('of "'), "c_mktsegment", F.lit('",\n'), "c_name")).alias("Nazwa"),
    )
    path = f"{scratch_root(spark)}/countries-{uuid.uuid4().hex[:8]}"
    rows.write.option("header", True).option("escape", '"').csv(path)
    return countries_table(load_lookup_csv(spark, path))


def selects(spark: SparkSession, d: str) -> DataFrame:
    return stored(spark, d, "generated_queries").select(
        "id", extract_select(F.col("text")).alias("query")
    )


QUERIES = {
    "q_segments": segments,
    "q_segments_kept": segments_kept,
    "q_segment_fact": segment_facts,
    "q_wide": wide,
    "q_serving_segments": serving,
    "q_flights_view": flights_of_wide,
    "q_dim_airport": dim_airport,
    "q_dim_airline": dim_airline,
    "q_dim_aircraft": dim_aircraft,
    "q_dim_flight_details": dim_flight_details,
    "q_dim_date": dim_date,
    "q_dim_date_ranges": dim_date_ranges,
    "q_dimensions": dimensions_at_once,
    "q_star_fact": star,
    "q_lookup_normalized": lookup_normalized,
    "q_itinerary_fares": fares_per_itinerary,
    "q_partition_scan": partition_scan,
    "q_day_scan": day_scan,
    "q_days_scan": days_scan,
    "q_replace_days": replace_days,
    "q_itinerary_search": search,
    "q_itinerary_requests": search_requests,
    "q_search_partition": search_partition,
    "q_itinerary_twice": search_twice,
    "q_itinerary_packed": search_packed,
    "q_cheapest20": cheapest,
    "q_one_transfer": one_transfer,
    "q_json_trips": json_trips,
    "q_two_transfer": two_transfers,
    "q_connections": connections,
    "q_connections_same_day": connections_same_day,
    "q_one_transfer_all": one_transfer_everywhere,
    "q_connections_all": connections_everywhere,
    "q_clean_path": paths,
    "q_fare_features": features,
    "q_best_time_label": label,
    "q_route_rule": route_rule,
    "q_date_grid": date_grid,
    "q_scenarios": scenarios,
    "q_recommend": recommendations,
    "q_stitched_share": stitched,
    "q_rmse": fare_error,
    "q_impute_mean": impute_mean,
    "q_index_categories": index_categories,
    "q_feature_vectors": feature_vectors,
    "q_sample": sample,
    "q_split": split,
    "q_train_score": train_score,
    "q_stump": stump,
    "q_stump_score": stump_score,
    "q_lookup_csv": lookup_csv,
    "q_lookup_countries": lookup_countries,
    "q_extract_select": selects,
}
