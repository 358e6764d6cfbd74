"""The batch jobs, with every table name and setting as an argument."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from skyledger.functions import clean_path
from skyledger.operators import connections as conn
from skyledger.operators import dimensions as dims
from skyledger.operators.fact import FACT_PARTITIONS, star_fact
from skyledger.operators.features import best_time_label, fare_features, route_price_rule
from skyledger.operators.itineraries import itinerary_search, with_report_headings
from skyledger.operators.model import TrainedModel, load_model, save_model, train_fare_model
from skyledger.operators.scoring import ROUTE, recommend, scenario_grid
from skyledger.operators.segments import flights_view, segment_fact, wide_flights
from skyledger.sources.lookup_files import (
    airports_table,
    countries_table,
    load_lookup_csv,
)
from skyledger.sources.scratch import materialize, scratch_scope
from skyledger.sources.tables import (
    read_partition,
    read_table,
    replace_partitions,
    replace_table,
    write_json_lines,
)

SEGMENT_PARTITIONS = ("search_date", "flight_date")


def leaves_no_scratch(job: Callable) -> Callable:
    """A job whose results are tables or files: what it stored in between goes with it."""

    @wraps(job)
    def run(spark: SparkSession, *args: object, **options: object):
        with scratch_scope(spark):
            return job(spark, *args, **options)

    return run


@dataclass(frozen=True)
class WarehouseTables:
    dim_airport: str = "dim_airport"
    dim_airline: str = "dim_airline"
    dim_aircraft: str = "dim_aircraft"
    dim_flight_details: str = "dim_flight_details"
    dim_date: str = "dim_date"
    fact: str = "fact_flight_ticket"


@leaves_no_scratch
def build_warehouse(
    spark: SparkSession,
    raw_itineraries: str,
    raw_airports: str,
    tables: WarehouseTables = WarehouseTables(),
    stable_keys: bool = False,
) -> DataFrame:
    """Rebuild the five dimensions, then the ticket fact on the stored keys.

    Any failure stops the job: a fact is never built on a stale dimension.
    """
    raw = read_table(spark, raw_itineraries, refresh=True)
    airports = read_table(spark, raw_airports, refresh=True)
    built = dims.build_dimensions(raw, airports, stable_keys)
    stored = dims.Dimensions(
        airport=replace_table(built.airport, tables.dim_airport),
        airline=replace_table(built.airline, tables.dim_airline),
        aircraft=replace_table(built.aircraft, tables.dim_aircraft),
        flight_details=replace_table(built.flight_details, tables.dim_flight_details),
        date=replace_table(built.date, tables.dim_date),
    )
    # Stored first: the layout by days reads it twice.
    fact = materialize(star_fact(raw, stored), "fact-rows")
    return replace_table(fact, tables.fact, FACT_PARTITIONS)


@leaves_no_scratch
def build_segment_fact(spark: SparkSession, raw: str, target: str) -> DataFrame:
    return replace_table(segment_fact(read_table(spark, raw)), target, SEGMENT_PARTITIONS)


@leaves_no_scratch
def build_wide_flights(spark: SparkSession, raw: str, target: str) -> DataFrame:
    return replace_table(wide_flights(read_table(spark, raw)), target, SEGMENT_PARTITIONS)


@leaves_no_scratch
def find_connections(
    spark: SparkSession,
    wide: str,
    requests: DataFrame,
    output_path: str,
    **options: object,
) -> None:
    """Answer a table of requests from the wide table; trips go out as JSON lines."""
    flights = flights_view(read_table(spark, wide))
    write_json_lines(conn.connections(flights, requests, **options), output_path)


def report_itineraries(
    spark: SparkSession,
    root: str,
    schema: T.StructType,
    search_date: str | dt.date,
    flight_date: str | dt.date,
    start: str,
    destination: str,
) -> DataFrame:
    """Itineraries of one search on one day, cheapest first, with report headings.

    Reads the one folder of the stored wide table at ``root``; no rows if it is missing.
    """
    days = {
        name: day if isinstance(day, dt.date) else dt.date.fromisoformat(day)
        for name, day in (("search_date", search_date), ("flight_date", flight_date))
    }
    rows = read_partition(spark, root, schema, **days)
    found = itinerary_search(rows, start=start, destination=destination)
    return with_report_headings(found)


@leaves_no_scratch
def import_lookups(
    spark: SparkSession,
    airports_csv: str,
    countries_csv: str,
    airports: str,
    countries: str,
    encoding: str = "UTF-8",
    fallback_encoding: str | None = None,
) -> None:
    """Load, clean and store both reference files as tables."""
    for path, clean, target in (
        (airports_csv, airports_table, airports),
        (countries_csv, countries_table, countries),
    ):
        loaded = load_lookup_csv(spark, path, None, encoding, fallback_encoding)
        replace_table(clean(loaded), target)


@leaves_no_scratch
def clean_itinerary_paths(
    spark: SparkSession,
    source: str,
    target: str,
    partition_by: tuple[str, ...],
    column: str = "full_path",
) -> None:
    """Clean the paths of ``source`` into those partitions of ``target`` it covers."""
    df = read_table(spark, source)
    replace_partitions(df.withColumn(column, clean_path(df[column])), target, partition_by)


@leaves_no_scratch
def build_training_table(
    spark: SparkSession, fact: str, dim_date: str, target: str
) -> DataFrame:
    features = fare_features(read_table(spark, fact), read_table(spark, dim_date))
    return replace_table(best_time_label(materialize(features, "features")), target)


@leaves_no_scratch
def build_price_rules(spark: SparkSession, fact: str, target: str) -> DataFrame:
    return replace_table(route_price_rule(read_table(spark, fact)), target)


def train(
    spark: SparkSession, training_table: str, model_path: str, **options: object
) -> TrainedModel:
    trained = train_fare_model(read_table(spark, training_table), **options)
    save_model(trained.model, model_path)
    return trained


@leaves_no_scratch
def score(
    spark: SparkSession,
    rules_table: str,
    model_path: str,
    target: str,
    as_of: str | dt.date,
) -> DataFrame:
    """Predict all routes of the rule table and store the recommendations."""
    rules = read_table(spark, rules_table)
    scenarios = scenario_grid(rules.select(*ROUTE), as_of)
    predictions = load_model(model_path).transform(scenarios)
    return replace_table(recommend(predictions, rules), target)
