"""Dimension tables of the star schema.

Each dimension has one row per normalised code, so a lookup never multiplies
fact rows, and keys from 1 on in the order of that code.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions import (
    date_parts,
    lookup_key,
    not_blank,
    strip,
    to_bool,
    to_date,
    unquote,
)
from skyledger.operators.keys import assert_unique, dense_key, natural_key
from skyledger.operators.segments import explode_segments, unpack
from skyledger.sources.scratch import materialize

FLIGHT_DETAILS = (
    "fare_basis_code",
    "segments_cabin_code",
    "is_basic_economy",
    "is_refundable",
)
# Text columns of a member of any dimension; short ones end in NULL.
_VALUES = ("_v0", "_v1", "_v2", "_v3")


@dataclass(frozen=True)
class Dimensions:
    airport: DataFrame
    airline: DataFrame
    aircraft: DataFrame
    flight_details: DataFrame
    date: DataFrame


def _keyed(members: DataFrame, by: Sequence[str], name: str, stable: bool) -> DataFrame:
    """Members are stored before they are keyed, so keys are given once."""
    members = materialize(members, name)
    if stable:
        return assert_unique(natural_key(members, by, name), [name], f"hashes of {by}")
    return dense_key(members, by, name)


def build_dim(
    df: DataFrame,
    columns: Sequence[str],
    code: str,
    key_name: str,
    stable: bool = False,
) -> DataFrame:
    """One row per normalised ``code``; of several spellings the smallest row stays.

    ``stable`` keys are hashes of the code and survive the arrival of new members;
    the default are dense ranks.
    """
    attributes = [c for c in columns if c != code]
    # Spellings are few: hashed first, so that only they are sorted.
    spellings = df.select(lookup_key(F.col(code)).alias("_code"), *columns).distinct()
    members = (
        spellings.groupBy("_code")
        .agg(F.min(F.struct(code, *attributes)).alias("_row"))
        .select("_code", *[F.col(f"_row.{c}").alias(c) for c in columns])
    )
    return _keyed(members, ["_code"], key_name, stable).select(*columns, key_name)


def dim_airport(raw_airports: DataFrame, stable: bool = False) -> DataFrame:
    """Quotes come off before the blank check, so ``""`` is not an airport."""
    rows = raw_airports.select(
        "ident",
        strip(unquote(F.col("iata_code"))).alias("iata_code"),
        F.col("name").alias("airport_name"),
        F.col("municipality").alias("city"),
        F.col("iso_country").alias("country_code"),
    ).where(not_blank(F.col("iata_code")))
    return build_dim(rows, rows.columns, "iata_code", "airport_fk", stable)


def dim_aircraft(raw: DataFrame, packed: bool = False, stable: bool = False) -> DataFrame:
    """Aircraft of all segments; ``packed`` keeps whole packed strings as members."""
    source = "segments_equipment_description"
    if packed:
        rows = raw.select(F.col(source).alias("equipment_description"))
    else:
        rows = explode_segments(
            raw, {"equipment_description": source}, with_index=False
        )
    rows = rows.where(not_blank(F.col("equipment_description")))
    return build_dim(
        rows, rows.columns, "equipment_description", "aircraft_fk", stable
    )


def dim_airline(raw: DataFrame, packed: bool = False, stable: bool = False) -> DataFrame:
    """Airlines of all segments; ``packed`` keeps whole packed strings as members."""
    source = {
        "airline_code": "segments_airline_code",
        "airline_name": "segments_airline_name",
    }
    if packed:
        rows = raw.select(*[F.col(v).alias(k) for k, v in source.items()])
    else:
        rows = explode_segments(raw, source, on_null="keep", with_index=False)
    rows = rows.where(not_blank(F.col("airline_code")))
    return build_dim(rows, rows.columns, "airline_code", "airline_fk", stable)


def dim_flight_details(raw: DataFrame, stable: bool = False) -> DataFrame:
    """Fare products: distinct fare basis, packed cabins and the two flags."""
    members = (
        raw.select(
            "fare_basis_code",
            "segments_cabin_code",
            to_bool(F.col("is_basic_economy")).alias("is_basic_economy"),
            to_bool(F.col("is_refundable")).alias("is_refundable"),
        )
        .dropna(subset=list(FLIGHT_DETAILS))
        .distinct()
    )
    return _keyed(members, FLIGHT_DETAILS, "flight_details_fk", stable)


def dim_date(raw: DataFrame, stable: bool = False) -> DataFrame:
    """All search and flight dates, both taken from one scan."""
    members = (
        raw.select(
            F.explode(
                F.array(to_date(F.col("search_date")), to_date(F.col("flight_date")))
            ).alias("full_date")
        )
        .where(F.col("full_date").isNotNull())
        .distinct()
    )
    parts = members.select("full_date", *date_parts(F.col("full_date")))
    return _keyed(parts, ["full_date"], "date_fk", stable)


def tagged_members(raw: DataFrame) -> DataFrame:
    """The different members of all dimensions of the raw table, from one scan.

    ``dimension`` names what ``values`` is a member of: an airline's code and name, an
    aircraft's description, the four columns of a fare product, or a date, as text. The
    packed lists are unpacked side by side and the members of each segment dealt out as
    flat text columns, which stays in generated code; one hash aggregate makes them
    distinct. An itinerary's own members go with its first segment.
    """
    lists = F.arrays_zip(
        unpack(F.col("segments_equipment_description"), "keep").alias("aircraft"),
        unpack(F.col("segments_airline_code"), "keep").alias("code"),
        unpack(F.col("segments_airline_name"), "keep").alias("name"),
    )
    segments = raw.select(
        "fare_basis_code",
        "segments_cabin_code",
        to_bool(F.col("is_basic_economy")).cast("string").alias("is_basic_economy"),
        to_bool(F.col("is_refundable")).cast("string").alias("is_refundable"),
        to_date(F.col("search_date")).cast("string").alias("search_date"),
        to_date(F.col("flight_date")).cast("string").alias("flight_date"),
        F.posexplode_outer(lists).alias("_pos", "_seg"),
    )
    leads = F.coalesce(F.col("_pos"), F.lit(0)) == 0
    details = leads & reduce(lambda x, y: x & y, [F.col(c).isNotNull() for c in FLIGHT_DETAILS])

    def member(dimension: str, there: Column, *values: Column) -> Column:
        padded = [*values, *[F.lit(None).cast("string")] * (len(_VALUES) - len(values))]
        named = [v.alias(c) for c, v in zip(_VALUES, padded)]
        return F.struct(F.when(there, F.lit(dimension)).alias("dimension"), *named)

    aircraft, code = F.col("_seg.aircraft"), F.col("_seg.code")
    found = F.array(
        member("aircraft", not_blank(aircraft), aircraft),
        member("airline", not_blank(code), code, F.col("_seg.name")),
        member("flight_details", details, *[F.col(c) for c in FLIGHT_DETAILS]),
        *[
            member("date", leads & F.col(c).isNotNull(), F.col(c))
            for c in ("search_date", "flight_date")
        ],
    )
    flat = (
        segments.select(F.explode(found).alias("m"))
        .select("m.dimension", *[f"m.{c}" for c in _VALUES])
        .where(F.col("dimension").isNotNull())
        .distinct()
    )
    return flat.select("dimension", F.array(*_VALUES).alias("values"))


def _of(members: DataFrame, dimension: str, *columns: Column | str) -> DataFrame:
    """The members of one dimension, its texts as columns."""
    return members.where(F.col("dimension") == dimension).select(
        *[
            (F.col("values")[i].alias(c) if isinstance(c, str) else c)
            for i, c in enumerate(columns)
        ]
    )


def _stored(name: str, build: Callable[[], DataFrame]) -> DataFrame:
    return materialize(build(), f"dim-{name}")


def build_dimensions(
    raw: DataFrame, raw_airports: DataFrame, stable: bool = False
) -> Dimensions:
    """All five, stored with their keys; the raw table is read once.

    Its members are stored first; the dimensions are then built side by side.
    """
    members = materialize(tagged_members(raw), "dim-members")
    details = [
        F.col("values")[i].cast("boolean" if c.startswith("is_") else "string").alias(c)
        for i, c in enumerate(FLIGHT_DETAILS)
    ]
    airlines = _of(members, "airline", "airline_code", "airline_name")
    aircraft = _of(members, "aircraft", "equipment_description")
    days = _of(members, "date", F.col("values")[0].cast("date").alias("full_date"))
    jobs = {
        "airport": lambda: dim_airport(raw_airports, stable),
        "airline": lambda: build_dim(
            airlines, airlines.columns, "airline_code", "airline_fk", stable
        ),
        "aircraft": lambda: build_dim(
            aircraft, aircraft.columns, "equipment_description", "aircraft_fk", stable
        ),
        "flight_details": lambda: _keyed(
            _of(members, "flight_details", *details), FLIGHT_DETAILS, "flight_details_fk", stable
        ),
        "date": lambda: _keyed(
            days.select("full_date", *date_parts(F.col("full_date"))),
            ["full_date"],
            "date_fk",
            stable,
        ),
    }
    store = inheritable_thread_target(raw.sparkSession)(_stored)
    with ThreadPoolExecutor(len(jobs)) as pool:
        built = {name: pool.submit(store, name, job) for name, job in jobs.items()}
        return Dimensions(**{name: b.result() for name, b in built.items()})
