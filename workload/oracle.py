"""The same results as SQL on the given tables, written for DuckDB.

Works on lineitems directly: nothing here packs or unpacks a list, so packing
in Spark is checked against data that never was packed.
"""

from __future__ import annotations

from workload.queries import AS_OF, SCAN_DAY, SEARCH_DAY

_LINES = """
lines AS (
  SELECT l.*, s_nationkey AS from_nation, c_nationkey AS to_nation, p_brand, p_type,
         'B' || regexp_replace(p_brand, '\\D', '', 'g') AS code,
         CAST(l_quantity AS INTEGER) * 300 + 1800 AS secs,
         CASE l_returnflag WHEN 'A' THEN 'coach' WHEN 'N' THEN 'business'
              ELSE 'first' END AS cabin,
         o_orderpriority, o_orderstatus, CAST(o_orderdate AS DATE) AS order_day,
         CAST(round(o_totalprice * 100) AS BIGINT) AS price_cents
  FROM lineitem l
  JOIN supplier ON s_suppkey = l_suppkey
  JOIN part ON p_partkey = l_partkey
  JOIN orders ON o_orderkey = l_orderkey
  JOIN customer ON c_custkey = o_custkey
)"""

_SEG = (
    _LINES
    + """,
ordered AS (
  SELECT *, row_number() OVER w AS i, count(*) OVER (PARTITION BY l_orderkey) AS n,
         coalesce(lead(from_nation) OVER w, to_nation) AS next_nation,
         first_value(from_nation) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING
                                        AND UNBOUNDED FOLLOWING) AS start_nation,
         coalesce(sum(secs + 3600 + (l_partkey % 600) * 60)
                  OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS elapsed,
         order_day + CAST(l_orderkey % 180 + 1 AS INTEGER) AS flight_day,
         string_agg(cabin, '||') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING
                                       AND UNBOUNDED FOLLOWING) AS cabins
  FROM lines
  WINDOW w AS (PARTITION BY l_orderkey
               ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice)
),
seg AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS leg_id, l_orderkey AS k,
         CAST(i AS INTEGER) AS segment_index, CAST(n AS INTEGER) AS total_segments,
         'A' || lpad(CAST(from_nation AS VARCHAR), 2, '0') AS dep,
         'A' || lpad(CAST(next_nation AS VARCHAR), 2, '0') AS arr,
         'A' || lpad(CAST(start_nation AS VARCHAR), 2, '0') AS origin,
         'A' || lpad(CAST(to_nation AS VARCHAR), 2, '0') AS destination,
         p_brand AS airline, code, p_type AS equipment, secs, cabin, cabins,
         CAST(l_quantity AS INTEGER) * 50 AS miles,
         order_day AS search_date, CAST(flight_day AS DATE) AS flight_date,
         CAST(CAST(epoch(flight_day) AS BIGINT) + 21600 + elapsed AS BIGINT) AS departs,
         CAST(CAST(epoch(flight_day) AS BIGINT) + 21600 + elapsed + secs AS BIGINT)
           AS arrives,
         CAST(CAST(price_cents // 100 AS VARCHAR) || '.'
              || lpad(CAST(price_cents % 100 AS VARCHAR), 2, '0') AS FLOAT) AS fare,
         CAST(CAST((price_cents * 9 + 5) // 10 // 100 AS VARCHAR) || '.'
              || lpad(CAST((price_cents * 9 + 5) // 10 % 100 AS VARCHAR), 2, '0')
              AS FLOAT) AS base,
         left(o_orderpriority, 1) || o_orderstatus AS basis,
         left(o_orderpriority, 1) = '5' AS basic, o_orderstatus = 'F' AS refundable,
         n = 1 AS non_stop
  FROM ordered
)"""
)

_FLIGHTS = """
flights AS (
  SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-'
           || CAST(round(l_extendedprice * 100) AS BIGINT) AS leg_id,
         'A' || lpad(CAST(s_nationkey AS VARCHAR), 2, '0') AS dep,
         'A' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS arr,
         CAST(s_nationkey AS BIGINT) AS dep_fk, CAST(c_nationkey AS BIGINT) AS arr_fk,
         CAST(epoch(CAST(l_shipdate AS DATE)) AS BIGINT)
           + (l_partkey * 37 + l_linenumber * 101 + l_orderkey * 13) % 1440 * 60 AS departs,
         CAST(60 + l_quantity * 10 AS INTEGER) AS minutes,
         l_extendedprice AS fare, CAST(l_shipdate AS DATE) AS day
  FROM lineitem
  JOIN supplier ON s_suppkey = l_suppkey
  JOIN orders ON o_orderkey = l_orderkey
  JOIN customer ON c_custkey = o_custkey
),
legs AS (SELECT *, departs + minutes * 60 AS arrives FROM flights WHERE dep <> arr)"""

# Raw airports with the faulty rows, cleaned; one row per upper-case code.
_AIRPORTS = """
codes AS (
  SELECT 'KA' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS ident,
         'A' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS iata_code,
         n_name AS airport_name, 'City ' || n_nationkey AS city,
         'R' || n_regionkey AS country_code
  FROM nation
  UNION ALL
  SELECT 'X' || r_regionkey, CASE r_regionkey WHEN 3 THEN 'a03' ELSE 'A04' END, r_name,
         NULL, 'R' || r_regionkey
  FROM region WHERE r_regionkey > 2
),
airports AS (
  SELECT ident, iata_code, airport_name, city, country_code,
         row_number() OVER (ORDER BY upper(iata_code)) AS airport_fk
  FROM (SELECT *, row_number() OVER (PARTITION BY upper(iata_code)
                                     ORDER BY iata_code, ident) AS pick FROM codes)
  WHERE pick = 1
)"""


def _rank(table: str, key: str, source: str, condition: str = "true") -> str:
    return f"""
{table} AS (
  SELECT {key}, row_number() OVER (ORDER BY {key}) AS fk
  FROM (SELECT DISTINCT {key} FROM {source} WHERE {condition})
)"""


_DETAIL_KEY = "basis, cabins, basic, refundable"


def _dates(search: str, source: str = "seg") -> str:
    return f"""
dates AS (
  SELECT full_date, row_number() OVER (ORDER BY full_date) AS fk
  FROM (SELECT {search} AS full_date FROM {source} UNION SELECT flight_date FROM {source})
  WHERE full_date IS NOT NULL
)"""


def _dims(search: str = "search_date", refundable: str = "true") -> str:
    return ",".join(
        [
            _AIRPORTS,
            _rank("airlines", "code", "seg"),
            _rank("aircraft", "equipment", "seg"),
            _rank("details", _DETAIL_KEY, "seg", refundable),
            _dates(search),
        ]
    )


_FACT_COLUMNS = """
  coalesce(sd.fk, 0) AS search_date_fk, coalesce(fd.fk, 0) AS flight_date_fk,
  coalesce(al.fk, 0) AS airline_fk, coalesce(da.airport_fk, 0) AS departure_airport_fk,
  coalesce(aa.airport_fk, 0) AS arrival_airport_fk, coalesce(ac.fk, 0) AS aircraft_fk,
  coalesce(de.fk, 0) AS flight_details_fk, leg_id,
  round(CAST(base AS DOUBLE), 2) AS base_fare, round(CAST(fare AS DOUBLE), 2) AS total_fare
"""


def _lookups(search: str = "s.search_date", refundable: str = "s.refundable") -> str:
    return f"""
  LEFT JOIN dates sd ON sd.full_date = {search}
  LEFT JOIN dates fd ON fd.full_date = s.flight_date
  LEFT JOIN airlines al ON al.code = s.code
  LEFT JOIN airports da ON upper(da.iata_code) = s.dep
  LEFT JOIN airports aa ON upper(aa.iata_code) = s.arr
  LEFT JOIN aircraft ac ON ac.equipment = s.equipment
  LEFT JOIN details de ON de.basis = s.basis AND de.cabins = s.cabins
                      AND de.basic = s.basic AND de.refundable = {refundable}"""


_MEASURES = """,
  CAST(year(flight_date) AS INTEGER) AS year, CAST(month(flight_date) AS INTEGER) AS month,
  CAST(day(flight_date) AS INTEGER) AS day, miles AS total_travel_distance"""

_STAR = f"""
star AS (
  SELECT {_FACT_COLUMNS} {_MEASURES}, CAST(k % 10 AS INTEGER) AS seats_remaining,
    CAST(trunc(secs / 60.0) AS INTEGER) AS total_duration_in_minutes,
    CAST(flight_date - search_date AS INTEGER) AS search_to_flight_days
  FROM seg s {_lookups()}
)"""

_SEARCH = """
found AS (
  SELECT search_date, flight_date, leg_id, min(fare) AS fare, min(base) AS base,
         any_value(origin) AS origin, any_value(destination) AS destination,
         bool_or(refundable) AS refundable,
         string_agg(dep, ' -> ' ORDER BY segment_index) || ' -> '
           || any_value(destination) AS full_path,
         CAST(trunc(sum(secs) / 60.0) AS INTEGER) AS total_flight_minutes,
         string_agg(strftime(make_timestamp(departs * 1000000), '%Y-%m-%d %H:%M:%S')
           || ' -- ' || strftime(make_timestamp(arrives * 1000000), '%Y-%m-%d %H:%M:%S'),
           ' | ' ORDER BY segment_index) AS timeline
  FROM seg WHERE NOT non_stop GROUP BY ALL
)"""
_SEARCH = _SEARCH.replace("GROUP BY ALL", "GROUP BY search_date, flight_date, leg_id")

_FOUND_COLUMNS = """search_date, flight_date, leg_id,
  round(CAST(fare AS DOUBLE), 2) AS total_fare, full_path, total_flight_minutes, timeline"""

_ONE = """
one AS (
  SELECT '1-transfer' AS route_type, a.dep AS origin, b.arr AS destination,
         a.day AS flight_date, a.leg_id AS leg1, b.leg_id AS leg2,
         CAST(NULL AS VARCHAR) AS leg3, round(a.fare + b.fare, 2) AS total_fare,
         a.minutes + b.minutes AS total_duration, a.day AS day1, b.day AS day2,
         b.day AS day3
  FROM legs a JOIN legs b ON a.arr = b.dep {same1}
   AND b.departs - a.arrives BETWEEN 2700 AND 43200
  WHERE a.dep <> b.arr
)"""

_TWO = """
two AS (
  SELECT '2-transfer' AS route_type, a.dep AS origin, c.arr AS destination,
         a.day AS flight_date, a.leg_id AS leg1, b.leg_id AS leg2, c.leg_id AS leg3,
         round(a.fare + b.fare + c.fare, 2) AS total_fare,
         a.minutes + b.minutes + c.minutes AS total_duration, a.day AS day1,
         b.day AS day2, c.day AS day3
  FROM legs a
  JOIN legs b ON a.arr = b.dep {same1} AND b.departs - a.arrives BETWEEN 2700 AND 43200
  JOIN legs c ON b.arr = c.dep {same2} AND c.departs - b.arrives BETWEEN 2700 AND 43200
  WHERE a.dep <> b.arr AND a.dep <> c.arr AND a.arr <> c.arr
)"""

_TRIP = """route_type, origin, destination, flight_date, leg1, leg2, leg3, total_fare,
  total_duration"""


# Requests for all routes that are flown on the first day of each month.
_MONTHLY = """day(flight_date) = 1 AND year(flight_date) BETWEEN 1992 AND 1998
  AND (origin, destination) IN (SELECT (dep, arr) FROM flights)"""


def _trips(same_day: bool) -> str:
    same = ("AND a.day = b.day", "AND b.day = c.day") if same_day else ("", "")
    return (
        f"{_FLIGHTS},{_ONE},{_TWO}".replace("{same1}", same[0]).replace("{same2}", same[1])
    )


# One-segment fare rows and the keys of their own dimensions.
_FARES = (
    _LINES
    + ""","""
    + """
seg AS (
  SELECT CAST(l_partkey AS VARCHAR) AS leg_id, code, p_type AS equipment,
         'A' || lpad(CAST(from_nation AS VARCHAR), 2, '0') AS dep,
         'A' || lpad(CAST(to_nation AS VARCHAR), 2, '0') AS arr,
         CAST(l_shipdate AS DATE) AS search_date,
         CAST(CAST(l_shipdate AS DATE) + CAST(l_orderkey % 180 + 1 AS INTEGER) AS DATE)
           AS flight_date,
         CAST(l_orderkey % 180 + 1 AS INTEGER) AS lead_days,
         CAST(CAST(CAST(round(l_extendedprice * 100) AS BIGINT) // 100 AS VARCHAR) || '.'
           || lpad(CAST(CAST(round(l_extendedprice * 100) AS BIGINT) % 100 AS VARCHAR), 2,
                   '0') AS FLOAT) AS fare
  FROM lines
),"""
    + ",".join(
        [
            _AIRPORTS,
            _rank("airlines", "code", "seg"),
            _rank("aircraft", "equipment", "seg"),
        ]
    )
)

_FEATURES = """
  leg_id, {fare} AS total_fare, {lead} AS search_to_flight_days,
  da.airport_fk AS departure_airport_fk, aa.airport_fk AS arrival_airport_fk,
  al.fk AS airline_fk, ac.fk AS aircraft_fk,
  CAST(dayofweek(flight_date) + 1 AS INTEGER) AS flight_day_of_week,
  CAST(month(flight_date) AS INTEGER) AS flight_month,
  CAST(weekofyear(flight_date) AS INTEGER) AS flight_week_of_year
"""
_FEATURE_JOINS = """
  JOIN airlines al ON al.code = s.code
  JOIN airports da ON upper(da.iata_code) = s.dep
  JOIN airports aa ON upper(aa.iata_code) = s.arr
  JOIN aircraft ac ON ac.equipment = s.equipment"""

_FARE_FEATURES = f"""
features AS (
  SELECT {_FEATURES.format(fare="fare", lead="lead_days")} FROM seg s {_FEATURE_JOINS}
)"""
_FEATURE_NAMES = """leg_id, round(CAST(total_fare AS DOUBLE), 2) AS total_fare,
  search_to_flight_days, departure_airport_fk, arrival_airport_fk, airline_fk,
  aircraft_fk, flight_day_of_week, flight_month, flight_week_of_year"""

# Features of the faulty itineraries: search date missing for every 79th, all
# segments of every 97th dropped; the faults change no key of these features.
_DIRTY_LEAD = "CASE WHEN k % 79 = 0 THEN NULL ELSE CAST(flight_date - search_date AS INTEGER) END"
_DIRTY_FEATURES = (
    _SEG
    + ","
    + ",".join(
        [
            _AIRPORTS,
            _rank("airlines", "code", "seg"),
            _rank("aircraft", "equipment", "seg", "k % 97 <> 0"),
        ]
    )
    + f""",
features AS (
  SELECT {_FEATURES.format(fare="fare", lead=_DIRTY_LEAD)}
  FROM seg s {_FEATURE_JOINS} WHERE k % 97 <> 0
)"""
)

_CATEGORIES = (
    "departure_airport_fk",
    "arrival_airport_fk",
    "airline_fk",
    "aircraft_fk",
    "flight_day_of_week",
    "flight_month",
)
_INDEXES = "".join(
    f""",
ix_{c} AS (
  SELECT v, CAST(row_number() OVER (ORDER BY n DESC, CAST(v AS VARCHAR)) - 1 AS DOUBLE) AS ix,
         count(*) OVER () AS labels
  FROM (SELECT {c} AS v, count(*) AS n FROM features GROUP BY {c})
)"""
    for c in _CATEGORIES
)
_INDEX_JOINS = " ".join(f"JOIN ix_{c} ON ix_{c}.v = {c}" for c in _CATEGORIES)
_MEANS = """,
means AS (
  SELECT CAST(trunc(avg(search_to_flight_days)) AS INTEGER) AS lead_mean FROM features
)"""
_OFFSETS = []
_before = "0"
for _c in _CATEGORIES:
    _OFFSETS.append(f"CAST({_before} + ix_{_c}.ix AS BIGINT) || ':1'")
    _before += f" + ix_{_c}.labels"


def _stump(names: tuple[str, ...]) -> str:
    """The split of one column between two of its values that lowers the variance most."""
    values = " UNION ALL ".join(
        f"SELECT '{n}' AS feature, CAST({n} AS DOUBLE) AS v, CAST(total_fare AS DOUBLE) AS y FROM features"
        for n in names
    )
    return f""",
vals AS ({values}),
grouped AS (SELECT feature, v, count(*) AS n, sum(y) AS s FROM vals GROUP BY feature, v),
sides AS (
  SELECT feature, (v + lead(v) OVER w) / 2 AS threshold, sum(n) OVER w AS ln, sum(s) OVER w AS ls,
         sum(n) OVER (PARTITION BY feature) AS tn, sum(s) OVER (PARTITION BY feature) AS ts
  FROM grouped WINDOW w AS (PARTITION BY feature ORDER BY v)
),
split AS (
  SELECT feature, threshold, ls / ln AS left_mean, (ts - ls) / (tn - ln) AS right_mean, tn
  FROM sides WHERE threshold IS NOT NULL
  ORDER BY ls * ls / ln + (ts - ls) * (ts - ls) / (tn - ln) DESC LIMIT 1
)"""


def _stump_value(names: tuple[str, ...]) -> str:
    return "CASE feature " + " ".join(f"WHEN '{n}' THEN {n}" for n in names) + " END"


_STUMP = ("flight_day_of_week", "flight_month", "departure_airport_fk", "arrival_airport_fk")
_STUMP_ALL = (*_STUMP, "airline_fk", "aircraft_fk")


def _hash_share(column: str) -> str:
    return f"(('0x' || substr(md5('42|' || {column}), 1, 8))::BIGINT / 4294967296.0)"


ORACLE = {
    "q_segments": f"""WITH {_SEG}
SELECT leg_id, total_segments, segment_index, dep AS departure_airport,
  arr AS arrival_airport, airline AS airline_name, equipment,
  CAST(secs AS VARCHAR) AS seconds FROM seg""",
    "q_segments_kept": f"""WITH {_SEG}
SELECT leg_id, segment_index, dep AS departure_airport,
  CASE WHEN k % 97 <> 0 THEN equipment END AS equipment,
  CASE WHEN k % 89 = 0 AND segment_index = total_segments
       THEN CASE WHEN total_segments = 1 THEN '' END
       ELSE CAST(secs AS VARCHAR) END AS seconds FROM seg""",
    "q_segment_fact": f"""WITH {_SEG}
SELECT search_date, flight_date, leg_id, segment_index, dep AS segment_departure_airport,
  arr AS segment_arrival_airport, airline AS segment_airline_name,
  secs AS segment_duration_seconds, miles AS segment_distance, cabin AS segment_cabin_code,
  equipment AS segment_equipment_description, round(CAST(fare AS DOUBLE), 2) AS total_fare,
  non_stop AS is_non_stop, total_segments, origin AS journey_start_airport,
  destination AS journey_final_destination FROM seg""",
    "q_wide": f"""WITH {_SEG}
SELECT search_date, flight_date, leg_id, segment_index, origin AS journey_start_airport,
  destination AS journey_final_destination, round(CAST(fare AS DOUBLE), 2) AS total_fare,
  non_stop AS is_non_stop, total_segments, dep AS segment_departure_airport,
  arr AS segment_arrival_airport, airline AS segment_airline_name,
  secs AS segment_duration_seconds,
  strftime(make_timestamp(departs * 1000000), '%Y-%m-%d %H:%M:%S')
    AS segment_departure_time_raw,
  strftime(make_timestamp(arrives * 1000000), '%Y-%m-%d %H:%M:%S')
    AS segment_arrival_time_raw,
  departs AS segment_departure_epoch, arrives AS segment_arrival_epoch FROM seg""",
    "q_serving_segments": f"""WITH {_SEG}
SELECT DISTINCT leg_id, total_segments, CASE WHEN non_stop THEN '1' ELSE '0' END
  AS is_non_stop, search_date FROM seg""",
    "q_flights_view": f"""WITH {_SEG}
SELECT leg_id, dep AS departure_airport_code, arr AS arrival_airport_code,
  departs AS departure_epoch, arrives AS arrival_epoch,
  round(CAST(fare AS DOUBLE), 2) AS total_fare,
  CAST(trunc(secs / 60.0) AS INTEGER) AS total_duration_in_minutes, flight_date, search_date FROM seg""",
    "q_dim_airport": f"WITH {_AIRPORTS} SELECT * FROM airports",
    "q_dim_airline": f"""WITH {_SEG}
SELECT airline_code, airline_name, row_number() OVER (ORDER BY code) AS airline_fk
FROM (
  SELECT code, CASE WHEN k % 83 = 0 THEN ' ' || lower(code) || ' ' ELSE code END
           AS airline_code, airline AS airline_name,
         row_number() OVER (PARTITION BY code ORDER BY airline_code, airline) AS pick
  FROM seg
) WHERE pick = 1""",
    "q_dim_aircraft": f"""WITH {_SEG},{_rank("aircraft", "equipment", "seg")}
SELECT equipment AS equipment_description, fk AS aircraft_fk FROM aircraft""",
    "q_dim_flight_details": f"""WITH {_SEG},{
        _rank("details", _DETAIL_KEY, "seg", "k % 71 <> 0")}
SELECT basis AS fare_basis_code, cabins AS segments_cabin_code, basic AS is_basic_economy,
  refundable AS is_refundable, fk AS flight_details_fk FROM details""",
    "q_dim_date": f"""WITH {_SEG},{
        _dates("CASE WHEN k % 79 <> 0 THEN search_date END")}
SELECT full_date, CAST(year(full_date) AS INTEGER) AS year,
  CAST(month(full_date) AS INTEGER) AS month, CAST(day(full_date) AS INTEGER) AS day,
  CAST(quarter(full_date) AS INTEGER) AS quarter,
  CAST(dayofweek(full_date) + 1 AS INTEGER) AS day_of_week,
  CAST(dayofyear(full_date) AS INTEGER) AS day_of_year,
  CAST(weekofyear(full_date) AS INTEGER) AS week_of_year, fk AS date_fk FROM dates""",
    "q_dim_date_ranges": f"""WITH {_SEG},{
        _dates("CASE WHEN k % 79 <> 0 THEN search_date END")}
SELECT full_date, CAST(year(full_date) AS INTEGER) AS year,
  CAST(month(full_date) AS INTEGER) AS month, CAST(day(full_date) AS INTEGER) AS day,
  CAST(quarter(full_date) AS INTEGER) AS quarter,
  CAST(dayofweek(full_date) + 1 AS INTEGER) AS day_of_week,
  CAST(dayofyear(full_date) AS INTEGER) AS day_of_year,
  CAST(weekofyear(full_date) AS INTEGER) AS week_of_year, fk AS date_fk FROM dates""",
    "q_star_fact": f"WITH {_SEG},{_dims()},{_STAR} SELECT * FROM star",
    "q_lookup_normalized": f"""WITH {_SEG},{_dims()}
SELECT {_FACT_COLUMNS} {_MEASURES},
  CASE WHEN k % 73 = 0 THEN 3 ELSE CAST(k % 10 AS INTEGER) END AS seats_remaining,
  CASE WHEN k % 89 = 0 AND segment_index = total_segments THEN NULL
       ELSE CAST(trunc(secs / 60.0) AS INTEGER) END AS total_duration_in_minutes,
  CASE WHEN k % 79 <> 0 THEN CAST(flight_date - search_date AS INTEGER) END
    AS search_to_flight_days
FROM seg s {
        _lookups(
            "CASE WHEN s.k % 79 <> 0 THEN s.search_date END",
            "CASE WHEN s.k % 71 <> 0 THEN s.refundable END",
        )}
WHERE k % 97 <> 0""",
    "q_itinerary_fares": f"""WITH {_SEG},{_dims()},{_STAR}
SELECT leg_id, search_date_fk, flight_date_fk, min(base_fare) AS base_fare,
  min(total_fare) AS total_fare,
  CAST(sum(total_duration_in_minutes) AS INTEGER) AS total_duration_in_minutes,
  CAST(count(*) AS INTEGER) AS segments
FROM star GROUP BY leg_id, search_date_fk, flight_date_fk""",
    "q_partition_scan": f"""WITH {_SEG},{_dims()},{_STAR}
SELECT * FROM star WHERE make_date(year, month, day) = DATE '{SCAN_DAY}'""",
    "q_day_scan": f"""WITH {_SEG},{_dims()},{_STAR}
SELECT * FROM star WHERE make_date(year, month, day) = DATE '{SCAN_DAY}'""",
    "q_days_scan": f"""WITH {_SEG},{_dims()},{_STAR}
SELECT * FROM star WHERE make_date(year, month, day) IN (
  SELECT CAST(o_orderdate AS DATE) FROM orders
  WHERE day(o_orderdate) = 1 AND year(o_orderdate) < 1994)""",
    "q_replace_days": f"""WITH {_FLIGHTS},
f AS (
  SELECT leg_id, fare, CAST(year(day) AS INTEGER) AS fare_year,
         CAST(month(day) AS INTEGER) AS fare_month, month(day) % 3 = 0 AS again
  FROM flights
)
SELECT leg_id, round(CASE WHEN again THEN fare * 2 ELSE fare END, 2) AS total_fare, fare_year,
       fare_month
FROM f WHERE NOT again OR leg_id NOT LIKE '%7'""",
    "q_itinerary_search": f"WITH {_SEG},{_SEARCH} SELECT {_FOUND_COLUMNS} FROM found",
    "q_itinerary_packed": f"WITH {_SEG},{_SEARCH} SELECT {_FOUND_COLUMNS} FROM found",
    "q_itinerary_requests": f"""WITH {_SEG},{_SEARCH}
SELECT {_FOUND_COLUMNS} FROM found WHERE (search_date, flight_date, origin, destination) IN
  (SELECT (search_date, flight_date, origin, destination) FROM seg)""",
    "q_search_partition": f"""WITH {_SEG},{_SEARCH}
SELECT {_FOUND_COLUMNS} FROM found WHERE search_date = DATE '{SEARCH_DAY}'""",
    "q_itinerary_twice": f"""WITH {_SEG},{_SEARCH}
SELECT {_FOUND_COLUMNS} FROM found
UNION ALL SELECT {_FOUND_COLUMNS.replace("CAST(fare", "CAST(base")} FROM found""",
    "q_cheapest20": f"""WITH {_SEG},{_SEARCH}
SELECT {_FOUND_COLUMNS} FROM found
ORDER BY fare, search_date, flight_date, leg_id LIMIT 20""",
    "q_one_transfer": f"""WITH {_trips(False)}
SELECT {_TRIP.replace(" leg3,", "")} FROM one WHERE {_MONTHLY}""",
    "q_json_trips": f"""WITH {_trips(False)}
SELECT {_TRIP.replace(" leg3,", "")} FROM one WHERE {_MONTHLY}""",
    "q_two_transfer": f"WITH {_trips(False)} SELECT {_TRIP} FROM two WHERE {_MONTHLY}",
    "q_connections": f"""WITH {_trips(False)},
asked AS (
  SELECT 'A' || lpad(CAST(a.n_nationkey AS VARCHAR), 2, '0') AS f,
         'A' || lpad(CAST(b.n_nationkey AS VARCHAR), 2, '0') AS t
  FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey
   AND a.n_nationkey <> b.n_nationkey
)
SELECT {_TRIP} FROM (SELECT * FROM one UNION ALL SELECT * FROM two)
JOIN asked ON origin = f AND destination = t""",
    "q_one_transfer_all": f"""WITH {_trips(False)}
SELECT {_TRIP.replace(" leg3,", "")} FROM one
WHERE (origin, destination) IN (SELECT (dep, arr) FROM flights)""",
    "q_connections_all": f"""WITH {_trips(False)}
SELECT {_TRIP} FROM (SELECT * FROM one UNION ALL SELECT * FROM two)
WHERE (origin, destination, flight_date) IN (SELECT (dep, arr, day) FROM flights)""",
    "q_connections_same_day": f"""WITH {_trips(True)}
SELECT {_TRIP} FROM (SELECT * FROM one UNION ALL SELECT * FROM two)
WHERE (origin, destination, flight_date) IN (SELECT (dep, arr, day) FROM flights)""",
    "q_clean_path": f"""WITH {_SEG},
stops AS (
  SELECT leg_id, k, segment_index AS i, dep AS stop FROM seg
  UNION ALL
  SELECT leg_id, k, total_segments + 1, destination FROM seg WHERE segment_index = 1
),
marked AS (
  SELECT *, lag(stop) OVER (PARTITION BY k ORDER BY i) AS before FROM stops
)
SELECT leg_id, CASE WHEN k % 101 = 0 THEN NULL WHEN k % 103 = 0 THEN ''
  ELSE string_agg(stop, ' -> ' ORDER BY i)
       FILTER (WHERE before IS NULL OR before <> stop) END AS full_path
FROM marked GROUP BY leg_id, k""",
    "q_fare_features": f"WITH {_FARES},{_FARE_FEATURES} SELECT {_FEATURE_NAMES} FROM features",
    "q_best_time_label": f"""WITH {_FARES},{_FARE_FEATURES}
SELECT {_FEATURE_NAMES}, CASE WHEN CAST(total_fare AS DOUBLE)
  <= CAST(min(total_fare) OVER (PARTITION BY leg_id) AS DOUBLE) * CAST(1.05 AS DOUBLE)
  THEN 1 ELSE 0 END AS is_best_time_to_buy FROM features""",
    "q_route_rule": f"""WITH {_FLIGHTS}
SELECT dep_fk AS departure_airport_fk, arr_fk AS arrival_airport_fk,
  round(min(fare) * CAST(1.05 AS DOUBLE), 4) AS best_buy_threshold
FROM flights GROUP BY dep_fk, arr_fk""",
    "q_date_grid": f"""WITH {_SEG}
SELECT search_date AS as_of, CAST(search_date + CAST(lead AS INTEGER) AS DATE) AS date
FROM (SELECT DISTINCT search_date FROM seg), (SELECT unnest(range(1, 181, 5)) AS lead)""",
    "q_scenarios": f"""WITH {_FLIGHTS},
grid AS (
  SELECT DISTINCT dep_fk, arr_fk, CAST(DATE '{AS_OF}' + lead AS DATE) AS date,
    CAST(lead AS INTEGER) AS lead
  FROM flights, (SELECT CAST(unnest(range(1, 181, 5)) AS INTEGER) AS lead)
)
SELECT dep_fk AS departure_airport_fk, arr_fk AS arrival_airport_fk, date,
  lead AS search_to_flight_days,
  CAST(dayofweek(date) + 1 AS INTEGER) AS flight_day_of_week,
  CAST(month(date) AS INTEGER) AS flight_month,
  CAST(weekofyear(date) AS INTEGER) AS flight_week_of_year,
  CAST(NULL AS INTEGER) AS airline_fk, CAST(NULL AS INTEGER) AS aircraft_fk FROM grid""",
    "q_recommend": f"""WITH {_FLIGHTS},
rules AS (
  SELECT dep_fk, arr_fk, min(fare) * CAST(1.05 AS DOUBLE) AS threshold
  FROM flights GROUP BY dep_fk, arr_fk
),
priced AS (
  SELECT dep_fk, arr_fk, threshold, CAST(DATE '{AS_OF}' + lead AS DATE) AS flight_date,
    threshold * (950 + lead) / CAST(1000 AS DOUBLE) AS price
  FROM rules, (SELECT CAST(unnest(range(1, 181, 5)) AS INTEGER) AS lead)
)
SELECT flight_date, dep_fk AS departure_airport_fk, arr_fk AS arrival_airport_fk,
  round(price, 2) AS predicted_fare,
  CASE WHEN price <= threshold THEN 1 ELSE 0 END AS recommendation FROM priced""",
    "q_stitched_share": f"""WITH {_SEG}
SELECT airline AS airline_name, count(*) AS tickets,
  count(*) FILTER (WHERE many) AS stitched_tickets,
  round(count(*) FILTER (WHERE many) / CAST(count(*) AS DOUBLE), 6) AS stitched_share
FROM (SELECT airline, leg_id, bool_or(total_segments > 1) AS many FROM seg
      GROUP BY airline, leg_id)
GROUP BY airline""",
    "q_rmse": f"""WITH {_FLIGHTS}
SELECT dep_fk AS departure_airport_fk,
  round(sqrt(avg((fare - mean_fare) * (fare - mean_fare))), 4) AS rmse
FROM (SELECT *, avg(fare) OVER (PARTITION BY dep_fk, arr_fk) AS mean_fare FROM flights)
GROUP BY dep_fk""",
    "q_impute_mean": f"""WITH {_DIRTY_FEATURES}{_MEANS}
SELECT leg_id, search_to_flight_days, flight_week_of_year,
  coalesce(search_to_flight_days, lead_mean) AS search_to_flight_days_imputed,
  flight_week_of_year AS flight_week_of_year_imputed FROM features, means""",
    "q_index_categories": f"""WITH {_DIRTY_FEATURES}{_INDEXES}
SELECT leg_id, {", ".join(_CATEGORIES)},
  {", ".join(f"ix_{c}.ix AS {c}_index" for c in _CATEGORIES)}
FROM features {_INDEX_JOINS}""",
    "q_feature_vectors": f"""WITH {_DIRTY_FEATURES}{_MEANS}{_INDEXES}
SELECT leg_id, CAST({_before} + 2 AS INTEGER) AS size,
  {" || ' ' || ".join(_OFFSETS)} || ' ' || ({_before}) || ':'
  || coalesce(search_to_flight_days, lead_mean) || ' ' || ({_before} + 1) || ':'
  || flight_week_of_year AS entries
FROM features {_INDEX_JOINS}, means""",
    "q_sample": f"""WITH {_FLIGHTS}
SELECT leg_id, round(fare, 2) AS total_fare FROM flights
WHERE {_hash_share("leg_id")} < 0.1""",
    "q_split": f"""WITH {_FLIGHTS}
SELECT leg_id, CASE WHEN {_hash_share("leg_id")} < 0.8 THEN 'train' ELSE 'test' END AS part
FROM flights""",
    "q_train_score": f"""WITH {_FARES},{_FARE_FEATURES},
routes AS (SELECT DISTINCT departure_airport_fk, arrival_airport_fk FROM features)
SELECT departure_airport_fk, arrival_airport_fk,
  CAST(DATE '{AS_OF}' + lead AS DATE) AS flight_date, true AS same_when_loaded,
  true AS follows_rule, true AS error_bounded
FROM routes, (SELECT CAST(unnest(range(1, 181, 5)) AS INTEGER) AS lead)""",
    "q_stump": f"""WITH {_FARES},{_FARE_FEATURES}{_stump(_STUMP_ALL)}
SELECT feature, threshold, round(left_mean, 4) AS left_mean, round(right_mean, 4) AS right_mean,
  CAST(tn AS BIGINT) AS fares,
  round(sqrt(avg((CAST(total_fare AS DOUBLE)
    - CASE WHEN {_stump_value(_STUMP_ALL)} <= threshold THEN left_mean ELSE right_mean END) ** 2)), 4)
    AS rmse
FROM features, split GROUP BY feature, threshold, left_mean, right_mean, tn""",
    "q_stump_score": f"""WITH {_FARES},{_FARE_FEATURES}{_stump(_STUMP)},
rules AS (
  SELECT departure_airport_fk, arrival_airport_fk,
         CAST(1.05 AS DOUBLE) * min(CAST(total_fare AS DOUBLE)) AS best
  FROM features GROUP BY ALL
),
grid AS (
  SELECT *, CAST(DATE '{AS_OF}' + CAST(lead AS INTEGER) AS DATE) AS flight_date
  FROM rules, (SELECT unnest(range(1, 181, 5)) AS lead)
),
priced AS (
  SELECT *, CASE WHEN {_stump_value(_STUMP)} <= threshold THEN left_mean ELSE right_mean END AS price
  FROM (SELECT *, dayofweek(flight_date) + 1 AS flight_day_of_week,
               month(flight_date) AS flight_month FROM grid), split
)
SELECT flight_date, departure_airport_fk, arrival_airport_fk, round(price, 2) AS predicted_fare,
  CASE WHEN price <= best THEN 1 ELSE 0 END AS recommendation
FROM priced""",
    "q_lookup_csv": """
SELECT c_mktsegment AS type,
  CASE WHEN c_custkey % 5 = 0 THEN 'a "b"' || chr(10) || c_name ELSE c_name END AS name,
  CASE WHEN c_custkey % 7 <> 0 THEN CAST(c_acctbal AS DOUBLE) END AS latitude_deg,
  CASE WHEN c_custkey % 11 <> 0 THEN CAST(c_custkey AS DOUBLE) END AS longitude_deg,
  CASE WHEN c_custkey % 3 = 0 THEN 'NA' ELSE 'DE' END AS iso_country,
  'R, 1' AS iso_region,
  CASE WHEN c_custkey % 2 = 0 THEN 'City ' || c_nationkey ELSE '' END AS municipality
FROM customer""",
    "q_lookup_countries": """
SELECT * FROM (
  SELECT CASE WHEN c_custkey % 9 <> 0 THEN 'C' || c_custkey END AS code,
         CASE WHEN c_custkey % 6 <> 0 THEN 'of "' || c_mktsegment || '",' || chr(10) || c_name END
           AS name
  FROM customer
) WHERE code IS NOT NULL OR name IS NOT NULL""",
    "q_extract_select": """
SELECT id, trim(substr(text, greatest(strpos(upper(text), 'SELECT'), 1))) AS query
FROM (
  SELECT o_orderkey AS id, CASE o_orderkey % 3
    WHEN 0 THEN 'SQLQuery: select * from orders where o_orderkey = ' || o_orderkey || ' '
    WHEN 1 THEN '  Select 1' ELSE ' no query here ' END AS text
  FROM orders
  UNION ALL
  SELECT -1 - conv_id * 100000 - turn, text FROM conversations
)""",
}

_ALL_DIMENSIONS = {
    "airline": ("airline_fk", "airline_code"),
    "aircraft": ("aircraft_fk", "equipment_description"),
    "flight_details": (
        "flight_details_fk",
        "concat_ws('|', fare_basis_code, segments_cabin_code, is_basic_economy, is_refundable)",
    ),
    "date": ("date_fk", "CAST(full_date AS VARCHAR)"),
}
ORACLE["q_dimensions"] = " UNION ALL ".join(
    f"SELECT '{name}' AS dimension, {key} AS key, {member} AS member "
    f"FROM ({ORACLE[f'q_dim_{name}']})"
    for name, (key, member) in _ALL_DIMENSIONS.items()
)
