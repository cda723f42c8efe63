"""Reference SQL for the correctness gate (run by DuckDB on the same parquet).

Each string re-derives the surrogate trip / weather / zone views from the
benchmark tables and then computes one operator with plain SQL. Helpers below
reproduce Spark's numeric rules exactly:

* ``avg_exact``  - mean of a DECIMAL column rounded HALF_UP, in integer arithmetic
  (Spark keeps decimal means exact; DuckDB's ``avg`` returns a double).
* ``sround``     - Spark's ``round(double, d)``: HALF_UP on the shortest decimal
  text of the double (DuckDB rounds the binary value instead).
* ``ratio``      - ``round(num / den * scale, d)`` in double precision, NULL on 0.
"""
from __future__ import annotations

from metrolake import constants as K

TRIPS_E = """trips_e AS (
  SELECT event_id AS trip_id, event_type AS vehicle_type, ts AS pickup_ts,
    CAST(year(ts) AS INT) AS year, CAST(month(ts) AS INT) AS month,
    CAST(user_id % 265 + 1 AS INT) AS pulocation_id,
    CASE WHEN event_id % 11 = 0 THEN NULL ELSE CAST(event_id % 97 + 1 AS INT) END AS dolocation_id,
    CAST(CAST(regexp_extract(props, '[0-9]+', 0) AS INT) * 0.25 AS DECIMAL(18,2)) AS trip_distance,
    CASE WHEN event_id % 13 = 0 THEN NULL ELSE CAST(value AS DECIMAL(18,2)) END AS total_amount
  FROM events)"""

WEATHER_E = """weather_e AS (
  SELECT hour_ts AS ts,
    CASE WHEN sid % 19 = 0 THEN NULL ELSE CAST(sid % 45 - 8 AS DOUBLE) END AS temperature,
    CASE WHEN sid % 17 = 0 THEN NULL ELSE CAST(sid % 100 AS INT) END AS weather_code
  FROM (SELECT CAST(date_trunc('HOUR', ts) AS TIMESTAMP) AS hour_ts, CAST(SUM(event_id) AS BIGINT) AS sid
        FROM events GROUP BY 1) h)"""

TRIPS_L = """trips_l AS (
  SELECT CASE l_returnflag WHEN 'A' THEN 'yellow' WHEN 'N' THEN 'green' ELSE 'fhv' END AS vehicle_type,
    l_shipdate AS pickup_ts, CAST(year(l_shipdate) AS INT) AS year, CAST(month(l_shipdate) AS INT) AS month,
    CASE WHEN year(l_shipdate) < 1996 THEN NULL ELSE CAST(l_suppkey % 265 + 1 AS INT) END AS pulocation_id,
    CASE WHEN year(l_shipdate) < 1996 OR l_partkey % 29 = 0 THEN NULL
         ELSE CAST(l_partkey % 265 + 1 AS INT) END AS dolocation_id,
    CASE WHEN l_linenumber = 7 THEN CAST(0 AS DECIMAL(18,2)) ELSE CAST(l_quantity AS DECIMAL(18,2)) END AS trip_distance,
    CAST(l_extendedprice AS DECIMAL(18,2)) AS total_amount,
    CASE WHEN l_returnflag = 'R' THEN NULL ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END AS fare_amount,
    CASE WHEN l_returnflag = 'R' THEN NULL
         ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(18,4)) END AS tip_amount,
    CAST(CAST(l_discount AS DECIMAL(4,2)) * 10 AS DECIMAL(18,2)) AS extra,
    CASE WHEN year(l_shipdate) < 1998 THEN NULL
         ELSE CAST(CAST(l_tax AS DECIMAL(4,2)) * 10 AS DECIMAL(18,2)) END AS improvement_surcharge,
    CASE WHEN year(l_shipdate) < 2000 OR l_returnflag <> 'A' THEN NULL
         ELSE CAST(l_linenumber AS DECIMAL(18,2)) END AS congestion_surcharge
  FROM lineitem)"""

ZONES_S = """zones_s AS (
  SELECT CAST(s_suppkey + 1 AS INT) AS location_id, s_name AS zone, n_name AS borough
  FROM supplier JOIN nation ON s_nationkey = n_nationkey)"""

VIEWS = {"trips_e": TRIPS_E, "weather_e": WEATHER_E, "trips_l": TRIPS_L, "zones_s": ZONES_S}

# decimal scale of each money column of the surrogates
SCALES = {"extra": 2, "improvement_surcharge": 2, "congestion_surcharge": 2,
          "fare_amount": 2, "total_amount": 2, "trip_distance": 2, "tip_amount": 4}


def with_views(names, *ctes: str) -> str:
    """WITH clause holding the named surrogate views plus extra CTE texts."""
    parts = [VIEWS[n] for n in names] + list(ctes)
    return "WITH " + ",\n".join(parts) + "\n"


def half_up_div(num: str, den: str) -> str:
    """HALF_UP(num / den) for integer num and positive integer den (NULL if den NULL)."""
    return f"(sign({num}) * ((2 * abs({num}) + ({den})) // (2 * ({den}))))"


def avg_exact(x: str, scale: int, d: int = 2) -> str:
    s = f"CAST(sum({x}) * {10 ** scale} AS HUGEINT)"
    n = f"(NULLIF(count({x}), 0) * {10 ** (scale - d)})"
    return f"(CAST({half_up_div(s, n)} AS DOUBLE) / {10 ** d})"


def sum_round(x: str, d: int = 2) -> str:
    return f"CAST(round(sum({x}), {d}) AS DOUBLE)"


def sround(x: str, d: int = 2) -> str:
    return f"CAST(round(CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38,20)), {d}) AS DOUBLE)"


def ddiv(num: str, den: str) -> str:
    return f"(CAST({num} AS DOUBLE) / NULLIF(CAST({den} AS DOUBLE), 0))"


def ratio(num: str, den: str, d: int = 2, scale: float | None = None) -> str:
    q = ddiv(num, den)
    if scale is not None:
        q = f"({q} * {float(scale)})"
    return sround(q, d)


def when_chain(value: str, bounds, top: str, null_label: str | None = None,
               zero_label: str | None = None) -> str:
    parts = ["CASE"]
    if null_label is not None:
        parts.append(f"WHEN {value} IS NULL THEN '{null_label}'")
    if zero_label is not None:
        parts.append(f"WHEN {value} = 0 THEN '{zero_label}'")
    for upper, label in bounds:
        parts.append(f"WHEN {value} < {upper} THEN '{label}'")
    parts.append(f"ELSE '{top}' END")
    return " ".join(parts)


def condition_sql(code: str) -> str:
    return when_chain(code, K.CONDITION_BOUNDS, K.STORM_CONDITION,
                      null_label=K.UNKNOWN_CONDITION, zero_label=K.CLEAR_CONDITION)


def temperature_band_sql(t: str) -> str:
    return when_chain(t, K.TEMPERATURE_BOUNDS, K.TEMPERATURE_TOP)


def distance_band_sql(d: str) -> str:
    return when_chain(d, K.DISTANCE_BOUNDS, K.DISTANCE_TOP)


def weighted_mean(value: str, weight: str, digits: int = 4) -> str:
    """Exact HALF_UP of sum(value * weight) / sum(weight) for cent-valued ``value``."""
    num = (f"CAST(sum(CASE WHEN {value} IS NOT NULL THEN CAST({value} AS DECIMAL(18,2)) * {weight} END)"
           f" * {10 ** digits} AS HUGEINT)")
    den = f"NULLIF(sum(CASE WHEN {value} IS NOT NULL THEN {weight} END), 0)"
    return f"(CAST({half_up_div(num, den)} AS DOUBLE) / {10 ** digits})"
