"""Registered reconciliation queries.

The line-item surrogate is re-shaped into the raw layouts the canonical model
must absorb (legacy 2009 names with string timestamps, modern yellow with a
case-drifted column, modern green, high-volume for-hire), each layout is
normalized on its own and the results are unioned by name and filtered by
the manifest time window. The oracle is the canonical projection computed
directly in SQL. Weather rows are packed into monthly array documents and
exploded back.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from metrolake import oracle as O
from metrolake.operators import normalize as N
from metrolake.operators import weather as W
from metrolake.plans.catalog import register
from metrolake.sources import surrogates as S

TAGS = ["vehicle_type", "year", "month"]
LEGACY_BEFORE = 1998


def _trips_l_with_line(spark, d) -> DataFrame:
    li = S.table(spark, d, "lineitem")
    cols = S.trips_l_columns(li)
    return li.select(*cols, F.col("l_linenumber").alias("line_no"))


def _dbl(c):
    return F.col(c).cast("double")


def legacy_raw(t: DataFrame) -> DataFrame:
    """Legacy layout: string timestamps (one garbage, one out of window), GPS, no zone ids."""
    fmt = "yyyy-MM-dd HH:mm:ss"
    ts = F.date_format("pickup_ts", fmt)
    pick = (F.when(F.col("line_no") == 6, F.lit("not a time"))
             .when(F.col("line_no") == 5, F.date_format(F.col("pickup_ts") - F.expr("INTERVAL 100 YEARS"), fmt))
             .otherwise(F.col("_ts")))
    return t.filter(F.col("year") < LEGACY_BEFORE).withColumn("_ts", ts).select(        # formatted once a row
        F.col("vehicle_type").alias("vendor_name"),
        pick.alias("Trip_Pickup_DateTime"), F.col("_ts").alias("Trip_Dropoff_DateTime"),
        F.col("month").cast("bigint").alias("Passenger_Count"),
        _dbl("trip_distance").alias("Trip_Distance"),
        (F.col("pulocation_id").cast("double") / 1000 - 74.0).alias("Start_Lon"),
        (F.col("dolocation_id").cast("double") / 1000 + 40.0).alias("Start_Lat"),
        F.lit("CASH").alias("Payment_Type"),
        _dbl("fare_amount").alias("Fare_Amt"), _dbl("extra").alias("surcharge"),
        _dbl("tip_amount").alias("Tip_Amt"), _dbl("total_amount").alias("Total_Amt"),
        *TAGS)


def yellow_raw(t: DataFrame) -> DataFrame:
    """Modern yellow: tpep_ names, INT64 payment type, case-drifted ``Airport_fee``."""
    return t.filter((F.col("year") >= LEGACY_BEFORE) & (F.col("vehicle_type") == "yellow")).select(
        F.col("month").cast("int").alias("VendorID"),
        F.col("pickup_ts").alias("tpep_pickup_datetime"), F.col("pickup_ts").alias("tpep_dropoff_datetime"),
        F.col("month").cast("bigint").alias("passenger_count"), _dbl("trip_distance").alias("trip_distance"),
        F.col("pulocation_id").alias("PULocationID"), F.col("dolocation_id").alias("DOLocationID"),
        F.lit(1).cast("bigint").alias("payment_type"),
        _dbl("fare_amount").alias("fare_amount"), _dbl("extra").alias("extra"),
        F.lit(0.5).alias("mta_tax"), _dbl("improvement_surcharge").alias("improvement_surcharge"),
        _dbl("congestion_surcharge").alias("congestion_surcharge"), _dbl("extra").alias("Airport_fee"),
        _dbl("tip_amount").alias("tip_amount"), F.lit(0.0).alias("tolls_amount"),
        _dbl("total_amount").alias("total_amount"), *TAGS)


def green_raw(t: DataFrame) -> DataFrame:
    """Modern green: lpep_ names; later surcharges absent."""
    return t.filter((F.col("year") >= LEGACY_BEFORE) & (F.col("vehicle_type") == "green")).select(
        F.col("month").cast("long").alias("VendorID"),
        F.col("pickup_ts").alias("lpep_pickup_datetime"), F.col("pickup_ts").alias("lpep_dropoff_datetime"),
        F.col("month").cast("double").alias("passenger_count"), _dbl("trip_distance").alias("trip_distance"),
        F.col("pulocation_id").alias("PULocationID"), F.col("dolocation_id").alias("DOLocationID"),
        _dbl("fare_amount").alias("fare_amount"), _dbl("extra").alias("extra"),
        _dbl("tip_amount").alias("tip_amount"), _dbl("total_amount").alias("total_amount"), *TAGS)


def fhvhv_raw(t: DataFrame) -> DataFrame:
    """High-volume for-hire: trip_miles, base_passenger_fare, tips, tolls; no total."""
    return t.filter((F.col("year") >= LEGACY_BEFORE) & (F.col("vehicle_type") == "fhv")).select(
        F.lit("HV0003").alias("hvfhs_license_num"), F.lit("B02512").alias("dispatching_base_num"),
        F.col("pickup_ts").alias("pickup_datetime"), F.col("pickup_ts").alias("dropOff_datetime"),
        _dbl("trip_distance").alias("trip_miles"), _dbl("fare_amount").alias("base_passenger_fare"),
        _dbl("tip_amount").alias("tips"), F.lit(0.0).alias("tolls"),
        _dbl("congestion_surcharge").alias("congestion_surcharge"), _dbl("extra").alias("airport_fee"),
        F.col("pulocation_id").cast("double").alias("PUlocationID"),
        F.col("dolocation_id").cast("double").alias("DOlocationID"), *TAGS)


def reconciled(spark, d, strict_case: bool = False) -> DataFrame:
    t = _trips_l_with_line(spark, d)
    frames = [N.normalize(f(t), strict_case=strict_case, keep=TAGS)
              for f in (legacy_raw, yellow_raw, green_raw, fhvhv_raw)]
    manifest = t.select(*TAGS).distinct()
    return N.keep_in_manifest_window(N.union_all(frames), manifest)


# ------------------------------------------------------------------ oracle SQL
TRIPS_LX = O.TRIPS_L.replace("trips_l AS (", "trips_lx AS (").replace(
    "\n  FROM lineitem)", ",\n    l_linenumber AS line_no\n  FROM lineitem)")

_CANON = ["vendor", "pickup_ts", "dropoff_ts", "passenger_count", "trip_distance", "pickup_lon", "pickup_lat",
          "dropoff_lon", "dropoff_lat", "pulocation_id", "dolocation_id", "fare_amount", "extra", "mta_tax",
          "improvement_surcharge", "congestion_surcharge", "airport_fee", "cbd_convenience_fee", "tip_amount",
          "tolls_amount", "total_amount", "payment_type"]


def _seg(where: str, **vals) -> str:
    d = {c: "NULL" for c in _CANON}
    d.update(vals)
    types = {"vendor": "VARCHAR", "pickup_ts": "TIMESTAMP", "dropoff_ts": "TIMESTAMP", "passenger_count": "INT",
             "pulocation_id": "INT", "dolocation_id": "INT", "payment_type": "VARCHAR"}
    cols = ", ".join(f"CAST({d[c]} AS {types.get(c, 'DOUBLE')}) AS {c}" for c in _CANON)
    return f"SELECT {cols}, vehicle_type, year, month FROM trips_lx WHERE {where}"


_D = "CAST(trip_distance AS DOUBLE)"
LEGACY_SQL = _seg(f"year < {LEGACY_BEFORE} AND line_no NOT IN (5, 6)", vendor="vehicle_type",
                  pickup_ts="pickup_ts", dropoff_ts="pickup_ts", passenger_count="month", trip_distance=_D,
                  pickup_lon="CAST(pulocation_id AS DOUBLE) / 1000 - 74.0",
                  pickup_lat="CAST(dolocation_id AS DOUBLE) / 1000 + 40.0",
                  fare_amount="fare_amount", extra="extra", tip_amount="tip_amount", total_amount="total_amount",
                  payment_type="'CASH'")


def _yellow_sql(strict_case: bool) -> str:
    return _seg(f"year >= {LEGACY_BEFORE} AND vehicle_type = 'yellow'", vendor="month", pickup_ts="pickup_ts",
                dropoff_ts="pickup_ts", passenger_count="month", trip_distance=_D, pulocation_id="pulocation_id",
                dolocation_id="dolocation_id", fare_amount="fare_amount", extra="extra", mta_tax="0.5",
                improvement_surcharge="improvement_surcharge", congestion_surcharge="congestion_surcharge",
                airport_fee="NULL" if strict_case else "extra", tip_amount="tip_amount", tolls_amount="0.0",
                total_amount="total_amount", payment_type="'1'")


GREEN_SQL = _seg(f"year >= {LEGACY_BEFORE} AND vehicle_type = 'green'", vendor="month", pickup_ts="pickup_ts",
                 dropoff_ts="pickup_ts", passenger_count="month", trip_distance=_D, pulocation_id="pulocation_id",
                 dolocation_id="dolocation_id", fare_amount="fare_amount", extra="extra", tip_amount="tip_amount",
                 total_amount="total_amount")
FHVHV_SQL = _seg(f"year >= {LEGACY_BEFORE} AND vehicle_type = 'fhv'", vendor="'B02512'", pickup_ts="pickup_ts",
                 dropoff_ts="pickup_ts", trip_distance=_D, pulocation_id="pulocation_id",
                 dolocation_id="dolocation_id", fare_amount="fare_amount", congestion_surcharge="congestion_surcharge",
                 airport_fee="extra", tip_amount="tip_amount", tolls_amount="0.0")


def _union_sql(strict_case: bool) -> str:
    return ("WITH " + TRIPS_LX + "\n" + " UNION ALL ".join(
        [LEGACY_SQL, _yellow_sql(strict_case), GREEN_SQL, FHVHV_SQL]))


@register("B1_B9_reconcile_union", _union_sql(False))
def q_b_union(spark, d):
    return reconciled(spark, d)


@register("B2_B3_strict_case_aliases", _union_sql(True))
def q_b_strict(spark, d):
    return reconciled(spark, d, strict_case=True)


@register("B5_B8_legacy_parse_and_window", "WITH " + TRIPS_LX + "\n" + LEGACY_SQL)
def q_b_legacy(spark, d):
    t = _trips_l_with_line(spark, d)
    manifest = t.select(*TAGS).distinct()
    return N.keep_in_manifest_window(N.normalize(legacy_raw(t), keep=TAGS), manifest)


@register("B2_fhvhv_first_present_alias", "WITH " + TRIPS_LX + "\n" + FHVHV_SQL)
def q_b_fhvhv(spark, d):
    return N.normalize(fhvhv_raw(_trips_l_with_line(spark, d)), keep=TAGS)


# ------------------------------------------------------------------ B10-B12 weather documents
def weather_documents(weather: DataFrame) -> DataFrame:
    """Pack hourly rows into one raw document per month (arrays ordered by time,
    at most 744 entries per month)."""
    w = weather.select(F.year("ts").alias("year"), F.month("ts").alias("month"),
                       F.struct("ts", "temperature", "weather_code").alias("h"))
    g = w.groupBy("year", "month").agg(F.sort_array(F.collect_list("h")).alias("hs"))
    hs = F.col("hs")
    return g.select("year", "month", F.struct(
        F.transform(hs, lambda x: F.date_format(x["ts"], "yyyy-MM-dd'T'HH:mm")).alias("time"),
        F.transform(hs, lambda x: x["temperature"]).alias("temperature_2m"),
        F.transform(hs, lambda x: F.when(x["weather_code"] % 7 != 0, (x["weather_code"] % 10).cast("double") / 10.0)).alias("precipitation"),
        F.transform(hs, lambda x: F.when(x["temperature"] < 0, -x["temperature"] / 10.0).otherwise(F.lit(0.0))).alias("snowfall"),
        F.transform(hs, lambda x: x["weather_code"].cast("long")).alias("weather_code"),
        # shorter than the others by the month's hours of a kind: trailing hours have no wind
        F.slice(F.transform(hs, lambda x: (F.hour(x["ts"]) + F.dayofmonth(x["ts"])).cast("double") / 2.0), 1,
                F.size(hs) - F.size(F.filter(hs, lambda x: x["weather_code"] % 13 == 0))).alias("wind_speed_10m"),
    ).alias("hourly"))


MONTH = "OVER (PARTITION BY year(ts), month(ts)"
WEATHER_SQL = O.with_views(["weather_e"]) + (
    "SELECT ts, temperature, CASE WHEN weather_code % 7 <> 0 THEN CAST(weather_code % 10 AS DOUBLE) / 10.0 END AS precipitation, "
    "CASE WHEN temperature < 0 THEN -temperature / 10.0 ELSE CAST(0.0 AS DOUBLE) END AS snowfall, weather_code, "
    f"CASE WHEN row_number() {MONTH} ORDER BY ts) <= count(*) {MONTH}) - count(*) FILTER (WHERE weather_code % 13 = 0) {MONTH}) "
    "THEN CAST(hour(ts) + day(ts) AS DOUBLE) / 2.0 END AS wind_speed, CAST(year(ts) AS INT) AS year FROM weather_e")


@register("B10_B12_weather_explode", WEATHER_SQL)
def q_b10(spark, d):
    return W.explode_hourly(weather_documents(S.weather_e(spark, d)))
