"""Registered queries whose gates are passed by some groups: the rain and clear prices by zone
over few zones and a weather in which clear hours and rain are both common, and the weather
brought up to date month by month (A16-A18)."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from metrolake import constants as K
from metrolake import oracle as O
from metrolake.operators import serve as D
from metrolake.operators import weather as W
from metrolake.plans import catalog_reconcile as B
from metrolake.plans import silver as SV
from metrolake.plans.catalog import WZ_SQL, _ratio_sql, register, te, we
from metrolake.plans.catalog_files import run_dir
from metrolake.plans.catalog_serve import WZ_CTES
from metrolake.sources import lake as L

# ------------------------------------------------------------------ C31, D7-D9 with values
BUSY_CODES = [0, 61, 2, 61, 0, 95]        # clear, rain, clouds, rain, clear, storm, by hour of the day


def busy_trips(trips: DataFrame) -> DataFrame:
    """Half of the trips in four zones, the rest in sixty, so that some groups pass a gate of 200 trips and some do not."""
    k = F.col("trip_id")
    return trips.withColumn("pulocation_id", F.when(k % 2 == 0, k % 8 + 1).otherwise(k % 61 + 10).cast("int"))


def busy_weather(weather: DataFrame) -> DataFrame:
    codes = F.array(*[F.lit(c) for c in BUSY_CODES])
    return weather.withColumn("weather_code", F.get(codes, F.hour("ts") % len(BUSY_CODES)))


_TRIPS = O.TRIPS_E.replace("trips_e AS", "trips_e0 AS", 1) + (
    ",\ntrips_e AS (SELECT * REPLACE (CAST(CASE WHEN trip_id % 2 = 0 THEN trip_id % 8 + 1 ELSE trip_id % 61 + 10 END AS INT) AS pulocation_id) FROM trips_e0)")
_WEATHER = O.WEATHER_E.replace("weather_e AS", "weather_e0 AS", 1) + (
    f",\nweather_e AS (SELECT * REPLACE (CAST(({BUSY_CODES})[CAST(hour(ts) % {len(BUSY_CODES)} AS INT) + 1] AS INT) AS weather_code) FROM weather_e0)")
BUSY_SQL = O.with_views([], _TRIPS, _WEATHER, *WZ_CTES)


def _zone_weather(spark, d, gate):
    hours = W.hourly_weather(busy_trips(te(spark, d)), busy_weather(we(spark, d)), by="pulocation_id")
    return W.price_by_zone_condition(hours, gate)


def _rain(spark, d):
    return D.rain_ratio(D.zone_rain_clear(_zone_weather(spark, d, K.RAIN_GATE), K.RAIN_GATE))


@register("C31_price_by_zone_condition_busy", BUSY_SQL + _ratio_sql(
    "zone, condition", "(SELECT *, pulocation_id AS zone FROM jz) b", f" HAVING sum(courses) >= {K.MIN_ZONE_WEATHER_TRIPS}"))
def q_c31_busy(spark, d):
    return _zone_weather(spark, d, K.MIN_ZONE_WEATHER_TRIPS)


@register("D7_zone_rain_clear_busy", BUSY_SQL + "SELECT zone, pluie, clair, pluie_n FROM rain")
def q_d7_busy(spark, d):
    return D.zone_rain_clear(_zone_weather(spark, d, K.RAIN_GATE), K.RAIN_GATE)


@register("D8_rain_ratio_busy", BUSY_SQL + "SELECT * FROM rainr")
def q_d8_busy(spark, d):
    return _rain(spark, d)


@register("D9_zone_metric_ratio_pluie_busy", BUSY_SQL + "SELECT zone, CAST(ratio AS DOUBLE) AS value FROM rainr WHERE ratio > 0")
def q_d9_busy(spark, d):
    rain = _rain(spark, d)
    return D.zone_metric(rain.select("zone"), rain, "ratio_pluie")


# ------------------------------------------------------------------ A16-A18: only the months that are due
@register("A16_A18_weather_increment", B.WEATHER_SQL)
def q_weather_increment(spark, d):
    """The even months first, then all of them, then nothing that is due."""
    run = run_dir(spark)
    documents = B.weather_documents(we(spark, d))
    documents.select("year", "month", "hourly").write.partitionBy("year", "month").json(f"{run}/weather")
    months = documents.select("year", "month")
    for wanted in (months.where("month % 2 = 0"), months):
        SV.add_weather(spark, f"{run}/weather", f"{run}/silver", wanted)
    if SV.add_weather(spark, f"{run}/weather", f"{run}/silver", months):
        raise RuntimeError("months were due after all had been added")
    return L.read_silver_weather(spark, f"{run}/silver")
