"""Questions the silver model must answer without going back to raw files."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from metrolake.functions import expressions as X
from metrolake.operators import marts as M
from metrolake.operators.weather import MAX_WEATHER_ROWS, dedupe_hours
from metrolake.plans.joins import broadcast_bounded


def trips_per_vehicle_month(trips: DataFrame) -> DataFrame:
    """Same plan as the monthly timeline."""
    return M.monthly_timeline(trips)


def most_frequent_pickup_zone(trips: DataFrame, zones: DataFrame | None = None) -> DataFrame:
    """The pickup zone with most trips (ties -> smallest id), named when a
    zone dimension is given."""
    top = (trips.filter(F.col("pulocation_id").isNotNull())
                .groupBy(F.col("pulocation_id").alias("zone"))
                .agg(F.count(F.lit(1)).alias("pickups"))
                .orderBy(F.desc("pickups"), "zone").limit(1))
    return M.name_zones(top, zones) if zones is not None else top


def weather_at_trip(trips: DataFrame, weather: DataFrame) -> DataFrame:
    """Every trip with the weather of its (wall-clock) pickup hour.

    Row-level left join: the weather side is one row per hour (duplicates
    removed) and is broadcast after a checked count, so the trip side is
    never shuffled and a hot hour cannot skew a task."""
    w = dedupe_hours(weather.select("ts", "temperature", "weather_code"))
    w = w.select(F.col("ts").alias("_wts"), "temperature", "weather_code",
                 X.weather_condition("weather_code").alias("condition"))
    return (trips.join(broadcast_bounded(w, MAX_WEATHER_ROWS),
                       X.hour_start("pickup_ts") == F.col("_wts"), "left")
                 .drop("_wts"))
