"""Schemas of every layer: canonical trips, weather, zones, manifests."""
from __future__ import annotations

from pyspark.sql import types as T

# Canonical trip columns in output order. Money is double; timestamps are
# wall-clock (NTZ) so trip hours line up with local-time weather hours.
CANONICAL_COLUMNS = [
    ("vendor", T.StringType()),
    ("pickup_ts", T.TimestampNTZType()),
    ("dropoff_ts", T.TimestampNTZType()),
    ("passenger_count", T.IntegerType()),
    ("trip_distance", T.DoubleType()),
    ("pickup_lon", T.DoubleType()),
    ("pickup_lat", T.DoubleType()),
    ("dropoff_lon", T.DoubleType()),
    ("dropoff_lat", T.DoubleType()),
    ("pulocation_id", T.IntegerType()),
    ("dolocation_id", T.IntegerType()),
    ("fare_amount", T.DoubleType()),
    ("extra", T.DoubleType()),
    ("mta_tax", T.DoubleType()),
    ("improvement_surcharge", T.DoubleType()),
    ("congestion_surcharge", T.DoubleType()),
    ("airport_fee", T.DoubleType()),
    ("cbd_convenience_fee", T.DoubleType()),
    ("tip_amount", T.DoubleType()),
    ("tolls_amount", T.DoubleType()),
    ("total_amount", T.DoubleType()),
    ("payment_type", T.StringType()),
]

PARTITION_COLUMNS = [("vehicle_type", T.StringType()), ("year", T.IntegerType()),
                     ("month", T.IntegerType())]

TRIP_SCHEMA = T.StructType(
    [T.StructField(n, t, True) for n, t in CANONICAL_COLUMNS + PARTITION_COLUMNS])

# Raw weather document: a struct of parallel hourly arrays.
WEATHER_RAW_SCHEMA = T.StructType([
    T.StructField("hourly", T.StructType([
        T.StructField("time", T.ArrayType(T.StringType())),
        T.StructField("temperature_2m", T.ArrayType(T.DoubleType())),
        T.StructField("precipitation", T.ArrayType(T.DoubleType())),
        T.StructField("snowfall", T.ArrayType(T.DoubleType())),
        T.StructField("weather_code", T.ArrayType(T.LongType())),
        T.StructField("wind_speed_10m", T.ArrayType(T.DoubleType())),
    ])),
])

WEATHER_SCHEMA = T.StructType([
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("temperature", T.DoubleType()),
    T.StructField("precipitation", T.DoubleType()),
    T.StructField("snowfall", T.DoubleType()),
    T.StructField("weather_code", T.IntegerType()),
    T.StructField("wind_speed", T.DoubleType()),
    T.StructField("year", T.IntegerType()),
])

# Zone lookup CSV (header LocationID,Borough,Zone; read by name).
ZONE_CSV_SCHEMA = T.StructType([
    T.StructField("LocationID", T.IntegerType()),
    T.StructField("Borough", T.StringType()),
    T.StructField("Zone", T.StringType()),
    T.StructField("service_zone", T.StringType()),
])

ZONE_SCHEMA = T.StructType([
    T.StructField("location_id", T.IntegerType()),
    T.StructField("zone", T.StringType()),
    T.StructField("borough", T.StringType()),
])

# One manifest entry per registered raw file.
MANIFEST_ENTRY_SCHEMA = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("size", T.LongType()),
    T.StructField("vehicle_type", T.StringType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
])

MANIFEST_SCHEMA = T.StructType([
    T.StructField("dataset_id", T.StringType()),
    T.StructField("kind", T.StringType()),
    T.StructField("source_dir", T.StringType()),
    T.StructField("sample_mode", T.BooleanType()),
    T.StructField("taille_octets", T.LongType()),
    T.StructField("trip_years", T.ArrayType(T.IntegerType())),
    T.StructField("files", T.ArrayType(MANIFEST_ENTRY_SCHEMA)),
])
