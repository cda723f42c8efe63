"""Lake layers on any Hadoop path: silver trips / weather, JSON marts."""
from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from metrolake.schemas import TRIP_SCHEMA

TRIP_PARTITIONS = ["vehicle_type", "year", "month"]


def read_silver_trips(spark: SparkSession, base: str) -> DataFrame:
    """A3: silver trips with partition discovery; filters on vehicle_type/year/month
    become partition filters (directories are pruned, not read)."""
    return spark.read.schema(TRIP_SCHEMA).parquet(base)


def read_if_present(spark: SparkSession, schema, path: str, kind: str = "parquet", **options) -> DataFrame:
    """A table with a known schema; empty when its path does not exist. Every other error is raised."""
    try:
        df = spark.read.schema(schema).options(**options).format(kind).load(path)
        df.columns  # resolves the path
        return df
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_silver_weather(spark: SparkSession, base: str) -> DataFrame:
    """A4: silver hourly weather (partitioned by year)."""
    return spark.read.parquet(base)


def _observed(df: DataFrame, name: str):
    """The frame with a row counter that is filled in by the action that runs it."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def write_silver_trips(trips: DataFrame, base: str) -> int:
    """Partitioned overwrite of the touched (vehicle, year, month) partitions
    only (dynamic partition overwrite), so a re-run replaces what it recomputes
    and leaves the other partitions alone.

    No shuffle before the write: partition tags come from the raw file name,
    so every input split belongs to exactly one partition and each task writes
    one file into one partition. A repartition on the partition keys would
    instead send a whole (possibly huge) month to a single task.

    Returns the number of rows written, observed during the write itself."""
    trips, obs = _observed(trips, "silver_trips")
    (trips.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
          .partitionBy(*TRIP_PARTITIONS).parquet(base))
    return int(obs.get["rows"])


def write_silver_weather(weather: DataFrame, base: str) -> int:
    """Overwrite of the years that ``weather`` holds (hours: small); other years stay; returns rows written."""
    weather, obs = _observed(weather, "silver_weather")
    weather.repartition("year").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year").parquet(base)
    return int(obs.get["rows"])


def check_row(spark: SparkSession, expected: int, written: DataFrame) -> DataFrame:
    """One row (expected, found, ok): rows observed while writing vs rows
    found when re-reading what was written."""
    found = written.agg(F.count(F.lit(1))).scalar()
    return (spark.createDataFrame([(int(expected),)], "expected long")
                 .withColumn("found", found).withColumn("ok", F.col("expected") == F.col("found")))


def write_mart(mart: DataFrame, path: str) -> None:
    """One mart as UTF-8 JSON lines (marts are small: one file)."""
    mart.coalesce(1).write.mode("overwrite").json(path)


def read_mart(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """A mart written by ``write_mart`` (JSON lines); pass the schema to skip inference."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


def dense_payload(df: DataFrame, cols) -> DataFrame:
    """Nested payload of a mart row as one JSON text column."""
    return df.select("*", F.to_json(F.struct(*cols)).alias("payload"))
