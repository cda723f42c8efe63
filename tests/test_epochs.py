"""The sink by epoch: rows written once, replays and half-written batches unseen, compaction by month."""
import datetime as dt
import os

from pyspark.sql import functions as F

from metrolake.schemas import TRIP_SCHEMA
from metrolake.streaming import epochs as E

RAW = "VendorID int, tpep_pickup_datetime timestamp_ntz, trip_distance double, total_amount double"


def _file(spark, folder, name, year, month, n):
    data = [(1, dt.datetime(year, month, 1 + i % 27), float(i), 10.0 + i) for i in range(n)]
    spark.createDataFrame(data, RAW).toPandas().astype({"tpep_pickup_datetime": "datetime64[us]"}).to_parquet(f"{folder}/{name}")


def _rows(df):
    return sorted((r["vehicle_type"], r["year"], r["month"], r["trip_distance"]) for r in df.collect())


def test_epochs_replay_and_compaction(spark, workdir):
    raw, base = f"{workdir}/raw", f"{workdir}/trips"
    os.makedirs(raw)
    schema = spark.createDataFrame([], RAW).schema
    args = dict(raw_schema=schema, base=base, checkpoint=f"{workdir}/ckpt", stream="yellow", window_years=(2020, 2021), max_files_per_trigger=1)
    assert E.read(spark, base).schema == TRIP_SCHEMA and E.read(spark, base).count() == 0 and E.compact(spark, base) == 0
    _file(spark, raw, "a_yellow_tripdata_2020-01.parquet", 2020, 1, 5)
    _file(spark, raw, "b_yellow_tripdata_2020-02.parquet", 2020, 2, 3)
    _file(spark, raw, "c_yellow_tripdata_1999-02.parquet", 1999, 2, 3)                   # outside the window
    assert E.ingest(spark, raw, **args) == 3 and E.ingest(spark, raw, **args) == 0
    want = [("yellow", 2020, 1, float(i)) for i in range(5)] + [("yellow", 2020, 2, float(i)) for i in range(3)]
    assert _rows(E.read(spark, base)) == want

    E.read(spark, base).limit(2).coalesce(1).write.parquet(f"{base}/epochs/yellow-99")   # written, not recorded: unseen
    E.record(spark, base, "yellow", 0, f"{base}/epochs/yellow-0")                        # a replayed record
    assert _rows(E.read(spark, base)) == want

    assert E.compact(spark, base) == 2 and E.compact(spark, base) == 0
    assert _rows(E.read(spark, base)) == want
    E.record(spark, base, "yellow", 0, f"{base}/epochs/yellow-0")                        # replayed after it was folded
    assert _rows(E.read(spark, base)) == want

    january = set(f for f in E.read(spark, base).inputFiles() if "month=1" in f)
    _file(spark, raw, "d_yellow_tripdata_2020-02.parquet", 2020, 2, 4)                   # a late file rewrites its month only
    assert E.ingest(spark, raw, **args) == 1
    assert E.compact(spark, base) == 1
    got = E.read(spark, base)
    assert _rows(got) == sorted(want + [("yellow", 2020, 2, float(i)) for i in range(4)])
    assert january <= set(got.inputFiles())
    plan = got.where(F.col("month") == 1)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "month" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_broken_compaction_changes_nothing(spark, workdir):
    raw, base = f"{workdir}/raw", f"{workdir}/trips"
    os.makedirs(raw)
    _file(spark, raw, "a_green_tripdata_2020-05.parquet", 2020, 5, 6)
    E.ingest(spark, raw, spark.createDataFrame([], RAW).schema, base, f"{workdir}/ckpt", "green", (2020, 2020))
    E.read(spark, base).write.partitionBy(*E.TAGS).parquet(f"{base}/months/0-lost")      # months written, row not recorded
    assert E.read(spark, base).count() == 6
    assert E.compact(spark, base) == 1 and E.read(spark, base).count() == 6
