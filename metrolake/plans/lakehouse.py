"""One call for the whole run: raw files -> manifest -> silver -> gold marts.

Steps (each a Spark plan; the driver only sees file paths and check rows):

1. A10/A14 discover (and optionally sample) raw trip files.
2. A11-A13 classify them (new, known, changed, stored but not registered) and merge
   them into the dataset's manifest; every run writes a numbered manifest of its own.
3. A1/B*/A6/A9/A20 rebuild the silver partitions that have a file not committed yet,
   within the time window of all trip manifests (A22).
4. A2/A7 build silver weather when weather documents are given.
5. R1-R3 + C*/A8 write every mart; A26 status when there is no weather.
6. A27 lineage record, A25 completeness of the written marts.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from metrolake import constants as K
from metrolake.operators import manifest as A
from metrolake.plans import gold
from metrolake.plans import silver as SV
from metrolake.schemas import MANIFEST_ENTRY_SCHEMA
from metrolake.sources import lake as L
from metrolake.sources import raw as R


def manifest_entries(spark: SparkSession, lake_root: str) -> DataFrame:
    """Entries of each dataset's last manifest (empty before the first run): one row per
    registered file, with its dataset. A run writes all entries known to it as a numbered
    table of rows, so only the last one of a dataset counts."""
    schema = T.StructType([*MANIFEST_ENTRY_SCHEMA.fields, T.StructField("dataset_id", T.StringType()), T.StructField("run", T.IntegerType())])
    rows = L.read_if_present(spark, schema, f"{lake_root.rstrip('/')}/manifest", "json")
    last = rows.groupBy("dataset_id").agg(F.max("run").alias("run"))
    return rows.join(last, ["dataset_id", "run"], "left_semi")


def previous_entries(spark: SparkSession, lake_root: str, dataset_id: str) -> DataFrame:
    """The dataset's last manifest."""
    return manifest_entries(spark, lake_root).where(F.col("dataset_id") == dataset_id).select(*A.ENTRY_COLS, "run")


def run_all(spark: SparkSession, raw_root: str, lake_root: str, dataset_id: str = "trips",
            weather_root: str | None = None, zones_csv: str | None = None, sample: int = 0,
            strict_case: bool = False, surcharges=K.SURCHARGES) -> dict[str, DataFrame]:
    lake = lake_root.rstrip("/")
    files = R.sample_files(R.discover_files(spark, raw_root), sample)
    found = SV.manifest_entries_for(files, dataset_id)
    silver_trips = f"{lake}/silver/{dataset_id}/trips"

    before = previous_entries(spark, lake, dataset_id)
    stored = files.join(SV.committed_files(spark, silver_trips).select("path", "size"), ["path", "size"], "left_semi")
    status = A.classify(found, before, SV.manifest_entries_for(stored, dataset_id), compare_size=True)
    classified = spark.createDataFrame(status.groupBy("status").count().collect(), "status string, count long")     # as it was before this run
    run = (before.agg(F.max("run")).first()[0] or 0) + 1
    A.merge_entries(before, found).write.mode("overwrite").json(f"{lake}/manifest/dataset_id={dataset_id}/run={run}")
    every = manifest_entries(spark, lake)
    merged = every.where(F.col("dataset_id") == dataset_id).select(*A.ENTRY_COLS)

    trips_check = SV.build_trips(spark, files, every, silver_trips, strict_case=strict_case)
    weather, weather_check = None, None
    if weather_root:
        weather_check = SV.build_weather(spark, weather_root, f"{lake}/silver/{dataset_id}/weather")
        weather = L.read_silver_weather(spark, f"{lake}/silver/{dataset_id}/weather")
    zones = R.read_zones(spark, zones_csv) if zones_csv else None

    trips = L.read_silver_trips(spark, silver_trips)
    marts = gold.run(spark, trips, weather, f"{lake}/gold", zones=zones, surcharges=surcharges,
                     dataset_id=dataset_id)
    lineage = A.lineage(A.summarize(merged, dataset_id, raw_root, sample))
    L.write_mart(lineage, f"{lake}/gold/{dataset_id}/meta/rows")
    completeness = A.mart_completeness(gold.present_marts(spark, f"{lake}/gold"))
    out = {"trips_check": trips_check, "files_by_status": classified, "lineage": lineage, "completeness": completeness,
           **{f"mart:{k}": v for k, v in marts.items()}}
    if weather_check is not None:
        out["weather_check"] = weather_check
    return out
