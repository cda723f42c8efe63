"""Bronze -> silver as one plan per run.

A file is pending until it is recorded, by path and size, in the table of
committed files beside the silver table. Every partition (vehicle, year, month)
with a pending file is rebuilt from all its files: they are scanned once per
schema fingerprint, normalized, unioned, filtered to the manifest's time window
and written with dynamic partition overwrite. So a late or a changed file never
loses the rows of the others, and a re-run after a crash redoes only what was
not recorded. Every step is narrow (no shuffle): a run costs one read of the
files concerned and one write; the rows are counted during that write.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from metrolake.operators import manifest as A
from metrolake.operators import normalize as N
from metrolake.schemas import WEATHER_SCHEMA
from metrolake.sources import lake as L
from metrolake.sources import raw as R

COMMITTED_SCHEMA = "path string, size long, vehicle_type string, year int, month int"
PARTITION_KEYS = ["vehicle_type", "year", "month"]


def committed_files(spark: SparkSession, silver_base: str) -> DataFrame:
    """Files recorded as committed (path, size and partition; empty before the first run)."""
    return L.read_if_present(spark, COMMITTED_SCHEMA, f"{silver_base.rstrip('/')}_committed").distinct()


def committed_batches(spark: SparkSession, silver_base: str) -> DataFrame:
    """(vehicle, year) batches of the store's listing with a partition that is also recorded as committed.

    The listing names data files only: what a broken write left under ``_temporary`` is not part of it, and a
    partition that was written but not recorded does not count. One listing, no data is read."""
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
              .load(silver_base).select("path"))
    part = lambda name, kind: F.regexp_extract("path", f"/{name}=([^/]+)/", 1).try_cast(kind).alias(name)
    found = listed.select(part("vehicle_type", "string"), part("year", "int"), part("month", "int")).distinct()
    return found.join(committed_files(spark, silver_base).select(*PARTITION_KEYS).distinct(), PARTITION_KEYS, "left_semi") \
                .select("vehicle_type", "year").distinct()


def pending_files(files: DataFrame, committed: DataFrame) -> DataFrame:
    """Files that are not committed, or not in their present size."""
    return files.join(committed.select("path", "size").distinct(), ["path", "size"], "left_anti")


def touched_files(files: DataFrame, pending: DataFrame) -> DataFrame:
    """All files of the partitions that have a pending one."""
    return files.join(pending.select(*PARTITION_KEYS).distinct(), PARTITION_KEYS, "left_semi")


def file_groups(files, batch_files: int = 0) -> list[list[str]]:
    """Split (path, vehicle_type, year, month) rows into write groups of about
    ``batch_files`` files, never splitting the files of one partition (dynamic
    overwrite replaces a whole partition, so all its files must be written by
    the same job). ``batch_files`` = 0 gives a single group."""
    by_part: dict[tuple, list[str]] = {}
    for r in files:
        by_part.setdefault((r.vehicle_type, r.year, r.month), []).append(r.path)
    groups, cur = [], []
    for key in sorted(by_part):
        cur += sorted(by_part[key])
        if batch_files and len(cur) >= batch_files:
            groups.append(cur)
            cur = []
    if cur:
        groups.append(cur)
    return groups


def build_trips(spark: SparkSession, files: DataFrame, manifest_entries: DataFrame,
                silver_base: str, limit_batches: int = 0, strict_case: bool = False,
                strict_month: bool = False, batch_files: int = 0) -> DataFrame:
    """Run bronze -> silver for the discovered ``files`` (frame with path,
    size, vehicle_type, year, month); returns the A9 check row (expected, found, pending, ok).

    ``strict_month`` also drops trips whose pickup lies outside their file's month.
    ``batch_files`` > 0 commits the files in jobs of about that many (whole
    partitions per job), so a failure late in a very large run only redoes the
    group that was being written; 0 writes everything in one job. In the row,
    expected and found count the rows of the partitions written, and pending
    the registered files that are still not committed (``limit_batches``)."""
    todo = pending_files(files, committed_files(spark, silver_base))
    if limit_batches:
        batches = todo.select("vehicle_type", "year").distinct().orderBy("vehicle_type", "year").limit(limit_batches)
        todo = todo.join(batches, ["vehicle_type", "year"], "left_semi")          # A21
    listing = touched_files(files, todo).select("path", "size", *PARTITION_KEYS).collect()    # file metadata only
    bounds = N.manifest_bounds(manifest_entries) if listing else None          # read once for all groups
    expected, by_path = 0, {r.path: r for r in listing}
    for paths in file_groups(listing, batch_files):
        trips = R.read_raw_trips(spark, paths, strict_case)
        trips = N.keep_in_window(trips, *bounds) if bounds is not None else trips.limit(0)
        if strict_month:
            trips = N.keep_in_file_month(trips)
        expected += L.write_silver_trips(trips, silver_base)
        spark.createDataFrame([tuple(by_path[p]) for p in paths], COMMITTED_SCHEMA).coalesce(1) \
            .write.mode("append").parquet(f"{silver_base.rstrip('/')}_committed")
    left = pending_files(files, committed_files(spark, silver_base)).count()
    if not listing:
        return spark.createDataFrame([(0, 0, left, True)], "expected long, found long, pending long, ok boolean")
    parts = spark.createDataFrame(sorted({(r.vehicle_type, r.year, r.month) for r in listing}), "vehicle_type string, year int, month int")
    written = L.read_silver_trips(spark, silver_base).join(F.broadcast(parts), PARTITION_KEYS, "left_semi")   # one row per partition written
    return L.check_row(spark, expected, written).withColumn("pending", F.lit(left).cast("long"))


def build_weather(spark: SparkSession, weather_root: str, silver_weather: str) -> DataFrame:
    """Raw monthly weather JSON -> silver hourly weather partitioned by year."""
    w = R.read_weather_json(spark, weather_root)
    expected = L.write_silver_weather(w, silver_weather)
    return L.check_row(spark, expected, L.read_silver_weather(spark, silver_weather))


def add_weather(spark: SparkSession, weather_root: str, silver_weather: str, months: DataFrame) -> int:
    """Bring the silver weather up to date for ``months`` (year, month), such as a manifest's.

    Months that the silver weather lacks and that have a document are due; their years are rebuilt
    from their own documents and replaced, other years are neither read nor written. Returns the
    number of months added (0: nothing was due)."""
    hours = L.read_if_present(spark, WEATHER_SCHEMA, silver_weather)
    have = hours.select(F.year("ts").alias("year"), F.month("ts").alias("month")).distinct()
    documents = R.weather_documents(spark, weather_root)
    due = A.missing_months(documents.join(months.select("year", "month").distinct(), ["year", "month"], "left_semi").select("year", "month").distinct(), have)
    rows = due.collect()                                                                    # metadata only
    years, n = sorted({r["year"] for r in rows}), len(rows)
    if n:
        wanted = documents.join(months.select("year", "month").distinct(), ["year", "month"], "left_semi").where(F.col("year").isin(years))
        both = wanted.unionByName(documents.join(have, ["year", "month"], "left_semi").where(F.col("year").isin(years))).select("path").distinct()
        L.write_silver_weather(R.read_weather_json(spark, *[r["path"] for r in both.collect()]), silver_weather)
    return n


def manifest_entries_for(files: DataFrame, dataset_id: str) -> DataFrame:
    """Manifest entries for discovered files (key = dataset/vehicle/YYYY/MM/name)."""
    return files.select(A.bronze_key(F.lit(dataset_id), "vehicle_type", "year", "month", "name").alias("key"),
                        "size", "vehicle_type", "year", "month")
