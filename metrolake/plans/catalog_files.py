"""Registered physical round trips through files.

Each query writes raw inputs derived from the benchmark tables into a fresh
run folder under the session's ``spark.checkpoint.dir`` (shared storage on a
cluster), runs the ingestion step on them and returns the re-read result, so
the whole write -> read path is exercised on the full tables.
"""
from __future__ import annotations

import uuid

from pyspark.sql import SparkSession, functions as F

from metrolake import oracle as O
from metrolake.operators import marts as M
from metrolake.operators import normalize as N
from metrolake.plans import catalog_reconcile as B
from metrolake.plans import delta
from metrolake.plans import silver as SV
from metrolake.plans.catalog import L_WIDTH, _dense_hist_sql, register, tl, we
from metrolake.session import checkpoint_dir
from metrolake.sources import lake as L
from metrolake.sources import raw as R
from metrolake.sources import surrogates as S
from metrolake.streaming import epochs as EPOCHS
from metrolake.streaming import ingest as STREAM

LAYOUTS = {"legacy": B.legacy_raw, "yellow": B.yellow_raw, "green": B.green_raw, "fhvhv": B.fhvhv_raw}


def run_dir(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/metrolake-runs/{uuid.uuid4().hex}"


def _write_raw(spark, d, run, layouts=LAYOUTS):
    t = B._trips_l_with_line(spark, d)
    for name, shape in layouts.items():
        # two salted files or more per (vehicle, year, month), so that no month is one task's work
        raw = shape(t)
        raw.repartition(*B.TAGS, F.pmod(F.hash(*raw.columns), F.lit(2))).write.mode("overwrite").partitionBy(*B.TAGS).parquet(f"{run}/raw/{name}")
    return t


def _named_files(spark, d, run):
    """The raw layouts as files ``part<i>_<vehicle>_tripdata_<year>-<month>.parquet``,
    several per month: Spark writes them, the store renames them."""
    _write_raw(spark, d, run)
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{run}/raw")
    store = where.getFileSystem(spark._jsc.hadoopConfiguration())
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
             .load(f"{run}/raw").select("path").orderBy("path").collect())
    store.mkdirs(spark._jvm.org.apache.hadoop.fs.Path(f"{run}/bronze"))
    for i, r in enumerate(files):
        tags = dict(p.split("=") for p in r.path.split("/") if "=" in p)
        name = f"part{i}_{tags['vehicle_type']}_tripdata_{tags['year']}-{int(tags['month']):02d}.parquet"
        store.rename(spark._jvm.org.apache.hadoop.fs.Path(r.path), spark._jvm.org.apache.hadoop.fs.Path(f"{run}/bronze/{name}"))
    return f"{run}/bronze"


@register("A20_late_file", B._union_sql(False))
def q_a20_late(spark, d):
    """The ingestion itself: listing, manifest, file-name tags, fingerprint scans, window; first one
    batch without every third file, then all, so late files join months that are already committed."""
    run = run_dir(spark)
    files = R.discover_files(spark, _named_files(spark, d, run))
    entries = SV.manifest_entries_for(files, "trips")
    early = _early(files)
    silver = f"{run}/silver/trips"
    SV.build_trips(spark, early, entries, silver, limit_batches=1)
    SV.build_trips(spark, early, entries, silver)
    check = SV.build_trips(spark, files, entries, silver).first()
    if not check.ok or check.pending:
        raise RuntimeError(f"ingestion is not complete: {check}")
    return L.read_silver_trips(spark, silver)


# Marts of the stored rollups in one table: a row per mart and key, with its number of trips.
DELTA_SQL = "WITH silver AS (" + B._union_sql(False) + ") " + " UNION ALL ".join([
    "SELECT 'timeline' AS mart, year AS annee, month AS a, CAST(NULL AS INT) AS b, vehicle_type AS label, count(*) AS n FROM silver GROUP BY ALL",
    "SELECT 'flows', year, pulocation_id, dolocation_id, vehicle_type, count(*) FROM silver WHERE pulocation_id IS NOT NULL AND dolocation_id IS NOT NULL GROUP BY ALL",
    "SELECT 'heatmap', year, CAST(isodow(pickup_ts) - 1 AS INT), CAST(hour(pickup_ts) AS INT), vehicle_type, count(*) FROM silver GROUP BY ALL",
    "SELECT 'distance', year, NULL, NULL, " + O.distance_band_sql("trip_distance") + ", count(*) FROM silver WHERE trip_distance > 0 AND total_amount IS NOT NULL GROUP BY ALL"])


def delta_marts(stored):
    """The marts of DELTA_SQL from rollups."""
    none = F.lit(None).cast("int")
    shape = lambda df, mart, *cols: df.select(F.lit(mart).alias("mart"), *[c.alias(n) for c, n in zip(cols, ["annee", "a", "b", "label", "n"])])
    flows = stored._zoned().groupBy("year", "pulocation_id", "dolocation_id", "vehicle_type").agg(F.sum("n").alias("n"))
    return (shape(stored.monthly_timeline(), "timeline", F.col("annee"), F.col("mois"), none, F.col("vehicle"), F.col("courses"))
            .unionByName(shape(flows, "flows", F.col("year"), F.col("pulocation_id"), F.col("dolocation_id"), F.col("vehicle_type"), F.col("n")))
            .unionByName(shape(stored.heatmap_counts(), "heatmap", F.col("annee"), F.col("jour"), F.col("heure"), F.col("vehicle_type"), F.col("courses")))
            .unionByName(shape(stored.price_by_distance(), "distance", F.col("annee"), none, none, F.col("bande"), F.col("courses"))))


def _early(files):
    return files.where(F.regexp_extract("name", "^part([0-9]+)_", 1).cast("int") % 3 != 0)


@register("R_delta_late_file", DELTA_SQL)
def q_r_delta(spark, d):
    """Rollups refreshed after a first ingestion and again after late files: the marts of all trips."""
    run = run_dir(spark)
    files = R.discover_files(spark, _named_files(spark, d, run))
    entries, silver = SV.manifest_entries_for(files, "trips"), f"{run}/silver/trips"
    stored = delta.StoredRollups(spark, silver, f"{run}/rollups", width=L_WIDTH)
    for part in (_early(files), files):
        SV.build_trips(spark, part, entries, silver)
        stored.refresh()
    if stored.refresh():
        raise RuntimeError("a refresh without new files found some")
    return delta_marts(stored)


def _silver(spark, d):
    run = run_dir(spark)
    t = _write_raw(spark, d, run)
    frames = [N.normalize(spark.read.parquet(f"{run}/raw/{name}"), keep=B.TAGS) for name in LAYOUTS]
    manifest = t.select(*B.TAGS).distinct()
    trips = N.keep_in_manifest_window(N.union_all(frames), manifest)
    written = L.write_silver_trips(trips, f"{run}/silver/trips")
    return run, written


@register("A1_A3_A6_silver_roundtrip", B._union_sql(False))
def q_a1(spark, d):
    run, _ = _silver(spark, d)
    return L.read_silver_trips(spark, f"{run}/silver/trips")


@register("A9_write_verification", "WITH " + B.TRIPS_LX + ", u AS (" + " UNION ALL ".join(
    [B.LEGACY_SQL, B._yellow_sql(False), B.GREEN_SQL, B.FHVHV_SQL]) + ") "
          "SELECT CAST(count(*) AS BIGINT) AS expected, CAST(count(*) AS BIGINT) AS found, true AS ok FROM u")
def q_a9(spark, d):
    run, written = _silver(spark, d)
    return L.check_row(spark, written, L.read_silver_trips(spark, f"{run}/silver/trips"))


@register("A24_stream_ingest_twice", B._union_sql(False))
def q_a24(spark, d):
    run = run_dir(spark)
    years = _write_raw(spark, d, run).agg(F.min("year"), F.max("year")).first()
    for name in LAYOUTS:                                    # several files per month, dealt over micro-batches
        raw_dir = f"{run}/raw/{name}"
        args = dict(raw_schema=spark.read.parquet(raw_dir).schema, silver_base=f"{run}/silver/trips",
                    checkpoint=f"{run}/_checkpoint_{name}", window_years=tuple(years), tag_from_name=False, max_files_per_trigger=64)
        STREAM.ingest(spark, raw_dir, **args)
        if STREAM.ingest(spark, raw_dir, **args):           # nothing new: no batch carries rows
            raise RuntimeError("second ingestion run processed files again")
    return L.read_silver_trips(spark, f"{run}/silver/trips")


@register("A24_epoch_sink", B._union_sql(False))
def q_a24_epochs(spark, d):
    """Every layout streamed into folders by epoch, with a compaction between the layouts and a second run that finds nothing."""
    run = run_dir(spark)
    years = _write_raw(spark, d, run).agg(F.min("year"), F.max("year")).first()
    for i, name in enumerate(LAYOUTS):
        raw_dir = f"{run}/raw/{name}"
        args = dict(raw_schema=spark.read.parquet(raw_dir).schema, base=f"{run}/trips", checkpoint=f"{run}/_checkpoint_{name}",
                    stream=name, window_years=tuple(years), tag_from_name=False, max_files_per_trigger=64)
        EPOCHS.ingest(spark, raw_dir, **args)
        if EPOCHS.ingest(spark, raw_dir, **args):
            raise RuntimeError("second ingestion run processed files again")
        if i % 2:
            EPOCHS.compact(spark, f"{run}/trips")
    return EPOCHS.read(spark, f"{run}/trips")


@register("A2_A4_A7_weather_roundtrip", B.WEATHER_SQL)
def q_a2(spark, d):
    run = run_dir(spark)
    B.weather_documents(we(spark, d)).select("year", "hourly").write.mode("overwrite") \
        .partitionBy("year").json(f"{run}/bronze/weather")
    w = R.read_weather_json(spark, f"{run}/bronze/weather")
    L.write_silver_weather(w, f"{run}/silver/weather")        # returns the rows written
    return L.read_silver_weather(spark, f"{run}/silver/weather")


@register("A5_zone_csv", O.with_views(["zones_s"]) + "SELECT location_id, zone, borough FROM zones_s")
def q_a5(spark, d):
    run = run_dir(spark)
    z = S.zones_s(spark, d).select(F.col("location_id").alias("LocationID"), F.col("borough").alias("Borough"),
                                   F.col("zone").alias("Zone"))
    z.write.mode("overwrite").option("header", "true").csv(f"{run}/taxi_zone_lookup.csv")
    return R.read_zones(spark, f"{run}/taxi_zone_lookup.csv")


@register("A8_mart_json_sink", _dense_hist_sql())
def q_a8(spark, d):
    run = run_dir(spark)
    dense = M.price_histogram_dense(M.price_histogram(tl(spark, d), L_WIDTH))
    L.write_mart(dense, f"{run}/gold/price_per_km_by_zone")
    back = L.read_mart(spark, f"{run}/gold/price_per_km_by_zone", dense.schema)
    return back.withColumn("hist", F.to_json("hist"))
