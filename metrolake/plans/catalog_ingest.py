"""Registered ingestion-bookkeeping queries.

The file listing is derived from the line-item trips: one raw file per
(vehicle, year, month) with the trip count as its size. A previous run
registered the files up to 1998 in its manifest; an interrupted run copied
1999-2000 to the store without writing the manifest; 2001 is new.
"""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from metrolake import constants as K
from metrolake import oracle as O
from metrolake.operators import manifest as A
from metrolake.plans import gold, silver as SV
from metrolake.plans.catalog import register, te, tl, we
from metrolake.session import checkpoint_dir
from metrolake.schemas import TRIP_SCHEMA
from metrolake.sources import lake as L
from metrolake.sources import raw as R
from metrolake.sources import surrogates as S

DATASET = "trips-l"
MANIFEST_UNTIL = 1998
STORE_UNTIL = 2000


def _name(v, y, m):
    return F.concat(v, F.lit("_tripdata_"), y.cast("string"), F.lit("-"),
                    F.lpad(m.cast("string"), 2, "0"), F.lit(".parquet"))


def listing(spark, d) -> DataFrame:
    g = tl(spark, d).groupBy("vehicle_type", "year", "month").agg(F.count(F.lit(1)).cast("bigint").alias("size"))
    name = _name(F.col("vehicle_type"), F.col("year"), F.col("month"))
    return g.select(A.bronze_key(F.lit(DATASET), "vehicle_type", "year", "month", name).alias("key"),
                    "size", "vehicle_type", "year", "month", name.alias("name"))


def listed(spark, d) -> DataFrame:
    """The listing as a small written table (a row per file), so a query that uses it several times scans the trips once."""
    return gold.materialize(listing(spark, d), f"{_run_dir(spark)}/listing")


def _run_dir(spark) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/metrolake-runs/{uuid.uuid4().hex}"


def _prev(files):
    return files.filter(F.col("year") <= MANIFEST_UNTIL)


def _store(files):
    return files.filter(F.col("year") <= STORE_UNTIL).select("key")


def _merged(files):
    cls = A.classify(files, _prev(files), _store(files))
    return A.merge_entries(_prev(files), cls.filter(F.col("status") != "skipped"))


# ------------------------------------------------------------------ SQL side
_NAME = ("vehicle_type || '_tripdata_' || CAST(year AS VARCHAR) || '-' || lpad(CAST(month AS VARCHAR), 2, '0') "
         "|| '.parquet'")
LISTING = (f"listing AS (SELECT '{DATASET}/' || vehicle_type || '/' || CAST(year AS VARCHAR) || '/' || "
           f"lpad(CAST(month AS VARCHAR), 2, '0') || '/' || {_NAME} AS key, CAST(count(*) AS BIGINT) AS size, "
           f"vehicle_type, year, month, {_NAME} AS name FROM trips_l GROUP BY vehicle_type, year, month)")
PREV = f"prev AS (SELECT * FROM listing WHERE year <= {MANIFEST_UNTIL})"
STORE = f"store AS (SELECT key FROM listing WHERE year <= {STORE_UNTIL})"
CLS = ("cls AS (SELECT l.*, CASE WHEN l.key IN (SELECT key FROM prev) THEN 'skipped' "
       "WHEN l.key IN (SELECT key FROM store) THEN 'healed' ELSE 'new' END AS status FROM listing l)")
MERGED = ("merged AS (SELECT key, size, vehicle_type, year, month FROM prev UNION ALL "
          "SELECT key, size, vehicle_type, year, month FROM cls WHERE status <> 'skipped' "
          "AND key NOT IN (SELECT key FROM prev))")
BASE = O.with_views(["trips_l"], LISTING, PREV, STORE, CLS, MERGED)
PAT = K.TRIP_FILE_PATTERN


@register("A10_file_name_parse", BASE +
          "SELECT name, CAST(regexp_extract(name, '" + PAT + "', 1) AS VARCHAR) AS vehicle_type, "
          "CAST(regexp_extract(name, '" + PAT + "', 2) AS INT) AS year, "
          "CAST(regexp_extract(name, '" + PAT + "', 3) AS INT) AS month FROM "
          "(SELECT name FROM listing UNION ALL SELECT upper(substr(name, 1, 1)) || substr(name, 2) FROM listing "
          "UNION ALL SELECT 'notes_' || CAST(year AS VARCHAR) || '.parquet' FROM listing) n "
          "WHERE regexp_matches(name, '" + PAT + "')")
def q_a10(spark, d):
    names = listing(spark, d).select("name", "year")
    cap = F.concat(F.upper(F.substring("name", 1, 1)), F.expr("substr(name, 2)"))
    all_names = (names.select("name")
                 .unionByName(names.select(cap.alias("name")))
                 .unionByName(names.select(F.concat(F.lit("notes_"), F.col("year").cast("string"),
                                                    F.lit(".parquet")).alias("name"))))
    return R.parse_file_names(all_names)


@register("A11_new_files", BASE + "SELECT key, size, vehicle_type, year, month FROM listing "
          "WHERE key NOT IN (SELECT key FROM prev)")
def q_a11(spark, d):
    files = listed(spark, d)
    return A.new_files(files, _prev(files)).select(*A.ENTRY_COLS)


@register("A12_classify_skip_heal_new", BASE + "SELECT key, size, vehicle_type, year, month, status FROM cls")
def q_a12(spark, d):
    files = listed(spark, d)
    return A.classify(files, _prev(files), _store(files)).select(*A.ENTRY_COLS, "status")


@register("A13_merged_manifest", BASE + "SELECT * FROM merged")
def q_a13(spark, d):
    return _merged(listed(spark, d))


@register("A13_manifest_summary", BASE +
          f"SELECT '{DATASET}' AS dataset_id, 'trips' AS kind, CAST(NULL AS VARCHAR) AS source_dir, "
          "false AS sample_mode, CAST(to_json(list(DISTINCT year ORDER BY year)) AS VARCHAR) AS trip_years, "
          "CAST(sum(size) AS BIGINT) AS taille_octets, CAST(count(*) AS BIGINT) AS fichiers FROM merged")
def q_a13b(spark, d):
    return A.summarize(_merged(listed(spark, d)), DATASET).withColumn("trip_years", F.to_json("trip_years"))


@register("A14_sample_first_files", BASE +
          "SELECT key, size, vehicle_type, year, month FROM listing ORDER BY key LIMIT 5")
def q_a14(spark, d):
    files = listing(spark, d).withColumnRenamed("key", "path")
    return R.sample_files(files, 5).select(F.col("path").alias("key"), "size", "vehicle_type", "year", "month")


@register("A15_coverage_by_vehicle", BASE +
          "SELECT vehicle_type, min(year * 100 + month) AS premier_mois, max(year * 100 + month) AS dernier_mois, "
          "CAST(count(*) AS BIGINT) AS fichiers FROM merged GROUP BY vehicle_type")
def q_a15(spark, d):
    return A.coverage_by_vehicle(_merged(listed(spark, d)))


@register("A15_month_present", BASE +
          "SELECT count(*) FILTER (WHERE vehicle_type = 'yellow' AND year = 1999 AND month = 1) > 0 AS present "
          "FROM merged")
def q_a15b(spark, d):
    return A.is_present(_merged(listed(spark, d)), "yellow", 1999, 1)


@register("A16_months_covered", BASE + "SELECT DISTINCT year, month FROM merged")
def q_a16(spark, d):
    return A.months_covered(_merged(listed(spark, d)))


HAVE_WEATHER = ("have AS (SELECT DISTINCT CAST(year(o_orderdate) AS INT) AS year, "
                "CAST(month(o_orderdate) AS INT) AS month FROM orders)")


def _have_weather(spark, d):
    o = S.table(spark, d, "orders")
    return o.select(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")).distinct()


@register("A17_weather_months_missing", O.with_views(["trips_l"], LISTING, PREV, STORE, CLS, MERGED, HAVE_WEATHER) +
          "SELECT DISTINCT year, month FROM merged WHERE (year, month) NOT IN (SELECT (year, month) FROM have)")
def q_a17(spark, d):
    return A.missing_months(A.months_covered(_merged(listed(spark, d))), _have_weather(spark, d))


@register("A18_year_restriction", BASE + "SELECT DISTINCT year, month FROM merged WHERE year IN (1999, 2000)")
def q_a18(spark, d):
    return A.restrict_years(A.months_covered(_merged(listed(spark, d))), [1999, 2000])


SILVER_PATHS = ("paths AS (SELECT 'silver/" + DATASET + "/trips/vehicle_type=' || vehicle_type || '/year=' || "
                "CAST(year AS VARCHAR) || '/month=' || CAST(month AS VARCHAR) || '/part-00000.parquet' AS path "
                "FROM prev UNION ALL SELECT 'silver/" + DATASET + "/trips/vehicle_type=' || vehicle_type || "
                "'/year=' || CAST(year AS VARCHAR) || '/_temporary/0/part-00000.parquet' AS path FROM listing "
                f"WHERE year = {MANIFEST_UNTIL + 1})")
COMMITTED = ("committed AS (SELECT DISTINCT regexp_extract(path, '/vehicle_type=([^/]+)/', 1) AS vehicle_type, "
             "CAST(regexp_extract(path, '/year=([0-9]+)/', 1) AS INT) AS year FROM paths "
             "WHERE path LIKE '%.parquet' AND path NOT LIKE '%/_temporary/%')")
PLAN = ("plan AS (SELECT b.vehicle_type, b.year, b.mois, b.fichiers, CASE WHEN c.vehicle_type IS NULL "
        "THEN 'pending' ELSE 'skipped' END AS statut FROM (SELECT vehicle_type, year, "
        "list(month ORDER BY month) AS mois, CAST(count(*) AS BIGINT) AS fichiers FROM merged "
        "GROUP BY vehicle_type, year) b LEFT JOIN committed c USING (vehicle_type, year))")
RESUME = O.with_views(["trips_l"], LISTING, PREV, STORE, CLS, MERGED, SILVER_PATHS, COMMITTED, PLAN)


def _interrupted_lake(spark, d, files) -> str:
    """A silver folder as an interrupted run leaves it: the partitions of the earlier run, written and recorded;
    one more partition a vehicle that was written but not recorded; and a write that broke off, under ``_temporary``."""
    silver, tags = f"{_run_dir(spark)}/silver/trips", SV.PARTITION_KEYS
    trips = gold.with_all_columns(tl(spark, d)).select(*[f.name for f in TRIP_SCHEMA])
    of = lambda keep: trips.join(F.broadcast(keep.select(*tags)), tags, "left_semi").hint("rebalance", *tags)  # noqa: E731  one row per file
    committed = _prev(files)
    L.write_silver_trips(of(committed), silver)
    committed.select(F.col("key").alias("path"), "size", *tags).coalesce(1).write.parquet(f"{silver}_committed")
    later = files.filter(F.col("year") == MANIFEST_UNTIL + 1)
    L.write_silver_trips(of(later.filter(F.col("month") == 1)), silver)
    of(later).write.partitionBy(*tags).parquet(f"{silver}/_temporary/0")
    return silver


def _plan(spark, d):
    files = listed(spark, d)
    return A.resume_plan(_merged(files), SV.committed_batches(spark, _interrupted_lake(spark, d, files)))


@register("A19_committed_batches", RESUME + "SELECT * FROM committed")
def q_a19(spark, d):
    return SV.committed_batches(spark, _interrupted_lake(spark, d, listed(spark, d)))


@register("A20_resume_plan", RESUME + "SELECT vehicle_type, year, CAST(to_json(mois) AS VARCHAR) AS mois, fichiers, statut FROM plan")
def q_a20(spark, d):
    return _plan(spark, d).withColumn("mois", F.to_json("mois"))


@register("A20_resume_counts", RESUME +
          "SELECT CAST(count(*) FILTER (WHERE statut = 'pending') AS BIGINT) AS ecrits, "
          "CAST(count(*) FILTER (WHERE statut = 'skipped') AS BIGINT) AS ignores FROM plan")
def q_a20b(spark, d):
    return A.resume_counts(_plan(spark, d))


@register("A21_first_batches", RESUME +
          "SELECT vehicle_type, year, statut FROM plan ORDER BY vehicle_type, year LIMIT 5")
def q_a21(spark, d):
    return A.first_batches(_plan(spark, d), 5).select("vehicle_type", "year", "statut")


@register("A22_time_window", BASE +
          "SELECT make_timestamp(min(year), 1, 1, 0, 0, 0) AS debut, "
          "make_timestamp(max(year), 12, 31, 23, 59, 59) AS fin FROM merged")
def q_a22(spark, d):
    return A.manifest_window(_merged(listed(spark, d)))


WEATHER_ENTRIES = ("went AS (SELECT 'weather/' || CAST(year AS VARCHAR) || '/' || lpad(CAST(month AS VARCHAR), 2, "
                   "'0') || '.json' AS key, CAST(1 AS BIGINT) AS size, CAST(NULL AS VARCHAR) AS vehicle_type, "
                   "year, month FROM have)")


@register("A23_dataset_selection", O.with_views(["trips_l"], LISTING, PREV, STORE, CLS, MERGED, HAVE_WEATHER,
                                                 WEATHER_ENTRIES) +
          f"SELECT * FROM (SELECT '{DATASET}' AS dataset_id, 'trips' AS kind, * FROM merged UNION ALL "
          "SELECT 'weather' AS dataset_id, 'weather' AS kind, * FROM went) m WHERE kind = 'trips'")
def q_a23(spark, d):
    h = _have_weather(spark, d)
    went = h.select(F.concat(F.lit("weather/"), F.col("year").cast("string"), F.lit("/"),
                             F.lpad(F.col("month").cast("string"), 2, "0"), F.lit(".json")).alias("key"),
                    F.lit(1).cast("bigint").alias("size"), F.lit(None).cast("string").alias("vehicle_type"),
                    "year", "month")
    both = (_merged(listed(spark, d)).select(F.lit(DATASET).alias("dataset_id"), F.lit("trips").alias("kind"), "*")
            .unionByName(went.select(F.lit("weather").alias("dataset_id"), F.lit("weather").alias("kind"), "*")))
    return A.select_kind(both, "trips")


# Two gold runs: one without weather and zones, one whose trips have no surcharges (so that mart is missing).
@register("A25_mart_completeness", O.with_views(["trips_l", "trips_e"]) +
          "SELECT 'trips-l' AS dataset_id, '[]' AS manquants, true AS complet WHERE EXISTS (SELECT 1 FROM trips_l) UNION ALL "
          "SELECT 'trips-e', '[\"surcharge_evolution\"]', false WHERE EXISTS (SELECT 1 FROM trips_e)")
def q_a25(spark, d):
    out = _run_dir(spark)
    gold.run(spark, tl(spark, d), None, out, surcharges=S.TRIPS_L_SURCHARGES, width=S.TRIPS_L_BIN_WIDTH, dataset_id="trips-l")
    gold.run(spark, te(spark, d), we(spark, d), out, zones=S.zones_s(spark, d), surcharges=[], dataset_id="trips-e")
    return A.mart_completeness(gold.present_marts(spark, out)).withColumn("manquants", F.to_json("manquants"))


def _status_sql(view):
    return (O.with_views([view, "weather_e"]) +
            "SELECT CASE WHEN count(*) > 0 THEN 'ok' ELSE 'en_attente' END AS statut, "
            "CAST(count(*) AS BIGINT) AS heures FROM weather_e WHERE (CAST(year(ts) AS INT), CAST(month(ts) AS INT)) "
            f"IN (SELECT (year, month) FROM {view})")


def _status(trips, weather):
    months = trips.select("year", "month").distinct()
    hours = weather.join(months, (F.year("ts") == months.year) & (F.month("ts") == months.month), "left_semi")
    return A.weather_status(hours)


@register("A26_weather_status_lineitem", _status_sql("trips_l"))
def q_a26(spark, d):
    return _status(tl(spark, d), we(spark, d))


@register("A26_weather_status_events", _status_sql("trips_e"))
def q_a26b(spark, d):
    return _status(te(spark, d), we(spark, d))


@register("A27_lineage", BASE +
          f"SELECT '{DATASET}' AS dataset_id, CAST(NULL AS VARCHAR) AS source_dir, false AS sample_mode, "
          "CAST(sum(size) AS BIGINT) AS taille_octets FROM merged")
def q_a27(spark, d):
    # the generation time differs per run, so the compared frame leaves it out
    return A.lineage(A.summarize(_merged(listed(spark, d)), DATASET)).drop("genere_le")
