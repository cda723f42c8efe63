"""Ingestion bookkeeping as DataFrame plans.

A manifest is a set of entries ``(key, size, vehicle_type, year, month)`` per
dataset. Every step is a join, filter or small aggregation over entry frames
(one row per file, a few thousand at most), so nothing is looped over on the
driver and re-running a step is idempotent.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from metrolake import constants as K
from metrolake.schemas import MANIFEST_SCHEMA  # noqa: F401  (re-exported)

ENTRY_COLS = ["key", "size", "vehicle_type", "year", "month"]


def select_kind(manifests: DataFrame, kind: str = "trips") -> DataFrame:
    """Manifests of one kind."""
    return manifests.filter(F.col("kind") == kind)


def entries(manifests: DataFrame) -> DataFrame:
    """Manifest documents -> one row per registered file."""
    return manifests.select("dataset_id", "kind", F.explode("files").alias("f")).select(
        "dataset_id", "kind", *[F.col(f"f.{c}").alias(c) for c in ENTRY_COLS])


def bronze_key(dataset_id, vehicle_type, year, month, name) -> F.Column:
    """Object key ``<dataset>/<vehicle>/<YYYY>/<MM>/<file name>``."""
    c = lambda x: F.col(x) if isinstance(x, str) else x
    return F.concat_ws("/", c(dataset_id), c(vehicle_type), c(year).cast("string"),
                       F.lpad(c(month).cast("string"), 2, "0"), c(name))


def classify(discovered: DataFrame, manifest: DataFrame, store_keys: DataFrame,
             compare_size: bool = False) -> DataFrame:
    """A11 + A12: each discovered file is ``skipped`` (key in the manifest),
    ``healed`` (object already stored but missing from the manifest: register,
    do not copy) or ``new``. Two left joins on key; entry frames are small.
    With ``compare_size`` a known key whose size differs is ``changed``
    (to be re-registered) instead of skipped."""
    known = manifest.select("key", F.lit(True).alias("_known"), F.col("size").alias("_known_size"))
    stored = store_keys.select("key", F.lit(True).alias("_stored")).distinct()
    j = discovered.join(known, "key", "left").join(stored, "key", "left")
    status = F.when(F.col("_known"), F.lit("skipped"))
    if compare_size:
        status = F.when(F.col("_known") & ~F.col("size").eqNullSafe(F.col("_known_size")), F.lit("changed")) \
                  .when(F.col("_known"), F.lit("skipped"))
    status = status.when(F.col("_stored"), F.lit("healed")).otherwise(F.lit("new"))
    return j.withColumn("status", status).drop("_known", "_stored", "_known_size")


def new_files(discovered: DataFrame, manifest: DataFrame) -> DataFrame:
    """Discovered files whose key is not in the manifest."""
    return discovered.join(manifest.select("key"), "key", "left_anti")


def merge_entries(old: DataFrame, new: DataFrame) -> DataFrame:
    """Upsert by key, the new entry wins, sorted by key. Where ``old`` has several
    entries of a key, the latest run's (column ``run``, if there is one) and then the largest wins."""
    run = F.col("run") if "run" in old.columns else F.lit(0)
    o = old.select(*ENTRY_COLS, F.lit(0).alias("_p"), run.cast("long").alias("_run"))
    n = new.select(*ENTRY_COLS, F.lit(1).alias("_p"), F.lit(0).cast("long").alias("_run"))
    best = F.max_by(F.struct(*ENTRY_COLS), F.struct("_p", "_run", "size", "vehicle_type", "year", "month")).alias("_e")
    return (o.unionByName(n).groupBy("key").agg(best)
             .select(*[F.col(f"_e.{c}").alias(c) for c in ENTRY_COLS]).orderBy("key"))


def summarize(entries_df: DataFrame, dataset_id: str, source_dir: str | None = None,
              sample_n: int = 0) -> DataFrame:
    """Manifest totals: sorted distinct years, total bytes, file count, sample flag."""
    return entries_df.agg(
        F.sort_array(F.collect_set("year")).alias("trip_years"),
        F.sum("size").cast("bigint").alias("taille_octets"),
        F.count(F.lit(1)).alias("fichiers"),
    ).select(F.lit(dataset_id).alias("dataset_id"), F.lit("trips").alias("kind"),
             F.lit(source_dir).cast("string").alias("source_dir"),
             F.lit(bool(sample_n and sample_n > 0)).alias("sample_mode"), "*")


def manifest_document(entries_df: DataFrame, dataset_id: str, source_dir: str | None = None,
                      sample_n: int = 0) -> DataFrame:
    """The whole manifest as one row shaped like the manifest JSON."""
    files = entries_df.agg(F.sort_array(F.collect_list(F.struct(*ENTRY_COLS))).alias("files"))
    return summarize(entries_df, dataset_id, source_dir, sample_n).withColumn("files", files.scalar())


def coverage_by_vehicle(entries_df: DataFrame) -> DataFrame:
    """Vehicle types ingested, first / last (year, month) and file count."""
    ym = F.col("year") * 100 + F.col("month")
    return entries_df.groupBy("vehicle_type").agg(
        F.min(ym).alias("premier_mois"), F.max(ym).alias("dernier_mois"),
        F.count(F.lit(1)).alias("fichiers"))


def is_present(entries_df: DataFrame, vehicle_type: str, year: int, month: int) -> DataFrame:
    """Is (vehicle, year, month) already ingested? One boolean row."""
    hit = ((F.col("vehicle_type") == vehicle_type) & (F.col("year") == year) & (F.col("month") == month))
    return entries_df.agg((F.count_if(hit) > 0).alias("present"))


def months_covered(entries_df: DataFrame) -> DataFrame:
    """Distinct (year, month) of trip entries."""
    return entries_df.select("year", "month").distinct()


def restrict_years(df: DataFrame, years) -> DataFrame:
    """Keep the listed years."""
    return df.filter(F.col("year").isin(list(years)))


def missing_months(wanted: DataFrame, have: DataFrame) -> DataFrame:
    """(year, month) wanted but not yet present."""
    return wanted.join(have.select("year", "month"), ["year", "month"], "left_anti")


def committed_batches(paths: DataFrame) -> DataFrame:
    """(vehicle_type, year) batches with at least one committed data file,
    parsed from ``.../vehicle_type=<v>/year=<y>/...parquet`` paths (``_temporary``
    leftovers of an interrupted write are ignored)."""
    files = paths.filter(F.col("path").endswith(".parquet") & ~F.col("path").contains("/_temporary/"))
    v = F.regexp_extract("path", r"/vehicle_type=([^/]+)/", 1)
    y = F.regexp_extract("path", r"/year=([0-9]+)/", 1)
    return (files.select(v.alias("vehicle_type"), y.cast("int").alias("year"))
                 .filter(F.col("vehicle_type") != "").distinct())


def resume_plan(entries_df: DataFrame, committed: DataFrame,
                keys=("vehicle_type", "year")) -> DataFrame:
    """Group entries into batches, mark committed batches ``skipped`` and the
    rest ``pending``, in batch order, with each batch's sorted months."""
    keys = list(keys)
    batches = entries_df.groupBy(*keys).agg(
        F.sort_array(F.collect_list("month")).alias("mois"),
        F.count(F.lit(1)).alias("fichiers"))
    done = committed.select(*keys).distinct().withColumn("_done", F.lit(True))
    return (batches.join(done, keys, "left")
                   .withColumn("statut", F.when(F.col("_done"), F.lit("skipped")).otherwise(F.lit("pending")))
                   .drop("_done").orderBy(*keys))


def first_batches(plan: DataFrame, n: int = 0, keys=("vehicle_type", "year")) -> DataFrame:
    """Only the first ``n`` batches in order (0 = all)."""
    return plan.orderBy(*keys).limit(n) if n and n > 0 else plan


def resume_counts(plan: DataFrame) -> DataFrame:
    """Batches written vs skipped."""
    return plan.agg(F.count_if(F.col("statut") == "pending").alias("ecrits"),
                    F.count_if(F.col("statut") == "skipped").alias("ignores"))


def manifest_window(entries_df: DataFrame) -> DataFrame:
    """Global time window over all entries: [min year-01-01, max year-12-31 23:59:59]."""
    from metrolake.operators.normalize import time_window
    lo, hi = time_window(F.col("_lo"), F.col("_hi"))
    return (entries_df.agg(F.min("year").alias("_lo"), F.max("year").alias("_hi"))
                      .select(lo.alias("debut"), hi.alias("fin")))


def mart_completeness(present: DataFrame, required=K.REQUIRED_MARTS) -> DataFrame:
    """Per dataset, the required marts that are missing and whether the
    dataset can be served (no mart missing)."""
    datasets = present.select("dataset_id").distinct()
    wanted = _expand(datasets, required)
    missing = wanted.join(present.select("dataset_id", "mart"), ["dataset_id", "mart"], "left_anti")
    agg = missing.groupBy("dataset_id").agg(F.sort_array(F.collect_list("mart")).alias("manquants"))
    return (datasets.join(agg, "dataset_id", "left")
                    .select("dataset_id", F.coalesce(F.col("manquants"), F.array().cast("array<string>"))
                            .alias("manquants"))
                    .withColumn("complet", F.size("manquants") == 0))


def _expand(datasets: DataFrame, required) -> DataFrame:
    """Each dataset x each required mart, via an array literal (no join)."""
    return datasets.select("dataset_id", F.explode(F.array(*[F.lit(m) for m in required])).alias("mart"))


def weather_status(weather_hours: DataFrame) -> DataFrame:
    """A26: 'ok' when weather hours exist, else 'en_attente' (and no rows to serve)."""
    n = weather_hours.agg(F.count(F.lit(1)).alias("n"))
    return n.select(F.when(F.col("n") > 0, F.lit(K.WEATHER_READY))
                     .otherwise(F.lit(K.WEATHER_PENDING)).alias("statut"), F.col("n").alias("heures"))


def lineage(summary: DataFrame) -> DataFrame:
    """Mart lineage record: dataset, source, sample flag, bytes, generation time."""
    return summary.select("dataset_id", "source_dir", "sample_mode", "taille_octets",
                          F.current_timestamp().alias("genere_le"))
