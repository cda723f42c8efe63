"""A24 with a sink that appends by epoch: every raw row is written once.

Each micro-batch is normalized in the stream itself and written to a folder of its
own, named by stream and epoch; then the folder is recorded in a log. Readers
take recorded folders only, so a half-written or replayed batch is never seen twice: a
replay overwrites its folder and its record says the same. :func:`compact` folds recorded
epochs into month partitions, in a new folder that holds the touched months whole,
and records which epochs and months it replaces in one row; until that row is there, readers
see the epochs, afterwards the months.
"""
from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from metrolake.operators import normalize as N
from metrolake.schemas import TRIP_SCHEMA
from metrolake.sources import lake as L
from metrolake.streaming.ingest import TAGS, raw_stream

LOG = "stream string, epoch long, path string"
COMPACTIONS = "at long, path string, epochs array<struct<stream:string,epoch:long>>, months array<string>"


def _month() -> Column:
    """A (vehicle, year, month) partition as one text; filters on it prune folders."""
    return F.concat_ws("/", *[F.col(t).cast("string") for t in TAGS])


def ingest(spark: SparkSession, raw_dir: str, raw_schema: T.StructType, base: str, checkpoint: str, stream: str,
           window_years: tuple[int, int], strict_case: bool = False, tag_from_name: bool = True,
           max_files_per_trigger: int | None = None) -> int:
    """Process every raw file not yet consumed, then stop; returns the number of micro-batches written.
    ``stream`` names the source: epochs of different streams share ``base``."""
    raw = raw_stream(spark, raw_dir, raw_schema, max_files_per_trigger)
    if tag_from_name:
        raw = raw.select("*", F.col("_metadata.file_name").alias("_file_name"))
        trips = N.tag_from_file_name(N.normalize(raw, strict_case=strict_case, keep=["_file_name"]), F.col("_file_name")).drop("_file_name")
    else:
        trips = N.normalize(raw, strict_case=strict_case, keep=TAGS)
    trips = N.keep_in_window(trips, *N.time_window(*window_years)).select(*[F.col(f.name).cast(f.dataType) for f in TRIP_SCHEMA])
    written = []

    def write_batch(batch: DataFrame, epoch: int) -> None:
        path = f"{base}/epochs/{stream}-{epoch}"
        batch.write.mode("overwrite").parquet(path)
        record(spark, base, stream, epoch, path)
        written.append(epoch)

    query = (trips.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    return len(written)


def record(spark: SparkSession, base: str, stream: str, epoch: int, path: str) -> None:
    spark.createDataFrame([(stream, epoch, path)], LOG).coalesce(1).write.mode("append").parquet(f"{base}/_log")


def _compactions(spark: SparkSession, base: str) -> list:
    return L.read_if_present(spark, COMPACTIONS, f"{base}/_compactions").orderBy("at").collect()


def _live_epochs(spark: SparkSession, base: str, done: list) -> list:
    """Recorded epochs that no compaction has folded (file metadata only)."""
    folded = {(e["stream"], e["epoch"]) for c in done for e in c["epochs"]}
    rows = L.read_if_present(spark, LOG, f"{base}/_log").distinct().orderBy("stream", "epoch").collect()
    return [r for r in rows if (r["stream"], r["epoch"]) not in folded]


def _compacted(spark: SparkSession, done: list) -> list[DataFrame]:
    """Each compaction's months that no later one replaces."""
    out, later = [], set()
    for c in reversed(done):
        own = set(c["months"]) - later
        if own:
            out.append(spark.read.schema(TRIP_SCHEMA).parquet(c["path"]).where(_month().isin(sorted(own))))
        later |= own
    return out


def read(spark: SparkSession, base: str) -> DataFrame:
    """All recorded rows, each once (no rows before the first epoch)."""
    done = _compactions(spark, base)
    parts = _compacted(spark, done)
    epochs = [r["path"] for r in _live_epochs(spark, base, done)]
    if epochs:
        parts.append(spark.read.schema(TRIP_SCHEMA).parquet(*epochs))
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], TRIP_SCHEMA)


def compact(spark: SparkSession, base: str) -> int:
    """Fold the recorded epochs into month partitions; returns the number of months rewritten.

    Only months with new rows are rewritten. Files are of even size: the write is rebalanced on the
    partition columns, and a large month is spread over several tasks. One compaction runs at a time."""
    done = _compactions(spark, base)
    epochs = _live_epochs(spark, base, done)
    if not epochs:
        return 0
    new = spark.read.schema(TRIP_SCHEMA).parquet(*[r["path"] for r in epochs])
    months = sorted(r[0] for r in new.select(_month()).distinct().collect())
    old = [df.where(_month().isin(months)) for df in _compacted(spark, done)]
    path = f"{base}/months/{len(done)}-{uuid.uuid4().hex}"
    reduce(DataFrame.unionByName, old, new).hint("rebalance", *TAGS).write.partitionBy(*TAGS).parquet(path)
    row = (len(done), path, [(r["stream"], r["epoch"]) for r in epochs], months)
    spark.createDataFrame([row], COMPACTIONS).coalesce(1).write.mode("append").parquet(f"{base}/_compactions")
    return len(months)
