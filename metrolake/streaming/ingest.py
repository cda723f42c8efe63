"""Idempotent, interruptible ingestion as a Structured Streaming job.

A file stream over the raw directory of one layout, run with
``trigger(availableNow=True)``: each run processes the files that arrived since
the last run and stops. The checkpoint records which files were consumed, so
"already seen" needs no manifest lookup and an interrupted run resumes from
the last committed micro-batch.

Each micro-batch names the (vehicle, year, month) partitions that got files;
they are rebuilt from all their raw files (normalized, filtered to the window)
and replaced with dynamic partition overwrite. Files of one partition may
therefore arrive in any number of micro-batches or runs, and a replayed
micro-batch rewrites the same rows: the sink is idempotent. A rebuild reads the folders of
its own partitions only, and a partition is not rebuilt again in the same run for a file that its last rebuild held.
"""
from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from metrolake.operators import normalize as N
from metrolake.sources import lake as L
from metrolake.sources import raw as R

TAGS = ["vehicle_type", "year", "month"]


def raw_stream(spark: SparkSession, raw_dir: str, raw_schema: T.StructType,
               max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming scan of raw parquet files of one layout (explicit schema)."""
    r = spark.readStream.schema(raw_schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.parquet(raw_dir)


def _plain(path: str) -> str:
    """A path in one spelling: listings write ``file:///``, rows ``file:/``."""
    return re.sub(r"^(\w+):/+", r"\1:/", path)


def _rebuilt(spark: SparkSession, raw_dir: str, raw_schema: T.StructType, touched: list[tuple],
             strict_case: bool, tag_from_name: bool) -> tuple[DataFrame, list[str]]:
    """All raw rows of the touched partitions, normalized, and the paths that were listed for it. Only
    file names and partition tags reach the driver."""
    if tag_from_name:
        parts = spark.createDataFrame(touched, "vehicle_type string, year int, month int")
        files = R.discover_files(spark, raw_dir).join(parts, TAGS, "left_semi")
        paths = [r.path for r in files.select("path").collect()]
        raw = spark.read.schema(raw_schema).parquet(*paths)
        norm = N.normalize(raw.select("*", F.col("_metadata.file_name").alias("_file_name")), strict_case=strict_case, keep=["_file_name"])
        return N.tag_from_file_name(norm, F.col("_file_name")).drop("_file_name"), raw.inputFiles()
    # a filter on partition columns alone, with literals: folders of other partitions are not read (a join reads them all)
    named = ["/".join(str(t) for t in p) for p in touched if None not in p]
    own = F.concat_ws("/", *[F.col(t).cast("string") for t in TAGS]).isin(named)
    raw = spark.read.schema(raw_schema).parquet(raw_dir).where(own & F.concat(*TAGS).isNotNull())
    return N.normalize(raw, strict_case=strict_case, keep=TAGS), raw.inputFiles()


def ingest(spark: SparkSession, raw_dir: str, raw_schema: T.StructType, silver_base: str,
           checkpoint: str, window_years: tuple[int, int], strict_case: bool = False,
           tag_from_name: bool = True, max_files_per_trigger: int | None = None) -> int:
    """Process every raw file not yet consumed, then stop; returns the number of
    micro-batches that carried data. Trips outside ``window_years`` (first, last),
    or without a pickup time, are not kept (B8)."""
    stream = raw_stream(spark, raw_dir, raw_schema, max_files_per_trigger)
    path = F.col("_metadata.file_path").alias("_path")
    if tag_from_name:   # the source file name is only visible on the stream, not in foreachBatch
        stream = N.tag_from_file_name(stream.select(path, F.col("_metadata.file_name").alias("_file_name")), F.col("_file_name"))
    stream, carried, held = stream.select(*TAGS, "_path" if tag_from_name else path), [], {}

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        files = [(tuple(r[t] for t in TAGS), r["_path"]) for r in batch.distinct().collect()]     # the batch's files and their partitions
        touched = sorted({part for part, path in files if _plain(path) not in held.get(part, ())}, key=str)
        if touched:
            norm, paths = _rebuilt(spark, raw_dir, raw_schema, touched, strict_case, tag_from_name)
            L.write_silver_trips(N.keep_in_window(norm, *N.time_window(*window_years)), silver_base)
            held.update(dict.fromkeys(touched, frozenset(map(_plain, paths))))
        if files:
            carried.append(epoch_id)

    q = (stream.writeStream.foreachBatch(write_batch)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return len(carried)
