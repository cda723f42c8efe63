"""Shared helpers: tables that cut lineage, two-level ranks and prefix sums."""
from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

_local: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables: the one named in ``spark.checkpoint.dir``
    (or set on the context). Only a local master may fall back to a folder of
    its own; a cluster without the setting is an error, because its executors
    share no local disk."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if d:
        return d.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local:
        _local[app] = tempfile.mkdtemp(prefix="metrolake-llm-")
    return _local[app]


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: lineage is
    cut, and a lost executor never repeats what went before."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """While an action runs inside, tasks hand at most ``rows`` rows at a time to Python;
    the caller's setting is put back afterwards. For passes over whole texts."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def buckets_for(n_rows: int, rows_each: int = 20_000) -> int:
    """Number of hash buckets that keep about ``rows_each`` rows in each."""
    return max(1, -(-n_rows // rows_each))


def offsets(df: DataFrame, group: list[str], bucket: str, value: Column, name: str) -> DataFrame:
    """For each (group, bucket) the sum of ``value`` over the group's smaller
    buckets. Partial sums are taken before the shuffle, and the running sum
    reads one row per bucket, so a hot group costs as much as any other."""
    sums = df.groupBy(*group, bucket).agg(F.sum(value).alias("_sum"))
    w = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    return sums.select(*group, bucket, F.coalesce(F.sum("_sum").over(w), F.lit(0)).cast("long").alias(name))


def gather(parts: Iterator[dict], rows: int = 50_000) -> Iterator[pd.DataFrame]:
    """Few larger frames from many small column sets: arrays of one length, and
    whole numbers (or null) that hold for all of the set's rows."""
    def flush(held: list[dict]) -> pd.DataFrame:
        out = {}
        for name in held[0]:
            cols = [h[name] for h in held]
            if isinstance(cols[0], np.ndarray):
                out[name] = np.concatenate(cols)
            else:
                sizes = [next(len(v) for v in h.values() if isinstance(v, np.ndarray)) for h in held]
                none = np.repeat([pd.isna(c) for c in cols], sizes)
                out[name] = pd.arrays.IntegerArray(np.repeat(np.array([0 if pd.isna(c) else int(c) for c in cols], np.int64), sizes), none)
        return pd.DataFrame(out)

    held, n = [], 0
    for part in parts:
        held.append(part)
        n += next(len(v) for v in part.values() if isinstance(v, np.ndarray))
        if n >= rows:
            yield flush(held)
            held, n = [], 0
    if held:
        yield flush(held)
