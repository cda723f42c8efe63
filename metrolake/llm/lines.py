"""Line deduplication over levelled sorted runs of line hashes.

A :class:`Runs` index holds, for every line key seen, the number of documents and the
largest document of the batch that brought it first. Each run is a table bucketed and
sorted by hash, and no hash is in two runs. A new batch is written in the same
buckets, merge-anti-joined with every run (no shuffle: both sides lie in the same
buckets), adds what none of them holds as its own run at level 0, and leaves the rest
as a small table of repeats. When a level has ``fan`` runs they are merged into one run
of the next level, so a hash is rewritten once a level and a batch meets at most
``fan - 1`` runs a level.

:func:`deduplicate` deals the documents into batches of falling key ranges. The first
batch that holds a line then also holds the largest document with it, and the sum of
first counts and repeats is the line's number of documents. Lines are keyed by 128-bit
hashes, which stand for the lines.
"""
from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from metrolake.llm import store

SPACE = b" \t\n\x0b\x0c\r"
MIN_CHARS = 20            # code points of a key from which a line counts
NEED = 3                  # documents that make a line a repeated one
BATCHES = 6               # key ranges that come in one after another
FAN = 3                   # runs of a level that are merged into the next
BUCKET_ROWS = 1_000_000   # line hashes in a bucket of a run
SHARE = 1_000             # a line in over 1/SHARE of all places is joined by a broadcast of at most SHARE rows
HASH = ["h", "c"]


def split(text: str | None) -> list[bytes]:
    """The lines of a text (null as empty)."""
    return (text or "").encode("utf-8", "surrogatepass").split(b"\n")


def key_of(line: bytes, least: int = MIN_CHARS) -> bytes | None:
    """A line's key, or None if it has fewer than ``least`` code points: ASCII white space
    stripped at both ends, A-Z lower-cased."""
    key = line.strip(SPACE)
    if len(key) < least or (not key.isascii() and len(key.decode("utf-8", "surrogatepass")) < least):
        return None
    return key.lower()


def hash_of(key: bytes) -> tuple[int, int]:
    """Two signed longs."""
    d = xxhash.xxh3_128_digest(key)
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


class Runs:
    """Levelled sorted runs in ``folder``; ``buckets`` is fixed for the index's life.

    Runs are joined as bucketed tables but put together as plain files: a union of
    bucketed scans loses rows in this Spark version (its output partitioning)."""

    def __init__(self, spark: SparkSession, folder: str, buckets: int, fan: int = FAN):
        self.spark, self.folder, self.buckets, self.fan = spark, folder, buckets, fan
        self.levels: list[list[str]] = [[]]
        self.again: list[str] = []

    def _sorted(self, rows: DataFrame) -> str:
        name = f"run_{uuid.uuid4().hex}"
        (rows.repartition(self.buckets, *HASH).write.bucketBy(self.buckets, *HASH).sortBy(*HASH)
         .option("path", f"{self.folder}/{name}").saveAsTable(name))
        return name

    def _together(self, names: list[str]) -> DataFrame:
        schema = self.spark.table(names[0]).schema
        return self.spark.read.schema(schema).parquet(*[f"{self.folder}/{name}" for name in names])

    @property
    def runs(self) -> list[str]:
        return [name for level in self.levels for name in level]

    def ingest(self, batch: DataFrame) -> DataFrame:
        """Adds a batch of (h, c, docs, keeper), one row a hash, and returns those never seen before."""
        mine = self._sorted(batch)
        if self.runs:
            fresh = whole = self.spark.table(mine)
            for run in self.runs:
                fresh = fresh.join(self.spark.table(run).select(*HASH), HASH, "left_anti")
            mine = self._sorted(fresh)
            self.again.append(self._sorted(whole.join(self.spark.table(mine).select(*HASH), HASH, "left_anti")))
        self.levels[0].append(mine)
        for k, level in enumerate(self.levels):
            if len(level) >= self.fan:
                if k + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[k + 1].append(self._sorted(self._together(level)))
                self.levels[k] = []
        return self.spark.table(mine)

    def found_in(self, need: int) -> DataFrame:
        """(h, c, docs, keeper) of the hashes in at least ``need`` documents."""
        if not self.again:
            return self._together(self.runs).where(F.col("docs") >= need)
        more = self._sorted(self._together(self.again).groupBy(*HASH).agg(F.sum("docs").alias("more")))
        docs = F.col("docs") + F.coalesce("more", F.lit(0))
        found = [self._sorted(self.spark.table(run).join(self.spark.table(more), HASH, "left").withColumn("docs", docs).drop("more").where(F.col("docs") >= need))
                 for run in self.runs]
        return self._together(found)


def places(docs: DataFrame, least: int = MIN_CHARS) -> DataFrame:
    """(k, t, h, c): the distinct line hashes of each document (key k, text hash t)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def parts() -> Iterator[dict]:
            for b in batches:
                for k, t, text in zip(b["k"], b["t"], b["text"]):
                    keys = {key_of(line, least) for line in split(text)} - {None}
                    if keys:
                        both = np.frombuffer(b"".join(xxhash.xxh3_128_digest(x) for x in keys), "<i8").reshape(-1, 2)
                        yield {"k": k, "t": t, "h": both[:, 0], "c": both[:, 1]}

        return store.gather(parts())

    return docs.mapInPandas(run, "k long, t long, h long, c long")


def _bounds(rows: DataFrame, batches: int) -> list[int]:
    """Rising key bounds that cut the rows into about equal batches (a few numbers; any bounds give the same result)."""
    cuts = rows.where("k is not null").approxQuantile("k", [i / batches for i in range(1, batches)], 0.01) if batches > 1 else []
    return sorted({int(c) for c in cuts})


def repeated(found: DataFrame, need: int = NEED, batches: int = BATCHES) -> DataFrame:
    """(h, c, docs, keeper): the lines of ``found`` (a written table of places) in at least ``need`` documents
    (rows of one key are one document), with the largest key that holds them."""
    spark, total = found.sparkSession, found.count()
    bounds = _bounds(found, batches)
    index = Runs(spark, f"{store.shared_dir(spark)}/lines-{uuid.uuid4().hex}", store.buckets_for(total, BUCKET_ROWS))
    edges = [None, *bounds[::-1], None]
    for above, below in zip(edges[1:], edges[:-1]):       # falling: (above, below], the null key in the last one
        part = found
        if below is not None:
            part = part.where((F.col("k") <= below) | F.col("k").isNull() if above is None else F.col("k") <= below)
        if above is not None:
            part = part.where(F.col("k") > above)
        one = part.groupBy(*HASH, "k").agg(F.lit(1).alias("one"))
        index.ingest(one.groupBy(*HASH).agg(F.count(F.lit(1)).alias("docs"), F.max("k").alias("keeper")))
    return index.found_in(need)


def drops(found: DataFrame, lines: DataFrame) -> DataFrame:
    """(k, t, gone): for each document the hashes of lines that it loses, as pairs of longs in one array.
    Lines in very many documents are joined by a broadcast; by their share of all places there are at most ``SHARE`` of them."""
    hot = -(-found.count() // SHARE)
    slim = lines.select(*HASH, "keeper", (F.col("docs") > hot).alias("hot"))
    many = found.join(F.broadcast(slim.where("hot")), HASH)
    few = found.join(slim.where("not hot"), HASH)
    lost = many.unionByName(few).where(~F.col("k").eqNullSafe(F.col("keeper")))
    pairs = F.flatten(F.collect_set(F.array("h", "c")))
    return store.materialize(lost.groupBy("k", "t").agg(pairs.alias("gone")))


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = MIN_CHARS, need: int = NEED,
                batches: int = BATCHES) -> DataFrame:
    """One row per input row: key, n_lines, n_dropped and kept (the remaining lines, joined by line feeds).

    A line whose key has ``least`` code points or more and is found in ``need`` documents
    or more goes everywhere but in the largest document that holds it, where all its copies
    stay. A null or empty text is one empty line; rows with one document key (null
    too, the smallest) are one document; other columns are ignored. An empty table
    gives an empty result."""
    body = F.col(text).cast("string")
    slim = docs.select(F.col(key).cast("long").alias("k"), F.xxhash64(body).alias("t"), body.alias("text"))
    found = store.materialize(places(slim, least))
    gone = drops(found, repeated(found, need, batches)).select(F.col("k").alias("_k"), F.col("t").alias("_t"), "gone")
    both = slim.join(gone, slim["k"].eqNullSafe(F.col("_k")) & (slim["t"] == F.col("_t")), "left").select("k", "text", "gone")

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in parts:
            counts, dropped, kept = [], [], []
            for body, gone in zip(b["text"], b["gone"]):
                lines = split(body)
                rest = lines
                if gone is not None and len(gone):
                    flat = np.asarray(gone).tolist()
                    lost = set(zip(flat[::2], flat[1::2]))
                    rest = [x for x in lines if (y := key_of(x, least)) is None or hash_of(y) not in lost]
                counts.append(len(lines))
                dropped.append(len(lines) - len(rest))
                kept.append((body or "") if rest is lines else b"\n".join(rest).decode("utf-8", "surrogatepass"))
            yield pd.DataFrame({"k": b["k"].astype("Int64"), "n_lines": counts, "n_dropped": dropped, "kept": kept})

    return both.mapInPandas(run, "k long, n_lines long, n_dropped long, kept string").withColumnRenamed("k", key)
