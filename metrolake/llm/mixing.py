"""Mixing sources to target weights over fixed-length blocks of words.

Each source's documents form one stream of words, cut into blocks of
``BLOCK`` words. An output shard has ``SLOTS`` slots; a multinomial draw says
how many go to each source. A source's k-th slot overall takes block
``perm(k mod n)`` of its pass ``k div n``, where every pass has a pseudorandom
permutation of its own, so any slot finds its block without a shuffled copy of
the source. Slots and blocks meet in a join on (source, block).
"""
from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from metrolake.llm import store

BLOCK = 64                  # words in a block
SLOTS = 4096                # slots of an output shard
WEIGHTS = (1.0, 2.0, 3.0)   # by rank of the source, repeating
MOST = 3                    # most passes over a source
SEED = 20_24
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def word_count(text: pd.Series) -> pd.Series:
    """Words ``[^\\x20\\x09-\\x0D]+`` of each text (null: 0). Splitting UTF-8 at ASCII white space finds the same words."""
    return pd.Series([len(t.encode("utf-8", "surrogatepass").split()) if t else 0 for t in text], dtype="int64")


def targets(sizes: DataFrame, source: str = "source", size: str = "size", weights: tuple = WEIGHTS, most: float = MOST) -> DataFrame:
    """One row per source: source, rank (by code point, null last), source_size,
    weight, target. The targets share all sizes by weight, none above ``most``
    times its source: min(most * size, level * weight) with the one level at
    which they sum to the total, which is where resharing the excess ends. With
    the sources in order of cap over weight, the level grows as long as capping
    one more source frees weight for the rest, so it is the greatest of all cuts.

    ``sizes`` needs one row per document; sums are taken before the shuffle, and
    the windows read one row per source."""
    by = Window.orderBy(F.asc_nulls_last("source"))
    w = F.array(*[F.lit(float(x)) for x in weights])
    per = (sizes.groupBy(F.col(source).alias("source")).agg(F.sum(size).alias("source_size"))
           .withColumn("rank", (F.row_number().over(by) - 1).cast("int"))
           .withColumn("weight", F.element_at(w, F.col("rank") % len(weights) + 1))
           .withColumn("_cap", most * F.col("source_size")))
    full = Window.orderBy(F.col("_cap") / F.col("weight"), "rank")
    below, rest = full.rowsBetween(Window.unboundedPreceding, -1), full.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(0))
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("_cap").over(below), F.lit(0))) / F.sum("weight").over(rest)
    return (per.withColumn("_level", level)
            .withColumn("_level", F.max("_level").over(everything))
            .select("source", "rank", "source_size", "weight",
                    F.least(F.col("_cap").cast("double"), F.coalesce(F.col("_level") * F.col("weight"), F.lit(0.0))).alias("target")))


def permute(i: np.ndarray, n: int, key: int) -> np.ndarray:
    """Pseudorandom permutation of 0..n-1 (n < 2**62) at the places ``i``: a Feistel
    network on the next even number of bits, walked until it lands below n."""
    half = max(1, ((max(n - 1, 1)).bit_length() + 1) // 2)
    low, out = np.uint64((1 << half) - 1), i.astype(np.uint64)
    todo = np.ones(len(out), bool)
    while todo.any():
        x = out[todo]
        left, right = x >> np.uint64(half), x & low
        for r in range(4):
            h = (right + np.uint64((key * 4 + r + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) * np.uint64(0xBF58476D1CE4E5B9)
            h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
            left, right = right, left ^ ((h ^ (h >> np.uint64(32))) & low)
        x = (left << np.uint64(half)) | right
        out[todo] = x
        todo[todo] = x >= np.uint64(n)
    return out.astype(np.int64)


def draw(shard: int, shares: np.ndarray, slots: int, seed: int = SEED) -> np.ndarray:
    """Slots of each source in a shard: the whole part of its share, and a multinomial
    draw for what is left, so counts keep their mean and vary by the remainders only."""
    mean = shares * slots
    count = np.floor(mean).astype(np.int64)
    left = slots - int(count.sum())
    if left > 0:
        odds = mean - count
        count += np.random.default_rng([seed, shard]).multinomial(left, odds / odds.sum())
    return count


def streams(docs: DataFrame, source: str, key: str, size: str) -> DataFrame:
    """Each document's place in its source's stream: _src (source), _start (words
    before it). Order within a source is by hash bucket, key, size and text hash; the offset
    of a bucket comes from sums per bucket, so a hot source is spread."""
    n = store.buckets_for(docs.count(), 4_000)
    rows = docs.withColumn("_bucket", F.pmod(F.xxhash64(F.col(key).cast("string"), F.col(size)), F.lit(n)).cast("int"))
    before = store.offsets(rows, [source], "_bucket", F.col(size), "_before")
    w = Window.partitionBy(source, "_bucket").orderBy(key, size, "hash").rowsBetween(Window.unboundedPreceding, -1)
    return (rows.withColumn("_in", F.coalesce(F.sum(size).over(w), F.lit(0)))
            .join(before.withColumnRenamed("_bucket", "_b2").withColumnRenamed(source, "_s2"),
                  F.col(source).eqNullSafe(F.col("_s2")) & (F.col("_bucket") == F.col("_b2")))
            .withColumn("_start", F.col("_in") + F.col("_before")).drop("_b2", "_s2", "_bucket", "_in", "_before"))


def slots(per_source: pd.DataFrame, spark, slots_each: int = SLOTS, block: int = BLOCK, most: int = MOST, seed: int = SEED) -> DataFrame:
    """The mix's plan: shard, slot, rank (of the source), epoch, block. One row per
    slot; a source at its most passes leaves the slots beyond them out.

    Draws are counted per shard first; a source's count before a shard is summed
    over runs of shards, then within the run, so no window holds all shards."""
    p = per_source.sort_values("rank")
    size, target = p["source_size"].to_numpy(float), p["target"].to_numpy(float)
    n_blocks = -(-p["source_size"].to_numpy(np.int64) // block)
    wanted = np.where(size > 0, target * n_blocks / np.maximum(size, 1), 0.0)      # slots that give the target on average
    total = int(np.ceil(wanted.sum()))
    empty = "shard long, slot int, rank int, epoch int, block long"
    if total == 0:
        return spark.createDataFrame([], empty)
    shares, n_shards = wanted / wanted.sum(), -(-total // slots_each)
    last = total - (n_shards - 1) * slots_each

    def drawn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for s in b["id"]:
                c = draw(int(s), shares, last if s == n_shards - 1 else slots_each, seed)
                yield pd.DataFrame({"shard": int(s), "rank": np.arange(len(c), dtype=np.int32), "n": c})

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def parts() -> Iterator[dict]:
            for b in batches:
                for s, r, n, first, before in b[["shard", "rank", "n", "first", "before"]].itertuples(index=False):
                    k = np.arange(first, first + n, dtype=np.int64)
                    epoch, i = k // n_blocks[r], k % n_blocks[r]
                    out = np.empty(n, np.int64)
                    for e in np.unique(epoch):
                        at = epoch == e
                        out[at] = permute(i[at], int(n_blocks[r]), (seed * 1_000_003 + int(r)) * 64 + int(e))
                    some = epoch < most
                    yield {"shard": s, "slot": np.arange(before, before + n, dtype=np.int32)[some], "rank": r,
                           "epoch": epoch.astype(np.int32)[some], "block": out[some]}

        return store.gather(parts())

    parts = min(2048, -(-n_shards // 8))                # tasks that place slots; drawing is lighter
    counts = spark.range(0, n_shards, 1, -(-parts // 4)).mapInPandas(drawn, "shard long, rank int, n long").where("n > 0") \
        .withColumn("run", F.floor(F.col("shard") / 1024))
    before = store.offsets(counts, ["rank"], "run", F.col("n"), "_before")
    w = Window.partitionBy("rank", "run").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    in_shard = Window.partitionBy("shard").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    return (counts.withColumn("first", F.coalesce(F.sum("n").over(w), F.lit(0))).join(before, ["rank", "run"])
            .withColumn("first", F.col("first") + F.col("_before"))
            .withColumn("before", F.coalesce(F.sum("n").over(in_shard), F.lit(0)))
            .select("shard", "rank", "n", "first", "before").repartition(parts, "shard").mapInPandas(placed, empty))


def pieces(placed: DataFrame, size: str = "size", block: int = BLOCK) -> DataFrame:
    """Rows of ``placed`` once per block they reach into: block, at (first word of
    the piece in the document), n (words of the piece)."""
    end = F.col("_start") + F.col(size)
    first, last = F.floor(F.col("_start") / block), F.floor((end - 1) / block)
    return (placed.where(F.col(size) > 0).withColumn("block", F.explode(F.sequence(first, last)))
            .withColumn("at", F.greatest(F.lit(0), F.col("block") * block - F.col("_start")))
            .withColumn("n", F.least(end, (F.col("block") + 1) * block) - F.col("_start") - F.col("at")))


class Mix:
    """The mix of a table: ``per_source`` (targets), ``plan`` (slots), ``documents``
    (sizes and places in the streams). Null texts and texts without words have
    size 0 and are never taken; null sources are a source of their own; repeated
    rows count each; an empty table gives an empty mix. Sources carry one weight
    each, so their table (not the documents') comes to the driver."""

    def __init__(self, docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
                 weights: tuple = WEIGHTS, most: int = MOST, block: int = BLOCK, seed: int = SEED):
        spark = docs.sparkSession
        self.block, self.most = block, most
        count = F.pandas_udf(word_count, "long")
        sized = store.materialize(docs.select(F.col(key).alias("doc_id"), F.col(source).cast("string").alias("source"),
                                              F.xxhash64(F.col(text).cast("string")).alias("hash"), count(F.col(text).cast("string")).alias("size")))
        rows = targets(sized, weights=weights, most=most).toPandas()
        self.per_source = spark.createDataFrame(rows, "source string, rank int, source_size long, weight double, target double") if len(rows) \
            else spark.createDataFrame([], "source string, rank int, source_size long, weight double, target double")
        ranked = F.broadcast(self.per_source.select(F.col("source").alias("_name"), "rank", "source_size", "target"))   # one row per source
        self.documents = streams(sized, "source", "doc_id", "size") \
            .join(ranked, F.col("source").eqNullSafe(F.col("_name"))).drop("_name")
        self.plan = slots(rows, spark, block=block, most=most, seed=seed) if len(rows) else spark.createDataFrame([], "shard long, slot int, rank int, epoch int, block long")

    def taken(self) -> DataFrame:
        """Per document: doc_id, size, source_size, target, taken (words in the mix, repeats counted)."""
        times = self.plan.groupBy("rank", "block").agg(F.count("*").alias("times"))
        out = ["doc_id", "size", "source_size", "target"]
        got = (pieces(self.documents, block=self.block).join(times, ["rank", "block"], "left")
               .groupBy("rank", "_start", *out).agg(F.sum(F.col("n") * F.coalesce(F.col("times"), F.lit(0))).alias("taken")).select(*out, "taken"))
        return got.unionByName(self.documents.where("size = 0").select(*out, F.lit(0).cast("long").alias("taken")))

    def blocks(self) -> DataFrame:
        """The mix itself, without texts: shard, slot, epoch, the document (doc_id, source,
        hash, and nth among its repeated rows) and its word range in the slot (at, n)."""
        nth = Window.partitionBy("doc_id", "hash", "source").orderBy("_start")
        cut = pieces(self.documents.withColumn("nth", F.row_number().over(nth)), block=self.block)
        return self.plan.join(cut, ["rank", "block"]).select("shard", "slot", "epoch", "doc_id", "hash", "source", "nth", "at", "n")


def _cut(text: str, ranges: list) -> str:
    """The words of a text in the given (first, count) ranges, with the white space
    between them; ranges that touch are one, others are joined by a line feed."""
    raw, merged = text.encode("utf-8", "surrogatepass"), []
    for at, n in sorted(ranges):
        if merged and merged[-1][1] == at:
            merged[-1][1] = at + n
        else:
            merged.append([at, at + n])
    spans = [m.span() for m in _WORD.finditer(raw)]
    if merged == [[0, len(spans)]]:
        return text
    return b"\n".join(raw[spans[a][0]:spans[b - 1][1]] for a, b in merged).decode("utf-8", "surrogatepass")


def mixed_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", chars: str | None = "n_chars", **options) -> DataFrame:
    """``docs`` as the mix takes them, with the same columns: one row per document
    and pass in which any of its words are taken, its text cut to those words
    (whole where all are). Repeated rows are taken one by one; texts without words
    are not in the mix."""
    mix = Mix(docs, key, text, source, **options)
    ids = ["doc_id", "hash", "source", "nth"]
    ranges = mix.blocks().groupBy(*ids, "epoch").agg(F.collect_list(F.struct("at", "n")).alias("__mix_ranges")).drop("epoch")
    ranges = ranges.toDF(*[f"__mix_{c}" for c in ids], "__mix_ranges")

    @F.pandas_udf("string")
    def cut(texts: pd.Series, ranges: pd.Series) -> pd.Series:
        return pd.Series([_cut(t, [(r["at"], r["n"]) for r in rs]) for t, rs in zip(texts, ranges)], dtype=object)

    h = F.xxhash64(F.col(text).cast("string"))
    whole = docs.withColumn("__own_hash", h).withColumn("__own_nth", F.row_number().over(
        Window.partitionBy(key, "__own_hash", source).orderBy(F.lit(0))))
    same = (F.col(key).cast("string").eqNullSafe(F.col("__mix_doc_id").cast("string")) & (F.col("__own_hash") == F.col("__mix_hash"))
            & F.col(source).cast("string").eqNullSafe(F.col("__mix_source")) & (F.col("__own_nth") == F.col("__mix_nth")))
    out = whole.join(ranges, same).withColumn(text, cut(F.col(text).cast("string"), F.col("__mix_ranges")))
    if chars and chars in docs.columns:
        out = out.withColumn(chars, F.length(text).cast(docs.schema[chars].dataType))
    return out.select(*docs.columns)
