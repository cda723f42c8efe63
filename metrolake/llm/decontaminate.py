"""Benchmark decontamination by greedy string tiling.

Seeds are runs of ``SEED_WORDS`` words that a document shares with a test item
(Karp-Rabin hashes, joined in Spark). For each document and item, seeds on one
diagonal make maximal matches; the longest is marked first, marked words are
not used again, and what is left of the others is tried once more. Tiles may
lie in any order, so a reordered passage is covered as well as a copied one.
"""
from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from metrolake.llm import store
from metrolake.llm.substrings import once

SEED_WORDS = 5
COVERED = 0.8               # least share of an item's words under tiles
BLOCK_WORDS = 1_000_000     # most benchmark words sent to every task at once; more go in further blocks
BROADCAST_ROWS = 1_000_000
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SPACED = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or chr(b).isalnum() else 32 for b in range(256))


def words(text: str | None) -> list[bytes]:
    """Lower-case words of a text; ASCII marks part words as white space does. Null counts as empty."""
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(_SPACED).split()


def rolling(ids: np.ndarray, k: int) -> np.ndarray:
    """Karp-Rabin hashes (mod 2**64) of every run of ``k`` ids; id 0 stands for a
    word that no item has, and a run with it gets hash 0."""
    n = len(ids) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h, known = np.zeros(n, np.uint64), np.ones(n, bool)
    for i in range(k):
        part = ids[i:i + n]
        h = h * _BASE + part
        known &= part != 0
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(k)
    return np.where(known, np.maximum(h, np.uint64(1)), np.uint64(0))


def tiles(hits: list[tuple[int, int]], k: int) -> list[tuple[int, int, int]]:
    """Greedy tiling from seed hits (document place, item place) of ``k`` words:
    (document start, item start, words), longest first, each word in one tile at most."""
    runs, last = [], None
    for p, q in sorted(set(hits), key=lambda x: (x[0] - x[1], x[0])):
        if last and p - q == last[0] - last[1] and p == last[0] + last[2] - k + 1:
            last[2] += 1
        else:
            last = [p, q, k]
            runs.append(last)
    heap = [(-n, p, q) for p, q, n in runs]
    heapq.heapify(heap)
    in_doc, in_item, out = set(), set(), []
    while heap:
        n, p, q = heapq.heappop(heap)
        free = [p + i not in in_doc and q + i not in in_item for i in range(-n)]
        if all(free):
            out.append((p, q, -n))
            in_doc.update(range(p, p - n))
            in_item.update(range(q, q - n))
            continue
        start = None
        for i, ok in enumerate([*free, False]):
            if ok and start is None:
                start = i
            elif not ok and start is not None:
                if i - start >= k:
                    heapq.heappush(heap, (start - i, p + start, q + start))
                start = None
    return out


def _blocks(benchmark: DataFrame, key: str, text: str) -> Iterator[list[tuple[int, list[bytes]]]]:
    """Items with words, in blocks of at most ``BLOCK_WORDS`` words (one item at least)."""
    block, size = [], 0
    for r in benchmark.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t")).orderBy("k", "t").toLocalIterator():
        w = words(r["t"])
        if block and size + len(w) > BLOCK_WORDS:
            yield block
            block, size = [], 0
        if w:
            block.append((r["k"], w))
            size += len(w)
    if block:
        yield block


def _hits(docs: DataFrame, items: list[tuple[int, list[bytes]]], k: int) -> tuple[DataFrame, DataFrame]:
    """Seed hits of the documents (key, hash, n, p, seed), and the items' seeds (n, seed, item, q, item_words)."""
    vocabulary = {w: i + 1 for i, w in enumerate(dict.fromkeys(w for _, ws in items for w in ws))}
    rows, lengths = [], sorted({min(k, len(ws)) for _, ws in items})
    for place, (item, ws) in enumerate(items):
        n = min(k, len(ws))
        ids = np.array([vocabulary[w] for w in ws], np.uint64)
        rows += [(n, int(h.view(np.int64)), place, item, q, len(ws)) for q, h in enumerate(rolling(ids, n))]
    seeds = docs.sparkSession.createDataFrame(rows, "n int, seed long, place int, item_id long, q int, item_words int")
    known = np.unique(np.array([r[1] for r in rows], np.int64))

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number, seen = vocabulary.get, set()
        for b in batches:
            for key, h, text in once(zip(b["k"], b["h"], b["t"]), seen):
                ids = np.array([number(w, 0) for w in words(text)], np.uint64)
                for n in lengths:
                    got = rolling(ids, n).view(np.int64)
                    p = np.flatnonzero(got)
                    p = p[known[np.searchsorted(known, got[p]).clip(max=len(known) - 1)] == got[p]]
                    if len(p):
                        yield pd.DataFrame({"k": key, "h": h, "n": np.int32(n), "p": p.astype(np.int32), "seed": got[p]})

    return docs.mapInPandas(scan, "k long, h long, n int, p int, seed long"), seeds


def _grouped(hits: DataFrame, seeds: DataFrame) -> DataFrame:
    """The distinct hits (p, q) of each document and item: those of all copies of a document are the same."""
    return (hits.join(F.broadcast(seeds), ["n", "seed"]).groupBy("k", "h", "place", "item_id", "item_words", "n")
            .agg(F.collect_set(F.struct("p", "q")).alias("hits")))


def matches(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
            k: int = SEED_WORDS, covered: float = COVERED) -> DataFrame:
    """One row per document and test item of which at least ``covered`` of the words
    lie under tiles: doc_id, item_id, coverage, n_tiles, matched_words, and the
    document's text hash (rows that share a key are told apart by it).

    Documents are read once per benchmark block (one, below ``BLOCK_WORDS``
    words) in a narrow pass; only seed hits are joined and grouped, by document
    and item, so a passage in every document makes no large group. Items shorter
    than ``k`` words must occur whole; null and empty texts match nothing;
    repeated rows give one match; empty tables give none."""
    spark = docs.sparkSession
    slim = docs.select(F.col(key).cast("long").alias("k"), F.xxhash64(F.col(text).cast("string")).alias("h"), F.col(text).cast("string").alias("t"))

    @F.pandas_udf("array<int>")
    def tile(lengths: pd.Series, hits: pd.Series) -> pd.Series:
        out = []
        for n, hs in zip(lengths, hits):
            found = tiles([(h["p"], h["q"]) for h in hs], n)
            out.append([len(found), sum(t[2] for t in found)])
        return pd.Series(out, dtype=object)

    out = spark.createDataFrame([], "doc_id long, hash long, item_id long, coverage double, n_tiles int, matched_words int")
    for block in _blocks(benchmark, item, text):
        hits, seeds = _hits(slim, block, k)
        per = _grouped(hits, seeds).withColumn("t", tile("n", "hits"))
        out = out.unionByName(per.select(F.col("k").alias("doc_id"), F.col("h").alias("hash"), "item_id",
                                         (F.col("t")[1] / F.col("item_words")).alias("coverage"),
                                         F.col("t")[0].alias("n_tiles"), F.col("t")[1].alias("matched_words")))
    return out.where(F.col("coverage") >= covered).dropDuplicates(["doc_id", "hash", "item_id"])


def clean(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents, with all their columns, that cover no test item. The list of
    contaminated documents is broadcast only up to ``BROADCAST_ROWS`` rows."""
    bad = matches(docs, benchmark, key, text, **options).select(F.col("doc_id").alias("__bad_key"), F.col("hash").alias("__bad_hash")).distinct()
    bad = store.materialize(bad)
    if bad.count() <= BROADCAST_ROWS:
        bad = F.broadcast(bad)
    same = F.col(key).cast("long").eqNullSafe(F.col("__bad_key")) & (F.xxhash64(F.col(text).cast("string")) == F.col("__bad_hash"))
    return docs.join(bad, same, "left_anti")
