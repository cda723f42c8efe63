"""Substring deduplication with Rabin-Karp hashes of fixed-length word windows.

A window is removed where the same words also start earlier (in a document with
a smaller key, or before in the same one). Four steps, each a pass over the
texts that ships only small rows:

1. Each window has a minimizer, its least hash of ``GRAM`` words; equal windows
   have equal minimizers. Counting minimizers (one row for about eight windows)
   finds those that occur twice; other windows cannot repeat.
2. The places of repeated minimizers go back to their documents, which get
   numbers in key order.
3. Only windows over those places are hashed (96 bits). All but the first of
   equal ones are found by a sort of the rows of a window; windows that can be
   in more than ``HOT`` documents, as their minimizer's count tells, take their
   least document by a partial aggregate instead, so no group is large.
4. Windows with a smaller document elsewhere, and later ones in the same
   document, are merged into maximal intervals of words to remove.

Copies (equal key and text) are one document: a task works on one of them, and
places are collected as sets, so a group is bounded by one text.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from metrolake.llm import store

WINDOW, GRAM = 20, 6
HOT = 10_000
BROADCAST_BYTES = 64 << 20              # per-document places above this are joined by shuffle
_SPACE = np.isin(np.arange(256), [32, *range(9, 14)])
_BASE, _INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers (mod 2**64) of the hash base and of its inverse."""
    if not _powers or len(_powers["up"]) < n:
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            p = np.full(max(n, 1 << 16), base, np.uint64)
            p[0] = 1
            _powers[name] = np.cumprod(p, dtype=np.uint64)
    return _powers["up"][:n], _powers["down"][:n]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(29))


def word_hashes(raw: bytes) -> np.ndarray:
    """Hash of each word ``[^\\x20\\x09-\\x0D]+`` of UTF-8 text, from prefix sums of byte * base**place."""
    b = np.frombuffer(raw, np.uint8)
    if not len(b):
        return np.zeros(0, np.uint64)
    inside = ~_SPACE[b]
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    up, down = powers(len(b))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((b.astype(np.uint64) + np.uint64(1)) * up, dtype=np.uint64)])
    return _mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def windows(words: np.ndarray, k: int, base: int = _BASE) -> np.ndarray:
    """Rabin-Karp hash of every run of ``k`` word hashes."""
    n = max(0, len(words) - k + 1)
    h, b = np.zeros(n, np.uint64), np.uint64(base)
    for i in range(k if n else 0):
        h = h * b + words[i:i + n]
    return _mix(h)


def minimizers(words: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each gram, place of each window's least gram: the first of equals)."""
    g, span = windows(words, gram), window - gram + 1
    n = len(words) - window + 1
    if n <= 0:
        return g, np.zeros(0, np.int64)
    least, at = g[:n].copy(), np.arange(n)
    for i in range(1, span):
        less = g[i:i + n] < least
        least, at = np.where(less, g[i:i + n], least), np.where(less, np.arange(i, i + n), at)
    return g, at


def _raw(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _two(words: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """A window's 96-bit hash: a long and an int from two bases."""
    return windows(words, window).view(np.int64), (windows(words, window, _INVERSE) >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _first(h: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the first of each distinct (h, c), and for every place the place of its first."""
    order = np.lexsort((np.arange(len(h)), c, h))
    new = np.ones(len(h), bool)
    new[1:] = (np.diff(h[order]) != 0) | (np.diff(c[order]) != 0)
    origin = np.empty(len(h), np.int64)
    origin[order] = order[np.flatnonzero(new)][np.cumsum(new) - 1] if len(h) else order
    return np.sort(order[new]), origin


def once(rows: Iterator[tuple], seen: set) -> Iterator[tuple]:
    """The rows whose first two values (key, text hash) are not in ``seen``, which a task keeps: copies
    of a document are worked on once a task, so what is shipped for them does not grow with their number."""
    for row in rows:
        own = (None if pd.isna(row[0]) else row[0], row[1])
        if own not in seen:
            seen.add(own)
            yield row


def _slim(docs: DataFrame, key: str, text: str) -> DataFrame:
    t = F.col(text).cast("string")
    return docs.select(F.col(key).cast("long").alias("k"), F.xxhash64(t).alias("t"), t.alias("text"))


def _with_places(docs: DataFrame, places: DataFrame) -> DataFrame:
    """Documents with the number and array of places of those that have some; broadcast only below a checked size."""
    size = places.agg(F.sum(F.size("at") * 4 + 64)).first()[0] or 0
    side = F.broadcast(places) if size <= BROADCAST_BYTES else places
    side = side.select(F.col("k").alias("_k"), F.col("t").alias("_t"), "d", "at")
    return docs.join(side, docs["k"].eqNullSafe(F.col("_k")) & docs["t"].eqNullSafe(F.col("_t")), "left").select("k", "text", "d", "at")


def repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(k, t, d, at) for each document with windows that also occur in an earlier one:
    at holds runs of first starts, as start, end, start, end and so on. ``docs`` has
    k, t (text hash) and text."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = set()
        for b in batches:
            found = [np.zeros(0, np.uint64)]
            for _, _, text in once(zip(b["k"], b["t"], b["text"]), seen):
                g, at = minimizers(word_hashes(_raw(text)), window, gram)
                found.append(g[np.unique(at)])
            h, n = np.unique(np.concatenate(found).view(np.int64), return_counts=True)
            yield pd.DataFrame({"h": h, "n": n})

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def parts() -> Iterator[dict]:
            seen = set()
            for b in batches:
                for k, t, text in once(zip(b["k"], b["t"], b["text"]), seen):
                    g, at = minimizers(word_hashes(_raw(text)), window, gram)
                    at = np.unique(at)
                    yield {"h": g[at].view(np.int64), "k": k, "t": t, "p": at.astype(np.int32)}

        return store.gather(parts())

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def parts() -> Iterator[dict]:
            seen = set()
            for b in batches:
                for d, _, text, places in once(zip(b["d"], b["d"], b["text"], b["at"]), seen):
                    words, places = word_hashes(_raw(text)), np.asarray(places, np.int64)
                    _, least = minimizers(words, window, gram)
                    hot = np.isin(least, -1 - places[places < 0])
                    start = np.flatnonzero(hot | np.isin(least, places))
                    h, c = _two(words, window)
                    start = start[_first(h[start], c[start])[0]]
                    yield {"h": h[start], "c": c[start], "d": d, "s": start.astype(np.int32), "hot": hot[start]}

        return store.gather(parts())

    @F.pandas_udf("array<int>")
    def runs(starts: pd.Series) -> pd.Series:
        out = []
        for s in starts:
            s = np.unique(np.asarray(s, np.int32))
            cut = np.flatnonzero(np.diff(s) > 1)
            out.append(np.stack([s[np.r_[0, cut + 1]], s[np.r_[cut, len(s) - 1]] + 1], axis=1).ravel())
        return pd.Series(out, dtype=object)

    twice = store.materialize(docs.select("k", "t", "text").mapInPandas(count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
                              .where("n > 1").select("h", (F.col("n") > HOT).alias("hot")))
    found = docs.mapInPandas(place, "h long, k long, t long, p int").join(twice, "h")
    places = store.materialize(found.groupBy("k", "t").agg(F.collect_set(F.when(F.col("hot"), -1 - F.col("p")).otherwise(F.col("p"))).alias("at")))
    n = store.buckets_for(places.count(), 50_000)
    places = store.materialize(places.repartitionByRange(n, F.asc_nulls_first("k"), "t").sortWithinPartitions(F.asc_nulls_first("k"), "t")
                               .withColumn("d", F.monotonically_increasing_id()))
    rows = store.materialize(_with_places(docs, places).where("d is not null").select("d", "text", "at")
                             .mapInPandas(hashed, "h long, c int, d long, s int, hot boolean"))
    few, many = rows.where("not hot"), rows.where("hot")
    later = few.withColumn("nth", F.rank().over(Window.partitionBy("h", "c").orderBy("d"))).where("nth > 1").select("d", "s")
    least = many.groupBy("h", "c").agg(F.min("d").alias("_least"))
    later = later.unionByName(many.join(least, ["h", "c"]).where("d > _least").select("d", "s"))
    at = later.groupBy("d").agg(F.collect_set("s").alias("s")).select("d", runs("s").alias("at"))
    return store.materialize(at.join(places.select("k", "t", "d"), "d"))


def intervals(words: np.ndarray, known: list[int], window: int) -> list[tuple[int, int]]:
    """Maximal [start, end) runs of words under windows that repeat: those whose first
    start in the document is in the runs ``known``, and every start after a window's first."""
    h, c = _two(words, window)
    if not len(h):
        return []
    _, origin = _first(h, c)
    earlier = np.zeros(len(h) + 1, np.int64)
    np.add.at(earlier, np.asarray(known[0::2], np.int64), 1)
    np.add.at(earlier, np.asarray(known[1::2], np.int64), -1)
    start = np.flatnonzero((origin != np.arange(len(h))) | (np.cumsum(earlier)[origin] > 0))
    out: list[tuple[int, int]] = []
    for s in start.tolist():
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], s + window)
        else:
            out.append((s, s + window))
    return out


def kept_words(raw: bytes, cut: list[tuple[int, int]]) -> tuple[int, list[bytes]]:
    """(number of words, the words outside the intervals)."""
    words, kept, at = raw.split(), [], 0
    for a, b in cut:
        kept += words[at:a]
        at = b
    return len(words), kept + words[at:]


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """One row per input row: key, n_words, n_removed, kept (the remaining words,
    joined by one space) and removed (intervals of word places).

    Windows are judged on the input. Null and empty texts have no words; texts
    shorter than a window lose nothing; a null key comes before all others; rows
    with equal key and text are one document, rows that share only the key come
    in the order of their text hashes; other columns are ignored."""
    slim = _slim(docs, key, text)
    found = _with_places(slim, repeats(slim, window, gram))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for k, text, at in zip(b["k"], b["text"], b["at"]):
                raw = _raw(text)
                cut = intervals(word_hashes(raw), [] if at is None else at, window)
                n, kept = kept_words(raw, cut)
                rows.append((None if pd.isna(k) else int(k), n, sum(e - s for s, e in cut), b" ".join(kept).decode("utf-8", "surrogatepass"),
                             [list(c) for c in cut]))
            out = pd.DataFrame(rows, columns=["k", "n_words", "n_removed", "kept", "removed"])
            yield out.assign(k=pd.array(out["k"], "Int64"))

    return found.mapInPandas(run, "k long, n_words long, n_removed long, kept string, removed array<array<int>>").withColumnRenamed("k", key)

