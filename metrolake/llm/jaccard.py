"""Exact Jaccard join of word shingles with a token-group matrix.

Documents with equal shingle sets form one class. Classes that can be similar
share signatures: their tokens are dealt by hash into more segments than two
similar sets can differ in, so some segments are equal in both. As similar sets
share a known number of them, each class does without as many less one: the most
frequent, if common (passages that many documents share). Signatures thus part
the classes into sets of similar documents, and tokens, the most frequent left
out by the same rule, part those sets again.

Within such a part the token-group matrix decides: a group is a leader and the
documents linked to it, its row of the matrix is the union of their tokens. A
query document's tokens found in the union bound its overlap with every member,
and only groups whose bound reaches the threshold are opened and compared.
"""
from __future__ import annotations

from array import array
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from metrolake.llm import graph, store
from metrolake.llm.substrings import _mix, _raw, windows, word_hashes

SHINGLE = 3
NEED, OF = 90, 100                      # linked when OF * intersection >= NEED * union
GROUP_TOKENS = 8_000_000                # most tokens of a set that one task compares; larger sets are spread
SHRINK = (9, 10)                        # larger sets are signed again while a round leaves at most this part of their documents in such sets
PIVOTS = 64                             # documents of a larger set that are compared with all of it at once
BROADCAST_ROWS = 2_000_000
COMMON = 64                             # a signature of more classes is common; documents with enough others do without it
SAMPLE, SAMPLE_CHARS, SAMPLE_TOKENS = 5_000, 20_000, 1_000_000     # bounds of the sample that shared passages are looked for in
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_MAX = (1 << 63) - 1


def shingles(text: str | None, k: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the ``k``-word shingles, A-Z lower-cased; a shorter
    text is one shingle, a text without words (or null) has none."""
    words = word_hashes(_raw(text).translate(_LOWER))
    return np.unique(windows(words, min(k, len(words)))) if len(words) else words


def class_of(tokens: np.ndarray) -> int:
    """Hash of a whole set."""
    return int(_mix(np.array([_mix(tokens + np.uint64(77)).sum(dtype=np.uint64) + np.uint64(len(tokens))]))[0] >> np.uint64(1))


def levels(top: int) -> list[int]:
    """Least sizes of the size levels up to ``top``: each half as large again as the one before."""
    out = [1]
    while out[-1] <= top:
        out.append(max(out[-1] + 1, -(-out[-1] * 3 // 2)))
    return out


def signatures(tokens: np.ndarray, need: int = NEED, of: int = OF, known: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, level, spare): linked sets have at least spare + 1 signatures of a level in common.

    A pair meets at the level of its smaller set x. There |x| <= hi and
    |y| <= |x| * of / need, so the sets differ in at most D = hi * (of - need) / need
    tokens (from OF * i >= NEED * u), and at least k - D of k segments are equal.
    Of an equal segment the tokens in ``known`` (any fixed, sorted array: passages that
    many documents share) may be left out, and the rest is still equal. So up to
    k - D - 1 segments can be left out and one of the equal ones remains: those
    empty without the known tokens first, then as many as ``spare``. A set with more
    empty ones signs all its segments with all their tokens as well."""
    n = len(tokens)
    out = [(np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.int32))]
    starts = levels(n * 2)
    own = bisect_right(starts, n) - 1
    known = np.zeros(0, np.uint64) if known is None or not len(known) else known
    rare = known[np.searchsorted(known, tokens).clip(max=len(known) - 1)] != tokens if len(known) else np.ones(n, bool)
    for at in (own, own - 1) if n else ():
        if at < 0 or (at < own and need * n > of * (starts[own] - 1)):
            continue
        most = (starts[at + 1] - 1) * (of - need) // need
        k = most + 1 + most // 4
        segment = (_mix(tokens ^ np.uint64(0x1234567)) % np.uint64(k)).astype(np.int64)
        place = np.arange(k, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(at * 1_000_003 + 1)
        each = _mix(tokens + np.uint64(77))
        total, count = np.zeros(k, np.uint64), np.bincount(segment[rare], minlength=k)
        np.add.at(total, segment[rare], each[rare])
        signed, spare = _mix(total + place)[count > 0], most // 4 - int((count == 0).sum())
        if spare < 0:
            whole = np.zeros(k, np.uint64)
            np.add.at(whole, segment, each)
            signed = np.concatenate([signed, _mix(whole + place + np.uint64(0xABCDEF))])
        out.append((signed, np.full(len(signed), at, np.int32), np.full(len(signed), max(0, spare), np.int32)))
    h, at, spare = (np.concatenate(x) for x in zip(*out))
    return h.view(np.int64), at, spare


def linked(x: int, y: int, both: int, need: int = NEED, of: int = OF) -> bool:
    """Whether sets of sizes x and y with ``both`` common tokens are similar enough."""
    return of * both >= need * (x + y - both)


def least_common(n: int, need: int = NEED, of: int = OF) -> int:
    """Fewest tokens that a set of ``n`` tokens has in common with a linked one: OF * i >= NEED * union, and the union has n at least."""
    return max(1, -(-need * n // of))


def parted(sets: list[np.ndarray], need: int = NEED, of: int = OF) -> Iterator[list[int]]:
    """Places of the sets that may be linked, each part by itself, those alone left out. A set is left out of
    the lists of its most frequent tokens, all but one of those that a linked set shares at least; the rarest
    common token stays in both lists. In a part tokens are rarer, so it is parted again until it stays whole."""
    every, place = np.unique(np.concatenate(sets), return_inverse=True)
    place, sizes = place.reshape(-1), np.array([len(s) for s in sets])
    stay = sizes - np.array([least_common(int(n), need, of) - 1 for n in sizes])
    todo = [np.arange(len(sets))]
    starts = np.cumsum(sizes) - sizes
    count = np.zeros(len(every), np.int64)
    first = np.zeros(len(every), np.int64)
    while todo:
        part = todo.pop()
        owner = np.repeat(np.arange(len(part)), sizes[part])
        at = np.arange(len(owner)) - np.repeat(np.cumsum(sizes[part]) - sizes[part], sizes[part])
        tokens = place[np.repeat(starts[part], sizes[part]) + at]
        np.add.at(count, tokens, 1)
        often = count[tokens]
        count[tokens] = 0
        order = np.lexsort((tokens, often, owner))           # each set's tokens, rarest first, as many places as before
        kept = order[(at < np.repeat(stay[part], sizes[part])) & (often[order] > 1)]
        first[tokens[kept][::-1]] = owner[kept][::-1]
        label = _reach(owner[kept], first[tokens[kept]], len(part))
        by = np.argsort(label, kind="stable")
        pieces = [p for p in np.split(by, np.flatnonzero(np.diff(label[by])) + 1) if len(p) > 1]
        for p in pieces:
            if len(p) == len(part):
                yield part.tolist()
            else:
                todo.append(part[p])


def _reach(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """For each of n vertices the least that it reaches by the edges (a, b)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        while (new[new] != new).any():
            new = new[new]
        if (new == label).all():
            return label
        label = new


def token_groups(sets: list[np.ndarray], need: int = NEED, of: int = OF) -> list[int]:
    """For each set the place of the first set of its connected component, by the
    token-group matrix of each part (:func:`parted`) that links cannot leave."""
    top = list(range(len(sets)))
    for part in parted(sets, need, of) if sets else ():
        for i, first in zip(part, _matrix([sets[i] for i in part], need, of)):
            top[i] = part[first]
    return top


def _matrix(sets: list[np.ndarray], need: int, of: int) -> list[int]:
    """For each set the place of the first set of its connected component."""
    top = list(range(len(sets)))

    def root(i: int) -> int:
        while top[i] != i:
            top[i] = top[top[i]]
            i = top[i]
        return i

    every, place = np.unique(np.concatenate(sets), return_inverse=True)
    ids = np.split(place.reshape(-1), np.cumsum([len(s) for s in sets])[:-1])
    often = np.bincount(place.reshape(-1), minlength=len(every)) > 1     # a token of one set only is in no overlap
    rows: dict[int, array] = defaultdict(lambda: array("q"))     # the matrix, by token: groups whose union has it
    members: list[list[int]] = []
    mark = np.zeros(len(every), bool)
    for x in sorted(range(len(sets)), key=lambda i: len(sets[i])):
        mine = ids[x][often[ids[x]]].tolist()
        mark[ids[x]] = True
        bound = np.bincount(np.frombuffer(b"".join([rows[t] for t in mine if t in rows]), np.int64), minlength=len(members))
        joined = None
        for g in np.argsort(-bound, kind="stable").tolist():
            if of * int(bound[g]) < need * len(ids[x]):
                break                                            # no member can overlap enough
            if joined is not None and root(members[g][0]) == root(x):
                continue
            for y in members[g]:                                 # the leader first
                if linked(len(ids[x]), len(ids[y]), int(mark[ids[y]].sum()), need, of):
                    if y == members[g][0] and joined is None:
                        joined = g
                    a, b = root(x), root(y)
                    top[max(a, b)] = min(a, b)
                    break
        mark[ids[x]] = False
        if joined is None:
            joined = len(members)
            members.append([])
        fresh = not members[joined]
        members[joined].append(x)
        for t in mine:
            if fresh or joined not in rows[t]:
                rows[t].append(joined)
    return [root(i) for i in range(len(sets))]


def _decode(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.uint64)


def _compare_sets(rows: DataFrame, need: int, of: int) -> DataFrame:
    """(c, label) of the classes in ``rows`` (g, c, tokens); a set g is compared in one task."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def parts() -> Iterator[dict]:
            now, held = None, {}
            for b in batches:
                for g, c, tokens in zip(b["g"], b["c"], b["tokens"]):
                    if g != now and held:
                        yield solve(held)
                        held = {}
                    now = g
                    held[int(c)] = _decode(tokens)
            if held:
                yield solve(held)

        def solve(held: dict) -> dict:
            cs = np.array(list(held), np.int64)
            return {"c": cs, "label": cs[token_groups(list(held.values()), need, of)]}

        return store.gather(parts())

    return rows.repartition("g").sortWithinPartitions("g").mapInPandas(run, "c long, label long")


def _compare_large(rows: DataFrame, need: int, of: int) -> DataFrame:
    """(c, label) for sets too large for one task: members outside the largest
    component of their set are pivots, a bounded number at a time, and every
    member is compared with its set's pivots in a narrow pass. When all of them
    have been pivots, no pair of components is left unseen."""
    spark = rows.sparkSession
    rows = store.materialize(rows.dropDuplicates(["c"]))
    edges = spark.createDataFrame([], "a long, b long")
    done = spark.createDataFrame([], "c long")
    while True:
        labels = graph.components(edges)
        now = rows.select("g", "c").join(labels.withColumnRenamed("v", "c"), "c", "left") \
            .withColumn("label", F.coalesce("label", "c"))
        now = store.materialize(now)
        size = now.groupBy("g", "label").agg(F.count("*").alias("m"))
        largest = size.groupBy("g").agg(F.max(F.struct("m", "label")).alias("_top")).select("g", F.col("_top.label").alias("_top"))
        left = now.join(largest, "g").where("label <> _top").select("g", "c").join(done, "c", "left_anti")
        few = left.orderBy(F.xxhash64("c")).limit(PIVOTS)
        pivots = [(r["g"], r["c"], bytes(r["tokens"])) for r in rows.join(F.broadcast(few.select("c")), "c").select("g", "c", "tokens").collect()]
        if not pivots:
            return now.select("c", "label")

        def compare(batches: Iterator[pd.DataFrame], pivots: list = pivots) -> Iterator[pd.DataFrame]:
            for b in batches:
                found = []
                for g, c, tokens in zip(b["g"], b["c"], b["tokens"]):
                    x = _decode(tokens)
                    for pg, pc, raw in pivots:
                        if pg == g and pc != c:
                            y = _decode(raw)
                            if linked(len(x), len(y), len(np.intersect1d(x, y, assume_unique=True)), need, of):
                                found.append((int(c), int(pc)))
                yield pd.DataFrame(found, columns=["a", "b"], dtype="int64")

        edges = store.materialize(edges.unionByName(rows.mapInPandas(compare, "a long, b long")).distinct())
        done = store.materialize(done.unionByName(spark.createDataFrame([(p[1],) for p in pivots], "c long")))


def _sets(signed: DataFrame, common: int | None = None) -> DataFrame:
    """(c, g) of the classes that share a signature with another: g is the least class of those that
    signatures connect. ``signed`` has h, c, at and spare: linked classes have at least spare + 1 signatures
    of a level in common, so of the ``spare`` most frequent of its level a class does without those that more
    than ``common`` have. The rarest that a linked pair has in common stays in both, as the order is the same for all."""
    shared = store.materialize(signed.groupBy("h").agg(F.min("c").alias("_lo"), F.max("c").alias("_hi"), F.count("*").alias("m"))
                               .where("_lo < _hi").select("h", "m"))
    small = F.broadcast(shared) if shared.count() <= BROADCAST_ROWS else shared
    rarest = Window.partitionBy("c", "at").orderBy(F.desc("m"), "h")
    met = store.materialize(signed.join(small, "h").distinct().withColumn("_nth", F.row_number().over(rarest))
                            .where((F.col("_nth") > F.col("spare")) | (F.col("m") <= (COMMON if common is None else common))).select("h", "c"))
    lead = met.groupBy("h").agg(F.min("c").alias("lead"))
    edges = store.materialize(met.join(lead, "h").where("c > lead").select(F.col("c").alias("a"), F.col("lead").alias("b")).distinct())
    return graph.components(edges).select(F.col("v").alias("c"), F.col("label").alias("g"))


def _split_large(rows: DataFrame, need: int, of: int) -> tuple[DataFrame, DataFrame]:
    """The sets of ``rows`` (g, c, tokens), signed again: (sets within the bound, sets still above it).

    A set of unlike documents hangs together by tokens that many of its members have. Now every
    token, hashed with its set, is a signature: linked sets share :func:`least_common` of them, so no linked
    pair is parted, and a class whose rarest tokens are its own is in no set. In the parts
    tokens are rarer, so what is still too large is signed again while rounds make it smaller."""
    done, left = rows.where("false"), rows.count()
    while left:
        def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            def parts() -> Iterator[dict]:
                for b in batches:
                    for g, c, raw in zip(b["g"], b["c"], b["tokens"]):
                        tokens = _decode(raw)
                        yield {"h": _mix(tokens ^ np.uint64(int(g) & (2**64 - 1))).view(np.int64), "c": c, "at": 0, "spare": least_common(len(tokens), need, of) - 1}

            return store.gather(parts())

        sets = _sets(rows.mapInPandas(sign, "h long, c long, at int, spare int"), 1)
        sizes = rows.select("c", (F.length("tokens") / 8).alias("n")).join(sets, "c")
        weight = sizes.groupBy("g").agg((F.sum("n") > GROUP_TOKENS).alias("_large"))
        parts = store.materialize(sizes.select("c", "g").join(weight, "g"))
        again = store.materialize(rows.drop("g").join(F.broadcast(parts) if parts.count() <= BROADCAST_ROWS else parts, "c").select("g", "c", "tokens", "_large"))
        done = done.unionByName(again.where("not _large").drop("_large"))
        rows, before = again.where("_large").drop("_large"), left
        left = rows.count()
        if left * SHRINK[1] > before * SHRINK[0]:
            break
    return done, rows


def shared_passages(slim: DataFrame, k: int) -> np.ndarray:
    """Shingles that two classes of a sample have in common, sorted. The sample (``SAMPLE``
    texts of at most ``SAMPLE_CHARS`` code points, by text hash) only steers how well
    signatures tell documents apart; what is linked does not depend on it."""
    few = slim.where(F.length("text").between(1, SAMPLE_CHARS)).select("t").distinct().orderBy("t").limit(SAMPLE)
    cut = few.agg(F.max("t")).first()[0]
    if cut is None:
        return np.zeros(0, np.uint64)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for x in b["text"]:
                yield pd.DataFrame({"h": shingles(x, k).view(np.int64)})

    texts = slim.where((F.col("t") <= cut) & F.length("text").between(1, SAMPLE_CHARS)).groupBy("t").agg(F.first("text").alias("text")).select("text")
    found = texts.mapInPandas(run, "h long").groupBy("h").count().where("count > 1").select("h").limit(SAMPLE_TOKENS).toArrow()
    return np.sort(found["h"].to_numpy().view(np.uint64))


def link(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = SHINGLE, need: int = NEED, of: int = OF) -> DataFrame:
    """One row per input row: key, n_shingles, class_id (hash of the set), component_id
    (least key reachable by links; a row without shingles is its own), text_hash.

    Signatures are counted with partial aggregates; those of one class only are
    dropped; the rest joins each class to its signature's least class, and the
    components of these pairs are the sets to compare, so no signature's classes
    are paired off. A set too large for one task is signed again by its rarer
    tokens, which parts it. Only classes in such sets are read again for their tokens.
    Copies share a class, so they are never compared; a null key stands after
    all others and is a component's id only where all its keys are null; rows
    repeated, extra columns and empty tables need no special care."""
    spark = docs.sparkSession
    t = F.col(text).cast("string")
    slim = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(_MAX)).alias("o"), F.xxhash64(t).alias("t"), t.alias("text"))

    known = shared_passages(slim, k)

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            sets = [shingles(x, k) for x in b["text"]]
            yield pd.DataFrame({"o": b["o"], "t": b["t"], "c": [class_of(s) for s in sets], "n": [len(s) for s in sets]})

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def parts() -> Iterator[dict]:
            seen: set[int] = set()
            for b in batches:
                for x in b["text"]:
                    tokens = shingles(x, k)
                    c = class_of(tokens)
                    if len(tokens) and c not in seen:           # copies in one task sign once
                        seen.add(c)
                        h, at, spare = signatures(tokens, need, of, known)
                        yield {"h": h, "c": c, "at": at, "spare": spare}
                if len(seen) > 200_000:
                    seen.clear()

        return store.gather(parts())

    described = store.materialize(slim.mapInPandas(describe, "o long, t long, c long, n long"))
    sets = _sets(slim.select("text").mapInPandas(sign, "h long, c long, at int, spare int"))

    least = described.join(sets, "c").groupBy("c", "g", "n").agg(F.min("o").alias("o"))
    chosen = (described.select("c", "o", "t").join(least, ["c", "o"]).groupBy("c", "g", "n", "o").agg(F.min("t").alias("t")))
    weight = chosen.groupBy("g").agg(F.sum("n").alias("_w"))
    chosen = store.materialize(chosen.join(weight, "g").select(F.col("o").alias("_o"), F.col("t").alias("_t"), "c", "g", (F.col("_w") > GROUP_TOKENS).alias("large")))
    side = F.broadcast(chosen) if chosen.count() <= BROADCAST_ROWS else chosen

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"g": b["g"], "c": b["c"], "large": b["large"], "tokens": [shingles(x, k).tobytes() for x in b["text"]]})

    tokens = slim.join(side, (F.col("o") == F.col("_o")) & (F.col("t") == F.col("_t"))).select("g", "c", "large", "text") \
        .mapInPandas(read, "g long, c long, large boolean, tokens binary")
    labels = store.materialize(_compare_sets(tokens.where("not large").select("g", "c", "tokens"), need, of))     # written before any union
    if chosen.where("large").limit(1).count():
        parted, rest = _split_large(store.materialize(tokens.where("large").select("g", "c", "tokens")), need, of)
        labels = labels.unionByName(store.materialize(_compare_sets(parted, need, of)))
        if rest.limit(1).count():
            labels = labels.unionByName(_compare_large(rest, need, of))
    labels = store.materialize(labels)

    firsts = described.where("n > 0").groupBy("c").agg(F.min("o").alias("first"))
    named = firsts.join(labels, "c", "left").withColumn("label", F.coalesce("label", "c"))
    ids = named.groupBy("label").agg(F.min("first").alias("component_id"))
    named = named.join(ids, "label").select("c", "component_id")
    none = lambda c: F.when(F.col(c) != _MAX, F.col(c))
    return (described.join(named.withColumn("_c", F.col("c")).drop("c"), (F.col("c") == F.col("_c")) & (F.col("n") > 0), "left")
            .withColumn("component_id", F.coalesce("component_id", "o"))
            .select(none("o").alias(key), F.col("n").alias("n_shingles"), F.col("c").alias("class_id"), none("component_id").alias("component_id"), F.col("t").alias("text_hash")))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, all columns kept, with one row of each component: that of the
    least key (then least text hash; of repeated rows any one). Only the keys of rows
    that go, or that are repeated, are joined to the texts."""
    linked_rows = store.materialize(link(docs, key, text, **options).select(F.coalesce(key, F.lit(_MAX)).alias("o"), F.col("text_hash").alias("t"),
                                                                            F.coalesce("component_id", F.lit(_MAX)).alias("g"), F.col("n_shingles").alias("n")))
    some, none = linked_rows.where("n > 0"), linked_rows.where("n = 0")
    first = some.where("o = g").groupBy("g").agg(F.min("t").alias("_t"))
    gone = some.join(first, "g").where("not (o = g and t <=> _t)").select("o", "t", F.lit(False).alias("again")).distinct()
    again = none.unionByName(some).groupBy("o", "t").agg(F.count("*").alias("m")).where("m > 1").select("o", "t", F.lit(True).alias("again"))
    marked = store.materialize(again.join(gone, ["o", "t"], "left_anti").unionByName(gone))
    side = (F.broadcast(marked) if marked.count() <= BROADCAST_ROWS else marked).toDF("__kn_o", "__kn_t", "__kn_again")
    whole = docs.withColumn("__kn_ko", F.coalesce(F.col(key).cast("long"), F.lit(_MAX))).withColumn("__kn_kt", F.xxhash64(F.col(text).cast("string")))
    joined = whole.join(side, (F.col("__kn_ko") == F.col("__kn_o")) & (F.col("__kn_kt") == F.col("__kn_t")), "left")
    once = joined.where("__kn_again").withColumn("__kn_nth", F.row_number().over(Window.partitionBy("__kn_ko", "__kn_kt").orderBy(F.lit(0)))).where("__kn_nth = 1")
    return joined.where("__kn_again is null").select(*docs.columns).unionByName(once.select(*docs.columns))
