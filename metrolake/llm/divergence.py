"""Source divergence audit: how each (language, source) group's words differ from its language's.

Terms are runs of letters (ASCII letters and every character beyond ASCII), A-Z lower-cased. A
language keeps the terms that enough of its documents hold. A group (or a language) with N
kept occurrences gives a term that occurs c times there the share 1 + floor(SCALE * (c + ADD) / (N + ADD * V)).

Terms with the same two counts have the same divergence, so they are counted in cells (count
here, count there) and a cell's value is computed once, in exact decimals. The
terms of a group are ranked by cells: cells of equal value are merged, the best values whose
cumulative multiplicity before them is under the limit are kept, and only those are
expanded into terms, in UTF-8 order. For a pair of sources only the terms that both hold
are joined; what one holds alone, or neither, comes from the groups' count histograms.
"""
from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from metrolake.llm import store

SCALE = 1_000_000_000
ADD = 5
MIN_DOCS = 30             # documents of a language that hold a kept term
TOP = 50                  # ranks of the term part
HELD = 500_000            # terms that a task sums up before it hands them on
DOC = 2**32               # a document's part in a sum that holds occurrences too; with at most 2**30 of them before a flush both fit a long

#: Bytes of a text as term bytes: A-Z lower-cased, other letters and all bytes of characters beyond ASCII as they are, else a space.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms(text: str | None) -> list[bytes]:
    """The terms of a text (null as empty), as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").translate(LETTERS).split()


def counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of every term in every group, and a row with
    a null term for each group. Null lang and source read as ''. Tasks sum up many documents before the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, dict[bytes, int]] = {}      # of a group: occurrences, and DOC for each document

        def flush() -> pa.RecordBatch:
            words = [t for own in held.values() for t in (None, *own)]
            both = np.array([v for own in held.values() for v in (0, *own.values())], np.int64)
            sizes = [len(own) + 1 for own in held.values()]
            repeated = lambda i: pa.array([g[i] for g in held]).cast(pa.string()).take(pa.array(np.repeat(np.arange(len(held)), sizes)))
            out = pa.RecordBatch.from_arrays([repeated(0), repeated(1), pa.array(words, pa.binary()).cast(pa.string()), pa.array(both % DOC), pa.array(both // DOC)],
                                             names=["lang", "source", "term", "n", "docs"])
            held.clear()
            return out

        size = occurrences = 0
        for b in batches:
            for language, name, text in zip(*[c.to_pylist() for c in b.columns]):
                own = held.setdefault((language, name), {})
                before, one = len(own), Counter(terms(text))
                for t, n in one.items():
                    own[t] = own.get(t, 0) + n + DOC
                size += len(own) - before
                occurrences += sum(one.values())
                if size >= HELD or occurrences >= DOC // 4:
                    yield flush()
                    size = occurrences = 0
        if held:
            yield flush()

    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    slim = docs.select(empty(lang).alias("lang"), empty(source).alias("source"), F.col(text).cast("string").alias("text"))
    return (slim.mapInArrow(run, "lang string, source string, term string, n long, docs long")
            .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))


def share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE * (count + ADD) / (total + ADD * kept)), exact; null where nothing is kept."""
    wide = lambda c: c.cast("decimal(25,0)")
    below = F.when(kept > 0, wide(total + ADD * kept))
    over = wide(count + ADD) * F.lit(SCALE).cast("decimal(10,0)")
    return F.call_function("div", over, below) + 1


class Audit:
    """Kept terms and their counts, written as tables: ``groups`` (lang, source, total, kept, in_lang) for every
    group that occurs, ``cells`` of the kept terms (lang, source, term, n, m: counts in group and language).

    Every row is a document, repeated rows too; an empty table has no groups."""

    def __init__(self, docs: DataFrame, min_docs: int = MIN_DOCS, text: str = "text", lang: str = "lang", source: str = "source"):
        every = store.materialize(counts(docs, text, lang, source))
        kept = store.materialize(every.where("term is not null").groupBy("lang", "term")
                                 .agg(F.sum("docs").alias("d"), F.sum("n").alias("m")).where(F.col("d") >= min_docs).drop("d"))
        self.cells = store.materialize(every.where("n > 0").drop("docs").join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "m"))
        langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("m").alias("in_lang"))
        sums = self.cells.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("own"))
        none = F.lit(0).cast("long")
        self.groups = store.materialize(
            every.where("term is null").select("lang", "source").join(sums, ["lang", "source"], "left").join(langs, "lang", "left")
            .select("lang", "source", *[F.coalesce(c, none).alias(c) for c in ("total", "own", "kept", "in_lang")]))

    def pairs(self) -> DataFrame:
        """(lang, source, item, value) for every two sources of a language: the summed divergence over all kept terms."""
        g = self.groups.select("lang", "source", "total", "own", "kept")
        other = g.select("lang", F.col("source").alias("item"), F.col("total").alias("total2"), F.col("own").alias("own2"))
        both = g.join(other, "lang").where("source <> item")
        here = lambda n: share(n, F.col("total"), F.col("kept"))
        there = lambda n: share(n, F.col("total2"), F.col("kept"))
        none = F.lit(0).cast("long")
        sizes = both.where("kept > 0")
        # each source's counts against none in the other, as if no term were in both
        histogram = self.cells.groupBy("lang", "source", "n").agg(F.count(F.lit(1)).alias("k"))
        alone = histogram.join(sizes, ["lang", "source"])
        lone = alone.select("lang", "source", "item", (F.abs(here(F.col("n")) - there(none)) * F.col("k")).alias("v"))
        mirrored = lone.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "v")
        # terms in both: what they add, less what was counted for them on either side, plus one in neither
        a = self.cells.select("lang", "term", "source", "n")
        b = self.cells.select("lang", "term", F.col("source").alias("item"), F.col("n").alias("n2"))
        met = a.join(b, ["lang", "term"]).where("source < item").groupBy("lang", "source", "item", "n", "n2").agg(F.count(F.lit(1)).alias("k"))
        zero = F.abs(here(none) - there(none))
        more = (F.abs(here(F.col("n")) - there(F.col("n2"))) - F.abs(here(F.col("n")) - there(none)) - F.abs(here(none) - there(F.col("n2"))) + zero) * F.col("k")
        shared = store.materialize(met.join(sizes, ["lang", "source", "item"]).groupBy("lang", "source", "item").agg(F.sum(more).alias("v")))
        turned = shared.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "v")
        absent = sizes.select("lang", "source", "item", (zero * (F.col("kept") - F.col("own") - F.col("own2"))).alias("v"))
        parts = lone.unionByName(mirrored).unionByName(shared).unionByName(turned).unionByName(absent)
        parts = parts.unionByName(both.where("kept = 0").select("lang", "source", "item", none.alias("v")))
        return parts.groupBy("lang", "source", "item").agg(F.sum("v").cast("long").alias("value"))

    def top_terms(self, top: int = TOP) -> DataFrame:
        """(lang, source, item, value, rank): the terms whose share in the group is above that in the language,
        by the difference, at most ``top`` a group; ties in UTF-8 order."""
        group = ["lang", "source"]
        sized = self.groups.select(*group, "total", "kept", "in_lang")
        p, q = share(F.col("n"), F.col("total"), F.col("kept")), share(F.col("m"), F.col("in_lang"), F.col("kept"))
        cells = self.cells.groupBy(*group, "n", "m").agg(F.count(F.lit(1)).alias("k")).join(sized, group)
        cells = store.materialize(cells.select(*group, "n", "m", "k", (p - q).alias("value")).where("value > 0"))
        merged = cells.groupBy(*group, "value").agg(F.sum("k").alias("k"))
        best = Window.partitionBy(*group).orderBy(F.desc("value"))
        first = merged.withColumn("_at", F.row_number().over(best)).where(F.col("_at") <= top)
        first = (first.withColumn("_before", F.coalesce(F.sum("k").over(best.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
                 .where(F.col("_before") < top).select(*group, "value", "_before"))
        picked = cells.select(*group, "n", "m", "value").join(first, [*group, "value"])
        equal = F.row_number().over(Window.partitionBy(*group, "value").orderBy("term"))
        named = self.cells.join(picked, [*group, "n", "m"]).withColumn("_at", equal).where(F.col("_at") <= top)
        return (named.withColumn("rank", (F.col("_before") + F.col("_at")).cast("int")).where(F.col("rank") <= top)
                .select(*group, F.col("term").alias("item"), "value", "rank"))

    def report(self, top: int = TOP) -> DataFrame:
        """Both parts in one table: (lang, source, part, item, value, rank)."""
        order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
        pairs = self.pairs().withColumn("rank", F.row_number().over(order)).withColumn("part", F.lit("pair"))
        names = ["lang", "source", "part", "item", "value", "rank"]
        return pairs.select(*names).unionByName(self.top_terms(top).withColumn("part", F.lit("term")).select(*names))
