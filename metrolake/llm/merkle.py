"""Merkle manifest of a dataset: hash trees per group under one root.

Every row is a leaf. Leaves of a group stand in the order of their key; while a
level has more than one node, each run of eight consecutive nodes becomes the hash of
its hashes. The groups' last nodes (subroots) form one more tree, whose last node is
the root. A leaf's path (for each level its left and right siblings) is enough to
recompute the root.

Per level, lag and lead columns of fixed offsets, masked by the node's slot in its
run and the run's length, hold the siblings; the first row of each run hashes itself
and what follows into the parent. The windows are cut at whole runs, so a task
holds ``BLOCK`` runs of a group however large the group is. Positions come from a
range-partitioned table (rank in the partition plus the counts of earlier ones).
Only column functions are used.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from metrolake.llm import store

FAN = 8                   # nodes in a run
BLOCK = 512               # runs in a window partition
ROWS_EACH = 500_000       # leaves in a range partition
STEP = "array<struct<left:string,right:string>>"


def field(value: Column) -> Column:
    """One value as the leaf hash reads it: ``-`` for null, else byte count, ``:`` and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts, concatenated."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaf(*values: Column) -> Column:
    """Hash of a row's values in the order given."""
    return digest(*[field(v) for v in values])


def group_key(value: Column) -> Column:
    """A key that is never null and sorts as the value does bytewise, null first."""
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit("-"))


def positions(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """``rows`` (a written table) with pos, the place in its group from 0, and n, the group's rows.

    Equal rows are dealt over range partitions too, so no group, key or repeated row
    has to fit in one task."""
    spark = rows.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), store.buckets_for(rows.count(), ROWS_EACH))
    keys = [F.asc_nulls_first(c) for c in order]
    dealt = store.materialize(rows.withColumn("_salt", F.monotonically_increasing_id())
                              .repartitionByRange(parts, F.col(group), *keys, F.col("_salt"))
                              .drop("_salt").withColumn("_part", F.spark_partition_id()))
    before = store.offsets(dealt, [group], "_part", F.lit(1), "_before")
    total = dealt.groupBy(group).agg(F.count(F.lit(1)).alias("n"))
    at = F.row_number().over(Window.partitionBy(group, "_part").orderBy(*keys)) - 1
    return (dealt.withColumn("_at", at).join(before, [group, "_part"]).join(total, group)
            .withColumn("pos", (F.col("_before") + F.col("_at")).cast("long")).drop("_part", "_before", "_at"))


def siblings(nodes: DataFrame) -> DataFrame:
    """Nodes (g, pos, n, h and more) with left and right: the hashes before and after them in their run."""
    slot = F.col("pos") % FAN
    run = F.least(F.lit(FAN), F.col("n") - (F.col("pos") - slot))
    w = Window.partitionBy("g", F.expr(f"pos div {FAN * BLOCK}")).orderBy("pos")
    left = [F.when(slot >= o, F.lag("h", o).over(w)) for o in range(FAN - 1, 0, -1)]
    right = [F.when(slot + o < run, F.lead("h", o).over(w)) for o in range(1, FAN)]
    return nodes.select("*", F.concat_ws("", *left).alias("left"), F.concat_ws("", *right).alias("right"))


def parents(level: DataFrame) -> DataFrame:
    """The next level's nodes: first children hash themselves and the rest of their run."""
    return level.where(F.col("pos") % FAN == 0).select(
        "g", F.expr(f"pos div {FAN}").alias("pos"), F.expr(f"(n + {FAN - 1}) div {FAN}").alias("n"),
        digest(F.col("h"), F.col("right")).alias("h"))


class Tree:
    """Levels of all groups' trees. ``nodes`` has g, pos, n and h (other columns stay with the
    first level); ``tops`` holds each group's last node with its depth."""

    def __init__(self, nodes: DataFrame):
        self.nodes, self.levels = store.materialize(nodes), []
        at, tops = self.nodes, []
        longest = at.agg(F.max("n")).first()[0] or 0
        while True:
            tops.append(at.where("n = 1").select("g", "h", F.lit(len(self.levels)).alias("depth")))
            if longest <= 1:
                break
            level = store.materialize(siblings(at.where("n > 1")))
            self.levels.append(level)
            at, longest = parents(level), -(-longest // FAN)
        self.tops = store.materialize(reduce(DataFrame.unionByName, tops))

    def paths(self, above: DataFrame) -> DataFrame:
        """The first level's nodes with steps, the siblings from the leaf up through the group's
        last node and on by ``above`` (g, steps: what follows it)."""
        extra = [c for c in self.nodes.columns if c not in ("g", "pos", "n")]
        ends = self.tops.select("g", "depth").join(above, "g")
        at = None
        for k in range(len(self.levels), -1, -1):
            here = [c for c in extra if k == 0]
            own = ends.where(F.col("depth") == k).select("g", F.lit(0).cast("long").alias("pos"), "steps")
            if k == 0:
                own = self.nodes.where("n = 1").join(above, "g").select("g", "pos", *here, "steps")
            if k < len(self.levels):
                up = at.select("g", F.col("pos").alias("_up"), F.col("steps").alias("_steps"))
                level = self.levels[k].withColumn("_up", F.expr(f"pos div {FAN}"))
                step = F.array(F.struct("left", "right"))
                below = level.join(up, ["g", "_up"]).select("g", "pos", *here, F.concat(step, F.col("_steps")).alias("steps"))
                own = below.unionByName(own)
            at = own if k == 0 else store.materialize(own)
        return at


class Manifest:
    """Trees over all rows of ``docs``: ``root`` (None for an empty table), ``subroots`` (group, its
    key g and hash) and ``rows`` (key, group, carried columns, leaf, subroot, steps).

    ``fields`` are hashed in their order; ``group`` names the trees (null is a group of its
    own, ordered first); leaves ascend by ``key``, null first, ties by their hash, so
    repeated rows are leaves of their own and reruns agree. ``carry`` names expressions
    over ``docs`` kept beside each leaf. Other columns are ignored, whatever their names."""

    def __init__(self, docs: DataFrame, fields: Sequence[str], group: str, key: str, carry: Mapping[str, Column] | None = None):
        carry = {f"c_{name}": value for name, value in (carry or {}).items()}
        rows = store.materialize(docs.select(
            group_key(F.col(group)).alias("g"), F.col(group).alias("grp"), F.col(key).alias("key"),
            leaf(*[F.col(c) for c in fields]).alias("h"), *[v.alias(n) for n, v in carry.items()]))
        self._names, self._group, self._key = list(carry), group, key
        self._tree = Tree(positions(rows, "g", ["key", "h"]))
        subs = store.materialize(self._tree.tops.select(F.lit("").alias("all"), F.col("g").alias("sub"), "h"))
        over = Tree(positions(subs, "all", ["sub"]).select(F.col("all").alias("g"), "sub", "pos", "n", "h"))
        top = over.tops.first()
        self.root = top["h"] if top else None
        none = over.tops.select("g", F.array().cast(STEP).alias("steps"))
        self.subroots = store.materialize(over.paths(none).select(F.col("sub").alias("g"), "h", "steps"))

    @property
    def rows(self) -> DataFrame:
        found = self._tree.paths(self.subroots.select("g", "steps"))
        subroot = self.subroots.select("g", F.col("h").alias("subroot"))
        return found.join(subroot, "g").select(
            F.col("key").alias(self._key), F.col("grp").alias(self._group), *[F.col(n).alias(n[2:]) for n in self._names],
            F.col("h").alias("leaf"), "subroot", F.lit(self.root).alias("root"), "steps")

    def write(self, folder: str) -> None:
        """The rows and the subroots as tables in ``folder``."""
        self.rows.write.parquet(f"{folder}/rows")
        self.subroots.select("g", "h", F.lit(self.root).alias("root")).write.parquet(f"{folder}/subroots")


def proof(steps: Column) -> Column:
    """Hash of all siblings from the leaf to the root, left to right (of nothing for a lone leaf)."""
    return digest(F.array_join(F.transform(steps, lambda s: F.concat(s["left"], s["right"])), ""))


def fold(start: Column, steps: Column) -> Column:
    """The root that a leaf hash and its siblings give."""
    return F.aggregate(steps, start, lambda h, s: digest(s["left"], h, s["right"]))


def compare(saved: DataFrame, docs: DataFrame, fields: Sequence[str], key: str) -> DataFrame:
    """(key, leaf, n_saved, n_now) for rows that a written manifest's ``rows`` and ``docs`` do not hold
    equally often: a changed row shows as one lost and one new leaf under its key. Counts are summed before
    the shuffle, so repeated rows cost one row a task; equal tables give an empty result."""
    was = saved.groupBy(F.col(key).alias("key"), "leaf").agg(F.count(F.lit(1)).alias("n"))
    now = docs.select(F.col(key).alias("key"), leaf(*[F.col(c) for c in fields]).alias("leaf")).groupBy("key", "leaf").agg(F.count(F.lit(1)).alias("n"))
    both = was.select("*", F.lit(0).cast("long").alias("m")).unionByName(now.select("key", "leaf", F.lit(0).cast("long").alias("n"), F.col("n").alias("m")))
    return (both.groupBy("key", "leaf").agg(F.sum("n").alias("n_saved"), F.sum("m").alias("n_now"))
            .where("n_saved <> n_now").withColumnRenamed("key", key))


FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def tampering(docs: DataFrame) -> Column:
    """Leaf of a document whose text has its A-Z lower-cased where 3 divides the crc32 of the decimal
    doc_id; null elsewhere (also for a null doc_id)."""
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    changed = leaf(*[lowered if c == "text" else F.col(c) for c in FIELDS])
    return F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, changed)


def report(docs: DataFrame) -> DataFrame:
    """One row per document: leaf, subroot, root and proof of the documents as they are, the root folded
    from the tampered (else the original) leaf, and whether it is the root. An empty table gives no rows."""
    rows = Manifest(docs, FIELDS, "lang", "doc_id", {"tampered": tampering(docs)}).rows
    folded = fold(F.coalesce("tampered", "leaf"), F.col("steps"))
    return (rows.select("doc_id", "leaf", "subroot", "root", proof(F.col("steps")).alias("proof_sha256"), folded.alias("folded_root"))
            .withColumn("verified", F.col("folded_root") == F.col("root")))
