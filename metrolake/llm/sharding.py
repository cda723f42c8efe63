"""Rendezvous (highest random weight) sharding of records by a stable key.

Every record scores every shard with a hash of (key, shard); the best score
wins. A record moves only when a new shard beats its old winner, so growing
from n to n+1 shards moves about 1/(n+1) of the records, all into the new one.
Only built-in column functions are used; assigning needs no shuffle at all.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from metrolake.llm import store

PRIME = 2_147_483_647          # 2**31 - 1: products of two residues fit a long
STEP = 1_640_531_527           # spreads consecutive shard numbers over the residues


def _seeds(key: Column) -> Column:
    """Two 31-bit residues of the key's md5 (a null key hashes as the empty text)."""
    hexed = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    part = lambda at: F.conv(F.substring(hexed, at, 12), 16, 10).cast("long") % PRIME
    return F.struct(part(1).alias("a"), part(13).alias("b"))


def rendezvous(seeds: Column, weights: Sequence[float]) -> Column:
    """Winning shard of ``weights`` (index = shard number) for a record's seeds.

    u = residue of a cubic in the seeds and the shard number, scaled to (0, 1);
    the least -ln(u) / weight wins, ties go to the smaller shard number, and a
    shard of weight w gets w / sum(weights) of all keys on average."""
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive, one for each shard")
    slots = F.array(*[F.struct(F.lit(j).alias("j"), F.lit(float(w)).alias("w")) for j, w in enumerate(weights)])

    def score(s: Column) -> Column:
        t = (seeds["a"] + s["j"].cast("long") * STEP) % PRIME
        u = (((t * t) % PRIME) * t + seeds["b"]) % PRIME
        return F.struct((-F.log((u + 0.5) / float(PRIME)) / s["w"]).alias("cost"), s["j"].alias("j"))

    return F.array_min(F.transform(slots, score))["j"]


def assign(df: DataFrame, key: str, weights: Sequence[float], shard: str = "shard") -> DataFrame:
    """All rows of ``df`` with their shard number in column ``shard`` (an input
    column of that name is replaced). Equal keys share a shard, null keys form
    one key, an empty table gives an empty table. No shuffle."""
    return df.withColumn(shard, rendezvous(_seeds(F.col(key)), weights))


def place(df: DataFrame, key: str = "doc_id", text: str = "text", shards: int = 40,
          weights: Sequence[float] | None = None, grown_weight: float = 1.0) -> DataFrame:
    """One row per input row: the key, its size (UTF-8 bytes of the text, null: 0,
    plus 16), crc32 of the text (null as empty), shard, its gapless slot in the
    shard, and the shard it would have with one shard more.

    Slots are ranks within (shard, bucket), offset by the counts of the shard's
    earlier buckets; the bucket count follows the row count, so no task holds a
    whole shard and a hot key or source changes nothing. Repeated rows get slots
    of their own. Other columns are ignored, whatever their names."""
    weights = list(weights or [1.0] * shards)
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    n = store.buckets_for(df.count(), 20_000 * len(weights))
    rows = (df.select(F.col(key).alias("_k"), _seeds(F.col(key)).alias("_s"),
                      (F.octet_length(body) + 16).cast("long").alias("size"),
                      F.crc32(body.cast("binary")).alias("text_crc32"))
            .withColumn("shard", rendezvous(F.col("_s"), weights))
            .withColumn("grown_shard", rendezvous(F.col("_s"), [*weights, grown_weight]))
            .withColumn("_b", (F.col("_s")["b"] % n).cast("int")).drop("_s"))
    before = store.offsets(rows, ["shard"], "_b", F.lit(1), "_before")
    w = Window.partitionBy("shard", "_b").orderBy("_k", "text_crc32", "size")
    return (rows.withColumn("_at", F.row_number().over(w) - 1)
            .join(before, ["shard", "_b"])
            .select(F.col("_k").alias(key), "size", "text_crc32", F.lit("key").alias("law"), "shard",
                    (F.col("_before") + F.col("_at")).cast("long").alias("slot"), "grown_shard"))
