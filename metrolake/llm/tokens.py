"""Token-id files: documents as separately compressed id arrays in indexed blocks.

A block is one binary value, written by Spark's own Parquet writer so that any
store and the commit protocol apply. Layout, little-endian::

    magic 4s | version u16 | id width u16 | dictionary sha256 32s | documents u32
    per document: frame end u64 (from the first frame) | ids u32
    frames

A frame is one document's id array (u16 when every vocabulary id fits, else
u32) compressed with the shared dictionary, so a reader of one short document
takes the index and one frame. The dictionary is stored once beside the blocks.
"""
from __future__ import annotations

import hashlib
import re
import struct
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from metrolake.llm import store
from metrolake.llm.substrings import _mix, powers

MAGIC, VERSION, HEAD, ENTRY = b"TIDS", 1, "<4sHH32sI", "<QI"
LEVEL = 3
BLOCK_DOCS, BLOCK_BYTES = 1024, 2 << 20
MAX_SPLITS = 4096                                   # boundaries sent to tasks
DICT_DOCS, DICT_BYTES, DICT_CHARS = 2000, 112_640, 20_000   # bounds of the dictionary's training sample
KEEP_WORDS = 1_000_000                              # encoded words a worker remembers, about 45 bytes each


_ODD = re.compile("[\\x1c-\\x1f\\x85\\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")     # white space beyond the usual six


class Words:
    """Known words in the order of their hash: hash, first eight bytes, length, place and number
    of ids in a pool, and in how many lookups each was found.

    New words go to a small table that is merged into the large one when it reaches an eighth
    of it, so learning costs what is new. When both hold ``KEEP_WORDS``, words found only once go."""

    def __init__(self, kind: str):
        self.kind = kind
        self.large, self.small = self._none(), self._none()
        self.pool, self.used = [], 0

    def _none(self) -> dict[str, np.ndarray]:
        kinds = {"h": np.uint64, "head": np.uint64, "size": np.int32, "at": np.int64, "n": np.int32, "seen": np.int32}
        return {name: np.zeros(0, kind) for name, kind in kinds.items()}

    @staticmethod
    def _merge(a: dict[str, np.ndarray], b: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        order = np.argsort(np.concatenate([a["h"], b["h"]]), kind="stable")
        return {name: np.concatenate([a[name], b[name]], dtype=a[name].dtype, casting="same_kind")[order] for name in a}

    @staticmethod
    def _hits(table: dict[str, np.ndarray], h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(table["h"], h)
        hit = at < len(table["h"])
        hit[hit] = table["h"][at[hit]] == h[hit]
        return at, hit

    def new(self, h: np.ndarray) -> np.ndarray:
        """Which of the hashes are unknown."""
        return ~(self._hits(self.large, h)[1] | self._hits(self.small, h)[1])

    def room(self, words: int) -> bool:
        """Make room for ``words`` more; whether that made known words unknown."""
        if len(self.large["h"]) + len(self.small["h"]) + words <= KEEP_WORDS:
            return False
        every = self._merge(self.large, self.small)
        stay = every["seen"] > 1
        if 2 * int(stay.sum()) > KEEP_WORDS or words > KEEP_WORDS // 2:
            stay[:] = False
        every = {name: v[stay] for name, v in every.items()}
        ids = self.ids(every["at"], every["n"])
        every["at"], every["seen"] = np.cumsum(every["n"], dtype=np.int64) - every["n"], np.zeros(len(every["n"]), np.int32)
        self.large, self.small, self.pool, self.used = every, self._none(), [ids], len(ids)
        return True

    def learn(self, h: np.ndarray, head: np.ndarray, size: np.ndarray, got: list[bytes]) -> None:
        """Add words (unknown ones, by rising hash) with the bytes of their ids."""
        ids = np.frombuffer(b"".join(got), self.kind)
        n = np.array([len(g) for g in got], np.int64) // np.dtype(self.kind).itemsize
        self.small = self._merge(self.small, {"h": h, "head": head, "size": size, "at": self.used + np.cumsum(n) - n, "n": n, "seen": np.zeros(len(h), np.int64)})
        self.pool.append(ids)
        self.used += len(ids)
        if 8 * len(self.small["h"]) > len(self.large["h"]):
            self.large, self.small = self._merge(self.large, self.small), self._none()

    def find(self, h: np.ndarray) -> tuple[np.ndarray, ...]:
        """(head, size, at, n) of known hashes."""
        out = [np.zeros(len(h), self.large[name].dtype) for name in ("head", "size", "at", "n")]
        for table in (self.large, self.small):
            at, hit = self._hits(table, h)
            table["seen"][at[hit]] += 1
            for o, name in zip(out, ("head", "size", "at", "n")):
                o[hit] = table[name][at[hit]]
        return tuple(out)

    def ids(self, at: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Ids at several places of the pool, one after another."""
        if len(self.pool) != 1:
            self.pool = [np.concatenate([np.zeros(0, self.kind), *self.pool])]
        stop = np.cumsum(n, dtype=np.int64)
        return self.pool[0][np.arange(stop[-1] if len(stop) else 0) + np.repeat(at - (stop - n), n)]


class Encoder:
    """Ids of texts by the tokenizers library, remembering the words already seen.

    The usual byte-level pre-tokenizer never joins characters across a single space that
    has a non-space on either side, nor across a line feed before a non-space (which is a
    token by itself), nor from a letter to a comma or full stop. So a text is cut at those
    spaces (a word keeps the space before it) and line feeds, a comma or full stop after a
    word's last letter is taken off, and only words not yet known go to the
    library. Texts with other runs of spaces, or with a special token's string, go
    to it whole, as do all texts under another pre-tokenizer. Both ways give the same ids.

    Known words (:class:`Words`) are looked up and gathered for many texts at once. Where hash
    and first bytes disagree, the texts go to the library whole."""

    def __init__(self, path: str, width: int | None = None):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.width = width or (2 if self.tok.get_vocab_size() <= 1 << 16 else 4)
        self.kind = f"<u{self.width}"
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        usual = self.tok.normalizer is None and str(self.tok.pre_tokenizer) == "ByteLevel(add_prefix_space=False, trim_offsets=True, use_regex=True)"
        marks = [self.tok.encode(m, add_special_tokens=False).ids for m in ("\n", ",", ".")]
        self.marks = np.array([m[0] for m in marks], self.kind) if usual and all(len(m) == 1 for m in marks) else None
        self.words = Words(self.kind)

    def _whole(self, text: str) -> bytes:
        return np.asarray(self.tok.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.kind).tobytes()

    def _parts(self, pieces: list[str]) -> list[bytes]:
        """Ids of each piece. Those without white space but a first space go in one call, a
        line feed after each; its id then marks where the next one begins."""
        out: dict[str, bytes] = {}
        plain = [p for p in pieces if p.split() == [p.removeprefix(" ")]]
        for some in (plain[i:i + 20_000] for i in range(0, len(plain), 20_000)):
            ids = np.asarray(self.tok.encode_batch_fast(["\n".join(some)], add_special_tokens=False)[0].ids, self.kind)
            at = np.flatnonzero(ids == self.marks[0])
            raw, w = ids.tobytes(), self.width
            out.update((p, raw[a:b]) for p, a, b in zip(some, [0, *((at + 1) * w).tolist()], [*(at * w).tolist(), len(raw)]))
        return [out[p] if p in out else self._whole(p) for p in pieces]

    def _joined(self, texts: list[str], tail: bytes) -> list[bytes] | None:
        """Ids of texts that split at single spaces; None if two words' hashes collide."""
        raws = [t.encode("utf-8", "surrogatepass") for t in texts]
        blob = b"\n".join(raws)
        b = np.frombuffer(blob + bytes(8), np.uint8)
        length = len(blob)
        stops = np.cumsum([len(r) + 1 for r in raws]) - 1                # a joint stands behind every text
        joint = np.zeros(length + 1, bool)
        joint[stops] = True
        follows, before = b[1:length + 1], np.concatenate([[32], b[:length]])[:length]
        odd = any(map(_ODD.search, texts))                               # then any byte beyond ASCII may be white space
        solid = (follows > 32) & ((follows < 127) | (not odd))
        blank = np.append((b[:length] <= 32) | ((b[:length] >= 128) & odd), True)
        within = np.concatenate([[True], blank[:length]])[:length] & blank[1:]   # white space on both sides
        first = np.zeros(length + 1, bool)
        first[stops[:-1] + 1] = True                                     # a line feed there stays in its word
        feed = (b[:length] == 10) & solid & (before != 32) & ~first[:length] & ~joint[:length] & ~joint[1:]
        end = np.flatnonzero(np.append((b[:length] == 32) & ~within | feed, True) | joint)
        begin = np.concatenate([[0], end[:-1] + 1])
        opened = np.concatenate([[0], np.where(joint[end[:-1]], 0, np.where(b[end[:-1]] == 32, 1, 2))])   # 0 by the text, 1 by a space, 2 by a line feed
        owner = np.searchsorted(stops, end)
        keep = end > begin                                               # a text's empty first word
        begin, end, opened, owner = begin[keep], end[keep], opened[keep], owner[keep]
        if not len(begin):
            return [tail] * len(texts)
        last, letter = b[end - 1], b[np.maximum(end - 2, 0)] | 32
        mark = np.where((end - begin > 1) & (letter >= 97) & (letter <= 122) & ((last == 44) | (last == 46)), np.where(last == 44, 1, 2), 0)
        end = end - (mark > 0)
        up, down = powers(length)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((b[:length].astype(np.uint64) + np.uint64(1)) * up, dtype=np.uint64)])
        spaced = opened == 1
        size = (end - begin) * 2 + spaced                                # the space before it is part of the word
        h = _mix((sums[end] - sums[begin]) * down[begin] + size.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        head = np.zeros(len(h), np.uint64)
        for i in range(8):
            head |= np.where(end - begin > i, b[begin + i], 0).astype(np.uint64) << np.uint64(8 * i)
        unique, place, same = np.unique(h, return_index=True, return_inverse=True)
        new = np.flatnonzero(self.words.new(unique))
        if len(new) and self.words.room(len(new)):
            new = np.flatnonzero(self.words.new(unique))
        if len(new):
            f = place[new]
            got = self._parts([(" " if s else "") + blob[x:y].decode("utf-8", "surrogatepass") for x, y, s in zip(begin[f].tolist(), end[f].tolist(), spaced[f].tolist())])
            self.words.learn(unique[new], head[f], size[f], got)
        same = same.reshape(-1)
        known_head, known_size, at, n = self.words.find(unique)
        if not (np.array_equal(known_head[same], head) and np.array_equal(known_size[same], size)):
            return None
        at, n = at[same], n[same]
        count = n + (opened == 2) + (mark > 0)                           # with the line feed before and the mark behind
        stop = np.cumsum(count)
        ids = np.empty(int(stop[-1]), self.kind)
        inner = np.ones(len(ids), bool)
        for where, value in (((stop - count)[opened == 2], self.marks[0]), (stop[mark == 1] - 1, self.marks[1]), (stop[mark == 2] - 1, self.marks[2])):
            ids[where], inner[where] = value, False
        ids[inner] = self.words.ids(at, n)
        cut = np.concatenate([[0], np.cumsum(np.bincount(owner, weights=count, minlength=len(texts)).astype(np.int64))])
        return [ids[x:y].tobytes() + tail for x, y in zip(cut[:-1].tolist(), cut[1:].tolist())]

    def encode(self, texts: list[str], end: int) -> Iterator[bytes]:
        """Id arrays (bytes of ``width`` per id) of ``texts``, each closed by id ``end``."""
        tail = np.asarray([end], self.kind).tobytes()
        plain = [self.marks is not None and "  " not in t and t[-1:] != " " and not any(s in t for s in self.special) for t in texts]
        some = [t for t, p in zip(texts, plain) if p]
        joined = self._joined(some, tail) if some else []
        if joined is None:
            plain = [False] * len(texts)
        of_plain = iter(joined or ())
        for t, p in zip(texts, plain):
            yield next(of_plain) if p else self._whole(t) + tail


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a vocabulary file: loaded once, kept between tasks."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def forget() -> None:
    """Drop the worker's encoders."""
    _encoders.clear()


def _chunks(texts: list[str], chars: int = 1 << 19) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts of about ``chars`` code points, with the place of their first."""
    at, total = 0, 0
    for i, t in enumerate(texts):
        total += len(t)
        if total >= chars:
            yield at, texts[at:i + 1]
            at, total = i + 1, 0
    if at < len(texts):
        yield at, texts[at:]


def train_dictionary(df: DataFrame, text: str, path: str, end: int) -> bytes:
    """zstandard dictionary from the id arrays of at most ``DICT_DOCS`` documents of
    at most ``DICT_CHARS`` code points (those with the least hashes, so any
    partitioning gives the same). Empty bytes when the sample is too small to train on."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    some = df.select(t.alias("t")).where(F.length("t").between(1, DICT_CHARS)).withColumn("h", F.xxhash64("t"))
    top = some.select("h").orderBy("h").limit(DICT_DOCS).agg(F.max("h")).first()[0]      # hashes first, so few texts move
    rows = some.where(F.col("h") <= F.lit(top)).orderBy("h", "t").limit(DICT_DOCS).select("t")

    def ids(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for _, texts in _chunks(list(b["t"])):
                yield pd.DataFrame({"ids": list(encoder(path).encode(texts, end))})

    sample = [bytes(r["ids"])[:8192] for r in rows.repartition(8).mapInPandas(ids, "ids binary").collect()]
    try:
        return zstandard.train_dictionary(DICT_BYTES, sorted(sample)).as_bytes() if len(sample) >= 64 else b""
    except zstandard.ZstdError:
        return b""


def _zdict(raw: bytes, write: bool = False) -> zstandard.ZstdCompressionDict | None:
    if not raw:
        return None
    d = zstandard.ZstdCompressionDict(raw)
    if write:
        d.precompute_compress(level=LEVEL)          # else every frame would build its tables anew
    return d


def write(df: DataFrame, out: str, path: str, key: str = "doc_id", text: str = "text", end: int = 2) -> None:
    """Encode every whole text (null as empty) and write ``out``/blocks and
    ``out``/dictionary, blocks and their documents in ascending key order (null
    keys first, repeated keys by text).

    Split points come from the key column alone, so the texts are read and
    encoded once; only compressed frames are shuffled. Each task packs its key
    ranges in order and closes a block at ``BLOCK_DOCS`` documents or
    ``BLOCK_BYTES`` bytes, so a task holds one block, not its partition."""
    spark = df.sparkSession
    raw = train_dictionary(df, text, path, end)
    digest = hashlib.sha256(raw).digest()
    width = Encoder(path).width
    n = df.count()
    parts = min(MAX_SPLITS, store.buckets_for(n, 8 * BLOCK_DOCS))
    cuts = []
    if parts > 1:
        at = df.agg(F.expr(f"approx_percentile(`{key}`, array({', '.join(str(i / parts) for i in range(1, parts))}), 100000)"))
        cuts = sorted(set(at.first()[0] or []))

    def frames(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc, cctx = encoder(path), zstandard.ZstdCompressor(LEVEL, dict_data=_zdict(raw, write=True))
        for b in batches:
            texts = list(b["t"])
            for at, some in _chunks(texts):
                ids = list(enc.encode(some, end))
                keys = b["k"].iloc[at:at + len(some)]
                yield pd.DataFrame({"split": [0 if pd.isna(k) else bisect_right(cuts, k) for k in keys], "k": keys.array,
                                    "h": b["h"].iloc[at:at + len(some)].array, "n": [len(i) // enc.width for i in ids],
                                    "frame": [cctx.compress(i) for i in ids]})

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size, split, number = [], 0, None, 0
        forget()                                        # packing needs no words

        def close() -> pd.DataFrame:
            ends = np.cumsum([len(f) for _, _, f in held])
            body = b"".join([struct.pack(HEAD, MAGIC, VERSION, width, digest, len(held)),
                             *(struct.pack(ENTRY, int(e), c) for e, (_, c, _) in zip(ends, held)), *(f for *_, f in held)])
            return pd.DataFrame({"split": [split], "number": [number], "ids": [sum(c for _, c, _ in held)],
                                 "keys": [pd.array([None if pd.isna(k) else int(k) for k, *_ in held], "Int64")], "block": [body]})

        for b in batches:
            for row in b.itertuples(index=False):
                if held and (row.split != split or len(held) >= BLOCK_DOCS or size + len(row.frame) > BLOCK_BYTES):
                    yield close()
                    held, size, number = [], 0, number + 1 if row.split == split else 0
                split = row.split
                held.append((row.k, row.n, row.frame))
                size += len(row.frame)
        if held:
            yield close()

    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    slim = df.select(F.col(key).cast("long").alias("k"), t.alias("t"), F.xxhash64(t).alias("h"))
    packed = (slim.mapInPandas(frames, "split int, k long, h long, n long, frame binary")
              .repartition(len(cuts) + 1, "split").sortWithinPartitions("split", F.asc_nulls_first("k"), "h")
              .mapInPandas(blocks, "split int, number int, ids long, keys array<long>, block binary"))
    with store.small_batches(spark, 250):
        packed.write.parquet(f"{out}/blocks")
    spark.createDataFrame([(digest, raw, path.rsplit("/", 1)[-1], end)], "sha256 binary, body binary, vocabulary string, end int") \
        .coalesce(1).write.parquet(f"{out}/dictionary")


def read_block(block: bytes, raw: bytes, only: list[int] | None = None) -> Iterator[np.ndarray]:
    """Id arrays of a block's documents, or of those at the places ``only``, as u32."""
    magic, version, width, digest, n = struct.unpack_from(HEAD, block)
    if magic != MAGIC or version != VERSION:
        raise ValueError("not a token-id block")
    if digest != hashlib.sha256(raw).digest():
        raise ValueError("the block was written with another dictionary")
    dctx, at = zstandard.ZstdDecompressor(dict_data=_zdict(raw)), struct.calcsize(HEAD)
    step = struct.calcsize(ENTRY)
    first = at + n * step
    for i in range(n) if only is None else only:
        begin = struct.unpack_from(ENTRY, block, at + (i - 1) * step)[0] if i else 0
        end, count = struct.unpack_from(ENTRY, block, at + i * step)
        ids = np.frombuffer(dctx.decompress(block[first + begin:first + end], max_output_size=count * width), f"<u{width}")
        yield ids.astype("<u4")


def _dictionary(spark: SparkSession, out: str) -> bytes:
    return bytes(spark.read.parquet(f"{out}/dictionary").first()["body"])


def read(spark: SparkSession, out: str, key: str = "doc_id") -> DataFrame:
    """One row per document of the files in ``out``: key, ids (u32 array)."""
    raw = _dictionary(spark, out)

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for keys, block in zip(b["keys"], b["block"]):
                for k, ids in zip(keys, read_block(block, raw)):
                    yield pd.DataFrame({key: pd.array([None if pd.isna(k) else int(k)], "Int64"), "ids": [ids.astype("int64")]})

    return spark.read.parquet(f"{out}/blocks").select("keys", "block").mapInPandas(decode, f"`{key}` long, ids array<long>")


def summary(spark: SparkSession, out: str, key: str = "doc_id") -> DataFrame:
    """Per document of the files in ``out``: key, start (ids of all documents
    before it), n_tokens, ids_crc32 (of the ids as u32), all from the files.

    Starts come from the ids of each split (one row per split), then of its
    blocks, then from the block's own index: no task sees more than a split."""
    raw = _dictionary(spark, out)
    files = spark.read.parquet(f"{out}/blocks")
    heads = files.select("split", "number", "ids")
    in_split = Window.partitionBy("split").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    all_splits = Window.orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    splits = heads.groupBy("split").agg(F.sum("ids").alias("_n")).select("split", F.coalesce(F.sum("_n").over(all_splits), F.lit(0)).alias("_a"))
    starts = heads.select("split", "number", F.coalesce(F.sum("ids").over(in_split), F.lit(0)).alias("_b")).join(splits, "split") \
        .select("split", "number", (F.col("_a") + F.col("_b")).alias("first"))

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forget()
        for b in batches:
            for split, number, keys, block in zip(b["split"], b["number"], b["keys"], b["block"]):
                size, crc = [], []
                for ids in read_block(block, raw):
                    size.append(len(ids))
                    crc.append(zlib.crc32(ids.tobytes()))
                yield pd.DataFrame({"split": split, "number": number, key: pd.array([None if pd.isna(k) else int(k) for k in keys], "Int64"),
                                    "_at": np.cumsum([0, *size[:-1]]), "n_tokens": size, "ids_crc32": crc})

    docs = files.select("split", "number", "keys", "block").mapInPandas(
        decode, f"split int, number int, `{key}` long, _at long, n_tokens long, ids_crc32 long")
    return docs.join(starts, ["split", "number"]).select(key, (F.col("first") + F.col("_at")).cast("long").alias("start"), "n_tokens", "ids_crc32")
