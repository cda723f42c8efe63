"""Operators 11, 12 and 13 against brute force on small fixtures."""
from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from metrolake.llm import divergence, lines, merkle, store
from tests.llm import fixtures

SPACE = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _null_first(value):
    return (value is not None, value or 0)


# ---- 11: Merkle manifest

def _leaf(row: tuple, text) -> str:
    values = (row[0], row[3], row[2], row[4], text)
    return _sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def _climb(nodes: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    """The last node, and each leaf's siblings (before, after) by level."""
    steps, at, level = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    while len(level) > 1:
        runs = [level[i:i + 8] for i in range(0, len(level), 8)]
        for leaf, place in enumerate(at):
            run = runs[place // 8]
            steps[leaf].append(("".join(run[:place % 8]), "".join(run[place % 8 + 1:])))
        at, level = [p // 8 for p in at], [_sha("".join(r)) for r in runs]
    return level[0], steps


def _manifest(rows: list[tuple]) -> Counter:
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        own = sorted(((_null_first(r[0]), _leaf(r, r[1]), r) for r in rows if r[2] == lang), key=lambda x: x[:2])
        trees[lang] = (own, *_climb([x[1] for x in own]))
    root, above = _climb([trees[x][1] for x in langs])
    out = Counter()
    for lang, up in zip(langs, above):
        own, subroot, steps = trees[lang]
        for (_, leaf, r), path in zip(own, steps):
            path = path + up
            now = leaf
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0:
                now = _leaf(r, None if r[1] is None else r[1].translate(LOWER))
            for before, after in path:
                now = _sha(before + now + after)
            out[(r[0], leaf, subroot, root, _sha("".join(a + b for a, b in path)), now, now == root)] += 1
    return out


def _got(df) -> Counter:
    return Counter((r["doc_id"], r["leaf"], r["subroot"], r["root"], r["proof_sha256"], r["folded_root"], r["verified"]) for r in df.collect())


def test_manifest_cases(spark):
    got = _got(merkle.report(fixtures.documents(spark)))
    assert got == _manifest(fixtures.rows())
    assert {k[-1] for k in got} == {True, False}
    assert merkle.report(fixtures.none(spark)).count() == 0


def test_manifest_over_several_levels_windows_and_partitions(spark, monkeypatch):
    monkeypatch.setattr(merkle, "BLOCK", 2)
    monkeypatch.setattr(merkle, "ROWS_EACH", 7)
    lang = [None, "", "de", "en", "é", "\U0001F600"]
    rows = [(i % 290 if i % 11 else None, f"Text {i % 5}", lang[min(i % 9, 4)] if i < 599 else lang[5], "s", 3) for i in range(600)]
    rows += [(4, "same", "en", None, None)] * 70
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    assert _got(merkle.report(docs)) == _manifest(rows)


def test_manifest_of_one_row_is_its_leaf(spark):
    docs = spark.createDataFrame([(2, "A", None, "s", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    r = merkle.report(docs).first()
    assert r["leaf"] == r["subroot"] == r["root"] and r["proof_sha256"] == _sha("")


def test_written_manifest_names_changed_rows(spark):
    docs = fixtures.documents(spark)
    folder = f"{store.shared_dir(spark)}/manifest-{uuid.uuid4().hex}"
    merkle.Manifest(docs, merkle.FIELDS, "lang", "doc_id").write(folder)
    saved = spark.read.parquet(f"{folder}/rows")
    assert saved.count() == docs.count() and merkle.compare(saved, docs, merkle.FIELDS, "doc_id").count() == 0
    changed = docs.withColumn("text", F.when(F.col("doc_id") == 9, F.lit("new")).otherwise(F.col("text"))).where("doc_id is null or doc_id <> 12")
    got = sorted((r["doc_id"], r["n_saved"], r["n_now"]) for r in merkle.compare(saved, changed, merkle.FIELDS, "doc_id").collect())
    assert got == [(9, 0, 1), (9, 1, 0), (12, 1, 0)]
    assert spark.read.parquet(f"{folder}/subroots").count() == docs.select("lang").distinct().count()


# ---- 12: line dedup

def _deduplicated(rows: list[tuple], least: int, need: int) -> Counter:
    holders = defaultdict(set)
    key = lambda line: line.strip(SPACE).translate(LOWER)
    for k, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= least:
                holders[key(line)].add(k)
    keeper = {x: max(ids, key=_null_first) for x, ids in holders.items() if len(ids) >= need}
    out = Counter()
    for k, text in rows:
        own = (text or "").split("\n")
        rest = [x for x in own if keeper.get(key(x), k) == k]
        out[(k, len(own), len(own) - len(rest), "\n".join(rest))] += 1
    return out


def _lines_got(df) -> Counter:
    return Counter((r["doc_id"], r["n_lines"], r["n_dropped"], r["kept"]) for r in df.collect())


def _line_rows() -> list[tuple]:
    common, rare = "This Line Is In Very Many Documents", "ünïcode line of exactly"[:20]
    rows = [(i, f"  {common.upper() if i % 2 else common}\t\r\nown line number {i} of its document\nshort\n{'a line in pairs, number ' + str(i // 2)}\n"
             f"{'a line in fours, number ' + str(i % 60)}") for i in range(240)]
    rows += [(5, rows[5][1])] * 3 + [(None, f"{common}\n{rare}\n{rare}"), (None, rare), (7, rare + "\n\n" + rare), (8, rare + " "), (9, rare + " "), (10, None), (11, "")]
    return rows + [(1000 + i, "one very long text\n" * 3 + common + "\n" + "x" * 50_000) for i in range(4)]


def test_line_dedup_over_levels_and_buckets(spark, monkeypatch):
    monkeypatch.setattr(lines, "BUCKET_ROWS", 100)
    rows = _line_rows()
    docs = spark.createDataFrame([(*r, 1, "clash", 2) for r in rows], "doc_id long, text string, h long, keeper string, docs long").repartition(4)
    want = _deduplicated(rows, lines.MIN_CHARS, lines.NEED)
    for batches in (1, 2, 10):
        assert _lines_got(lines.deduplicate(docs, batches=batches)) == want, batches
    monkeypatch.setattr(lines, "SHARE", 1)
    assert _lines_got(lines.deduplicate(docs, least=1, need=2)) == _deduplicated(rows, 1, 2)


def test_line_dedup_cases(spark):
    rows = [(r[0], r[1]) for r in fixtures.rows()]
    assert _lines_got(lines.deduplicate(fixtures.documents(spark))) == _deduplicated(rows, 20, 3)
    assert lines.deduplicate(fixtures.none(spark)).count() == 0
    nulls = spark.createDataFrame([(None, "a line of twenty characters")] * 5, "doc_id long, text string")
    assert {r["n_dropped"] for r in lines.deduplicate(nulls).collect()} == {0}


def test_runs_stay_disjoint_and_are_merged(spark):
    index = lines.Runs(spark, f"{store.shared_dir(spark)}/runs-{uuid.uuid4().hex}", buckets=3, fan=2)
    seen, counts = set(), Counter()
    for b in range(7):
        own = range(b * 5, b * 5 + 12)
        batch = spark.createDataFrame([(h * 7919, h, 1 + b, 100 - b) for h in own], "h long, c long, docs long, keeper long")
        fresh = {r["c"] for r in index.ingest(batch).collect()}
        assert fresh == set(own) - seen
        seen |= fresh
        counts.update({h: 1 + b for h in own})
        assert all(len(level) < 2 for level in index.levels)
    held = [r["c"] for name in index.runs for r in spark.table(name).collect()]
    assert sorted(held) == sorted(seen) and len(index.levels) == 3
    assert {r["c"]: r["docs"] for r in index.found_in(6).collect()} == {h: n for h, n in counts.items() if n >= 6}
    plan = spark.table(index.runs[0]).join(spark.table(index.runs[-1]).hint("merge").select("h", "c"), ["h", "c"], "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan


# ---- 13: source divergence

def _audit(rows: list[tuple], min_docs: int, top: int) -> Counter:
    found, df = defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source in rows:
        ts = [t.translate(LOWER) for t in re.findall("[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        found[(lang or "", source or "")].update(ts)
        df[lang or ""].update(set(ts))
    out = Counter()
    for lang in df:
        kept = [t for t, n in df[lang].items() if n >= min_docs]
        v = len(kept)
        groups = {s: {t: c[t] for t in kept} for (x, s), c in found.items() if x == lang}
        whole = {t: sum(c[t] for c in groups.values()) for t in kept}

        def share(c: dict) -> dict:
            return {t: 1 + 10**9 * (n + 5) // (sum(c.values()) + 5 * v) for t, n in c.items()}

        p, q = {s: share(c) for s, c in groups.items()}, share(whole)
        for s in groups:
            pairs = sorted(((-sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in groups if o != s), key=lambda x: (x[0], x[1].encode()))
            own = sorted(((q[t] - p[s][t], t) for t in kept if groups[s][t] and p[s][t] > q[t]), key=lambda x: (x[0], x[1].encode()))
            for part, ranked in (("pair", pairs), ("term", own[:top])):
                out.update((lang, s, part, item, -f, i + 1) for i, (f, item) in enumerate(ranked))
    return out


def _audit_got(df) -> Counter:
    return Counter((r["lang"], r["source"], r["part"], r["item"], r["value"], r["rank"]) for r in df.collect())


def test_divergence_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(divergence, "HELD", 50)
    rows = []
    for i in range(300):
        words = [f"w{chr(97 + (i * j * j) % 23)}{chr(97 + j % (2 + i % 7))}" for j in range(i % 40)] + ["Été", "ÉTÉ", "l'an", "x1y", "\U0001F600x", "COMMON"] * (i % 3)
        rows.append((i % 50, None if i % 29 == 3 else " ".join(words), [None, "", "de", "fr"][i % 4 if i < 280 else 3], None if i % 5 == 2 else f"s{i % 6}"))
    rows += [(1, "only rare words here", "lone", "one"), (2, None, "lone", "two"), (3, "alone", "single", None)]
    docs = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "doc_id long, text string, lang string, source string, n long, value long, rank int").repartition(4)
    for min_docs, top in ((5, 4), (1, 50), (10_000, 50)):
        assert _audit_got(divergence.Audit(docs, min_docs=min_docs).report(top)) == _audit(rows, min_docs, top), (min_docs, top)


def test_divergence_cases(spark):
    rows = [(r[0], r[1], r[2], r[3]) for r in fixtures.rows()]
    assert _audit_got(divergence.Audit(fixtures.documents(spark), min_docs=2).report()) == _audit(rows, 2, 50)
    assert divergence.Audit(fixtures.none(spark)).report().count() == 0


def test_share_is_exact_for_large_counts(spark):
    big = 10**13 + 7
    df = spark.range(1).select(divergence.share(F.lit(big), F.lit(3 * big + 1), F.lit(10**6)).alias("p"))
    assert df.first()["p"] == 1 + 10**9 * (big + 5) // (3 * big + 1 + 5 * 10**6)
