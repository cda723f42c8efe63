"""The registered queries opN_* and the pipeline, with their DuckDB SQL."""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

import corpus_pipeline
from metrolake.llm import decontaminate, divergence, html, jaccard, lines, merkle, mixing, neighbours, pii, quality, sharding, store, substrings, tokens

CATALOG: dict[str, tuple] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op3_rendezvous_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents over 40 shards of equal weight, with the growth to 41."""
    return sharding.place(_table(spark, sf_dir, "documents"), shards=40)


# crc32 as a fold over the text's bytes; its table comes from the bitwise rule.
OP3_SQL = """
WITH crc_table AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i::BIGINT, [0,0,0,0,0,0,0,0]::BIGINT[]),
             lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM range(256) r(i))),
base AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS body,
         md5(coalesce(doc_id::VARCHAR, '')) AS m,
         (SELECT greatest(1, ceil(count(*) / 800000.0))::BIGINT FROM documents) AS nb
  FROM documents),
seeds AS (
  SELECT *, ('0x' || substr(m, 1, 12))::BIGINT % 2147483647 AS a, ('0x' || substr(m, 13, 12))::BIGINT % 2147483647 AS b,
         hex(encode(body)) AS h, octet_length(encode(body)) AS n
  FROM base),
scores AS (
  SELECT r, j, (((t * t) % 2147483647) * t + b) % 2147483647 AS u
  FROM (SELECT r, b, j, (a + j * 1640531527) % 2147483647 AS t FROM seeds, range(41) x(j))),
best AS (
  SELECT r, first(j ORDER BY u DESC, j) FILTER (WHERE j < 40) AS shard, first(j ORDER BY u DESC, j) AS grown
  FROM scores GROUP BY r),
crc AS (
  SELECT r, xor(list_reduce(list_prepend(4294967295::BIGINT,
              list_transform(range(n), lambda k: ('0x' || substr(h, 2 * k + 1, 2))::BIGINT)),
              lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) AS crc
  FROM seeds, crc_table)
SELECT doc_id, (n + 16)::BIGINT AS size, crc AS text_crc32, 'key' AS law, shard::INTEGER AS shard,
       (row_number() OVER (PARTITION BY shard ORDER BY b % nb, doc_id, crc, n) - 1)::BIGINT AS slot,
       grown::INTEGER AS grown_shard
FROM seeds JOIN best USING (r) JOIN crc USING (r)
"""

CATALOG["op3_rendezvous_sharding"] = (op3_rendezvous_sharding, OP3_SQL)


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal-data spans of every whole text."""
    return pii.report(_table(spark, sf_dir, "documents"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written as token-id files, then summed up from the files."""
    from public_tokenizers import path
    out = f"{store.shared_dir(spark)}/token-ids-{uuid.uuid4().hex}"
    tokens.write(_table(spark, sf_dir, "documents"), out, path("byte_bpe_50k.json"))
    return tokens.summary(spark, out)


CATALOG["op6_pii"] = (op6_pii, None)
CATALOG["op8_token_files"] = (op8_token_files, None)


def op10_quality_pu(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of every whole text by positive-unlabelled learning."""
    return quality.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


CATALOG["op10_quality_pu"] = (op10_quality_pu, None)


def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every whole page."""
    return html.report(_table(spark, sf_dir, "pages"))


CATALOG["op2_main_text"] = (op2_main_text, None)


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document in a mix of all sources with weights 1, 2, 3, repeating."""
    return mixing.Mix(_table(spark, sf_dir, "documents")).taken()


CATALOG["op1_mixing"] = (op1_mixing, None)


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that cover a benchmark item, with the item and the share covered."""
    return decontaminate.matches(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).drop("hash")


CATALOG["op5_decontaminate"] = (op5_decontaminate, None)


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document under 20-word windows that start earlier elsewhere."""
    out = substrings.deduplicate(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"),
                      F.size("removed").alias("n_intervals"))


OP4_SQL = r"""
WITH docs AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
windows AS (SELECT doc_id, s, array_to_string(ws[s:s + 19], ' ') AS body FROM docs, range(1, len(ws) - 18) r(s)),
later AS (SELECT doc_id, s, row_number() OVER (PARTITION BY body ORDER BY doc_id, s) AS nth FROM windows),
covered AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS i FROM later WHERE nth > 1),
words AS (SELECT doc_id, i, ws[i] AS w FROM docs, range(1, len(ws) + 1) r(i)),
marked AS (SELECT words.*, covered.i IS NOT NULL AS gone FROM words LEFT JOIN covered USING (doc_id, i)),
runs AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS begins FROM marked),
per AS (SELECT doc_id, count(*) AS n, count(*) FILTER (WHERE gone) AS removed, string_agg(w, ' ' ORDER BY i) FILTER (WHERE NOT gone) AS kept,
               count(*) FILTER (WHERE begins) AS intervals FROM runs GROUP BY doc_id)
SELECT docs.doc_id, len(ws)::BIGINT AS n_words, coalesce(removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256,
       coalesce(intervals, 0)::INTEGER AS n_intervals
FROM docs LEFT JOIN per USING (doc_id)
"""

CATALOG["op4_substring_dedup"] = (op4_substring_dedup, OP4_SQL)


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 3-word shingle sets have a Jaccard similarity of 0.9 or more."""
    return jaccard.link(_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


OP9_SQL = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(ws[s:s + 2], ' ') AS body FROM docs, range(1, greatest(len(ws) - 1, 2)) r(s) WHERE len(ws) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM shingles a JOIN shingles b ON a.body = b.body AND a.doc_id <> b.doc_id
  JOIN sizes p ON p.doc_id = a.doc_id JOIN sizes q ON q.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, p.n, q.n HAVING 100 * count(*) >= 90 * (p.n + q.n - count(*))),
reach AS (SELECT doc_id AS x, doc_id AS y FROM docs UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x)
SELECT docs.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, (SELECT min(y) FROM reach WHERE x = docs.doc_id) AS component_id
FROM docs LEFT JOIN sizes USING (doc_id)
"""

CATALOG["op9_jaccard_join"] = (op9_jaccard_join, OP9_SQL)


def op7_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five nearest rows of every fiftieth vector, by search on an NN-descent graph."""
    return neighbours.nearest(_table(spark, sf_dir, "embeddings"))


CATALOG["op7_nn_descent"] = (op7_nn_descent, None)
CATALOG["pipeline"] = (corpus_pipeline.run, corpus_pipeline.ORACLE_SQL)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle proofs of all documents, per language and under one root, folded again after tampering."""
    return merkle.report(_table(spark, sf_dir, "documents"))


def _merkle_sql(levels: int = 7, over: int = 3) -> str:
    """Levels written out one by one: a group of one node stays as it is, without siblings."""
    def field(x: str) -> str:
        return f"coalesce(octet_length(encode(({x})::VARCHAR))::VARCHAR || ':' || ({x})::VARCHAR, '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(field(x) for x in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    def tree(name: str, depth: int) -> str:
        out = ""
        for k in range(depth):
            w = "PARTITION BY g, pos // 8 ORDER BY pos ROWS BETWEEN"
            out += f"""
{name}_s{k} AS (SELECT g, pos, n, coalesce(string_agg(h, '') OVER ({w} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
  coalesce(string_agg(h, '') OVER ({w} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name}_n{k}),
{name}_n{k + 1} AS (SELECT g, pos // 8 AS pos, (any_value(n) + 7) // 8 AS n,
  CASE WHEN any_value(n) = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY pos)) END AS h FROM {name}_n{k} GROUP BY g, pos // 8),"""
        return out

    def fold(of: str, names: list[str]) -> str:
        for x in names:
            of = f"CASE WHEN {x}.n = 1 THEN {of} ELSE sha256({x}.l || {of} || {x}.r) END"
        return of

    docs, subs = [f"docs_s{k}" for k in range(levels)], [f"subs_s{k}" for k in range(over)]
    step = lambda froms, start, parts: froms + "".join(f" JOIN {x} ON {x}.g = {start}.g AND {x}.pos = {start}.pos // {8 ** k}" for k, x in enumerate(parts))
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH crc_table AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i::BIGINT, [0,0,0,0,0,0,0,0]::BIGINT[]),
             lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM range(256) r(i))),
leaves AS (SELECT doc_id, coalesce('=' || lang, '-') AS g, {leaf("text")} AS h,
  CASE WHEN xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(len(doc_id::VARCHAR)), lambda k: ascii(substr(doc_id::VARCHAR, k + 1, 1))::BIGINT)),
              lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 3 = 0 THEN {leaf(lowered)} END AS tampered
  FROM documents, crc_table),
docs_n0 AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, h) - 1 AS pos, count(*) OVER (PARTITION BY g) AS n FROM leaves),
{tree("docs", levels)}
subs_n0 AS (SELECT '' AS g, g AS sub, h, row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS n FROM docs_n{levels}),
{tree("subs", over)}
above AS (SELECT sub, subs_n0.h AS subroot, (SELECT any_value(h) FROM subs_n{over}) AS root, {" || ".join(f"{x}.l || {x}.r" for x in subs)} AS siblings,
  {", ".join(f"{x}.n AS n{k}, {x}.l AS l{k}, {x}.r AS r{k}" for k, x in enumerate(subs))}
  FROM {step("subs_n0", "subs_n0", subs)}),
folded AS (SELECT doc_id, d.h AS leaf, d.g, {" || ".join(f"{x}.l || {x}.r" for x in docs)} AS siblings, {fold("coalesce(tampered, d.h)", docs)} AS f0
  FROM {step("docs_n0 d", "d", docs)}),
up AS (SELECT folded.*, subroot, root, above.siblings AS more, n0, l0, r0, {", ".join(f"n{k}, l{k}, r{k}" for k in range(1, over))} FROM folded JOIN above ON sub = folded.g),
{"".join(f"up{k} AS (SELECT *, CASE WHEN n{k} = 1 THEN f{k} ELSE sha256(l{k} || f{k} || r{k}) END AS f{k + 1} FROM {'up' if k == 0 else f'up{k - 1}'})," for k in range(over)).rstrip(",")}
SELECT doc_id, leaf, subroot, root, sha256(siblings || more) AS proof_sha256, f{over} AS folded_root, f{over} = root AS verified FROM up{over - 1}
"""


CATALOG["op11_merkle_manifest"] = (op11_merkle_manifest, _merkle_sql())


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of all documents that at least three documents hold, kept in the largest doc_id only."""
    out = lines.deduplicate(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


OP12_SQL = r"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
lines AS (SELECT r, doc_id, i, ls[i] AS line,
  translate(trim(ls[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM docs, range(1, len(ls) + 1) x(i)),
hot AS (SELECT k, max(doc_id) AS keeper FROM lines WHERE length(k) >= 20 GROUP BY k
        HAVING count(DISTINCT doc_id) + max(CASE WHEN doc_id IS NULL THEN 1 ELSE 0 END) >= 3),
marked AS (SELECT lines.*, hot.k IS NOT NULL AND doc_id IS DISTINCT FROM keeper AS gone FROM lines LEFT JOIN hot ON lines.k = hot.k)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY r
"""

CATALOG["op12_line_dedup"] = (op12_line_dedup, OP12_SQL)


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence of every two sources of a language, and each group's fifty terms furthest above its language."""
    return divergence.Audit(_table(spark, sf_dir, "documents")).report()


OP13_SQL = r"""
WITH docs AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
words AS (SELECT r, lang, source, unnest(ts) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS m FROM words GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
vocab AS (SELECT lang, count(*) AS v, sum(m) AS t FROM kept GROUP BY lang),
grp AS (SELECT DISTINCT lang, source FROM docs),
found AS (SELECT lang, source, term, count(*) AS n FROM words GROUP BY ALL),
every AS (SELECT grp.lang, grp.source, kept.term, m, coalesce(n, 0) AS n FROM grp JOIN kept USING (lang) LEFT JOIN found USING (lang, source, term)),
totals AS (SELECT lang, source, sum(n) AS t FROM every GROUP BY lang, source),
shares AS (SELECT every.*, 1 + (1000000000::HUGEINT * (n + 5)) // (totals.t + 5 * v) AS p, 1 + (1000000000::HUGEINT * (m + 5)) // (vocab.t + 5 * v) AS q
  FROM every JOIN totals USING (lang, source) JOIN vocab USING (lang)),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(sum(abs(x.p - y.p)), 0) AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN shares x ON x.lang = a.lang AND x.source = a.source LEFT JOIN shares y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
  GROUP BY ALL),
ranked AS (
  SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM pairs
  UNION ALL
  SELECT lang, source, 'term', term, p - q, row_number() OVER (PARTITION BY lang, source ORDER BY p - q DESC, term) FROM shares WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""

CATALOG["op13_source_divergence"] = (op13_source_divergence, OP13_SQL)
