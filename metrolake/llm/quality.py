"""Text quality by positive-unlabelled learning.

A linear model on surface statistics of a text is fitted with the non-negative
unbiased risk (Kiryo et al., 2017)::

    R = pi * E_P[l(g)] + max(0, E_U[l(-g)] - pi * E_P[l(-g)])

from trusted positives P (label 1), unlabelled text U and a class prior pi that
is estimated from how P's scores sit among U's. Negative labels are never used.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

SAMPLE = 10_000             # most trusted positives, and most unlabelled rows, that a fit takes
THRESHOLD = 0.3
_PUNCT = bytes(b for b in range(33, 127) if not chr(b).isalnum())
_IS_PUNCT = np.isin(np.arange(256), list(_PUNCT))
N_FEATURES = len(_PUNCT) + 15


def features(text: str | None) -> np.ndarray:
    """Surface statistics of a whole text (null as empty): log shares of each
    punctuation mark, of upper case, digits, spaces, lines and other bytes, and
    repetition of words and lines. One pass; long texts cost in proportion."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    b = np.frombuffer(raw, np.uint8)
    count = np.bincount(b, minlength=256).astype(float)
    n = max(1, len(b))
    words, lines = raw.split(), [x for x in raw.split(b"\n") if x.strip()]
    letters = count[65:91].sum() + count[97:123].sum() + count[128:].sum()
    twice = int(((b[1:] == b[:-1]) & _IS_PUNCT[b[1:]]).sum()) if len(b) > 1 else 0
    shares = [*count[list(_PUNCT)], count[65:91].sum(), count[48:58].sum(), count[32], count[10],
              count[128:].sum(), twice, count[list(_PUNCT)].sum()]
    w, m = max(1, len(words)), max(1, len(lines))
    rates = [sum(x.isupper() and len(x) > 1 for x in words) / w, sum(not x.isalnum() for x in words) / w,
             1 - len(set(lines)) / m,
             sum(map(bytes.__eq__, words, words[1:])) / w, 1 - len(set(words)) / w]
    return np.array([*np.log((np.array(shares) + 0.5) / n), *np.log(np.array(rates) + 0.002),
                     np.log1p(len(words)), letters / n, len(raw) / w / 10], np.float32)


@dataclass(frozen=True)
class Model:
    """Margin = weights . (features - mean) / scale + bias; the score is its logistic."""
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights + self.bias

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(x)))


def _minimise(p: np.ndarray, u: np.ndarray, prior: float, steps: int = 600, rate: float = 0.05,
              decay: float = 1e-3) -> tuple[np.ndarray, float]:
    """Adam on the non-negative risk with logistic loss; when the negative part
    falls below zero, the step climbs back out of it, as the method asks."""
    x = lambda a: np.hstack([a, np.ones((len(a), 1))])
    p, u = x(p), x(u)
    w, m, v = np.zeros(p.shape[1]), 0.0, 0.0
    for t in range(1, steps + 1):
        gp, gu = p @ w, u @ w
        sp, su = 1 / (1 + np.exp(-gp)), 1 / (1 + np.exp(-gu))
        negative = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
        d_pos = prior * (p.T @ (sp - 1)) / len(p)
        d_neg = u.T @ su / len(u) - prior * (p.T @ sp) / len(p)
        grad = (d_pos + d_neg if negative >= 0 else -d_neg) + decay * np.append(w[:-1], 0)
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        w = w - rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return w[:-1], float(w[-1])


def estimate_prior(p: np.ndarray, u: np.ndarray) -> float:
    """Share of positives in U: the least ratio of U's to P's upper tail over the
    thresholds above which P keeps at least half its mass, where U holds hardly
    any negatives (scores of a classifier of P against U)."""
    cuts = np.quantile(p, np.linspace(0.02, 0.5, 25))
    ratio = [(u >= c).mean() / max((p >= c).mean(), 1e-9) for c in cuts]
    return float(np.clip(min(ratio), 0.05, 0.98))


def fit(p: np.ndarray, u: np.ndarray) -> Model:
    """Model from feature rows of trusted positives and of unlabelled texts. Without
    either there is nothing to learn, and the model scores every text 1."""
    if not len(p) or not len(u):
        return Model(np.zeros(N_FEATURES), np.ones(N_FEATURES), np.zeros(N_FEATURES), 30.0, 1.0)
    both = np.vstack([p, u]).astype(float)
    mean, scale = both.mean(0), both.std(0) + 1e-6
    z = lambda a: np.clip((a - mean) / scale, -8, 8)
    first = _minimise(z(p), z(u), 0.5, steps=200)          # P against U, for the prior only
    prior = estimate_prior(z(p) @ first[0], z(u) @ first[0])
    w, b = _minimise(z(p), z(u), prior)
    return Model(mean, scale, w, b, prior)


def _matrix(texts: pd.Series) -> np.ndarray:
    return np.stack([features(t) for t in texts]) if len(texts) else np.zeros((0, N_FEATURES), np.float32)


def _sample(rows: DataFrame, key: str, text: str) -> np.ndarray:
    """Features of the ``SAMPLE`` rows with the least key hashes, in that order."""
    few = (rows.select(F.xxhash64(F.col(key).cast("string")).alias("h"), F.col(key).alias("k")).orderBy("h", "k").limit(SAMPLE))
    cut = few.agg(F.max("h")).first()[0]
    if cut is None:
        return np.zeros((0, N_FEATURES), np.float32)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            x = _matrix(b["t"])
            yield pd.DataFrame({"h": b["h"], "x": [r.tobytes() for r in x]})

    near = rows.select(F.xxhash64(F.col(key).cast("string")).alias("h"), F.col(text).alias("t")).where(F.col("h") <= F.lit(cut))
    found = near.mapInPandas(run, "h long, x binary").limit(2 * SAMPLE)         # a key that very many rows share stays bounded
    got = sorted((r["h"], bytes(r["x"])) for r in found.toLocalIterator())
    return np.array([np.frombuffer(x, np.float32) for _, x in got[:SAMPLE]])


def held_out(key: Column) -> Column:
    """Rows whose labels are never learnt: crc32 of the key as text divides by 5 (a null key counts as '')."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> Model:
    """Fit on the rows that are not held out: trusted positives are documents whose
    labels are all 1; the unlabelled sample is drawn from all those documents,
    whatever their labels. At most ``SAMPLE`` rows of each, by key hash."""
    rows = docs.where(~held_out(F.col(key))).select(F.col(key).alias("_k"), F.col(text).cast("string").alias("_t"))
    good = (labels.where(F.col(label).isNotNull() & ~held_out(F.col(key))).groupBy(F.col(key).alias("_k"))
            .agg(F.min(label).alias("_q")).where("_q = 1").select("_k"))
    chosen = good.orderBy(F.xxhash64(F.col("_k").cast("string")), "_k").limit(2 * SAMPLE)       # bounded, so it may be broadcast
    return fit(_sample(rows.join(F.broadcast(chosen), "_k"), "_k", "_t"), _sample(rows, "_k", "_t"))


def score(text: Column, model: Model) -> Column:
    """Score in [0, 1] of a whole text; higher means label 1 is likelier. Null counts as empty."""
    @F.pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(_matrix(texts)), dtype=float)

    return run(text)


def report(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, held_out, score, predicted (score >= 0.3). Scoring
    is one narrow pass; repeated rows keep a row each, other columns are ignored."""
    model = train(docs, labels, key, text)
    return (docs.select(F.col(key), held_out(F.col(key)).alias("held_out"), score(F.col(text).cast("string"), model).alias("score"))
            .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int")))


def keep(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents, with all their columns, that the classifier accepts."""
    model = train(docs, labels, key, text)
    return docs.where(score(F.col(text).cast("string"), model) >= THRESHOLD)
