"""Personal-data spans: patterns propose, validators confirm, context rescores.

Each kind has a pattern, a validator and a base score; words near a span raise
its score, and words that speak of something else lower it. The four base
kinds and IBANs (mod-97) keep every validated match whatever its score; US social
security numbers and passport numbers (one or two letters and six to nine digits)
have no check digits and must reach ``threshold`` by their context.
"""
from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType, ArrayType

# Fixed values of the query contract: patterns of the base kinds, in their order.
BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
ADDED = {
    "iban": r"\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?\b",
    "ssn": r"\b(?!000|666|9[0-9]{2})[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}\b",
    "passport": r"\b[A-Z]{1,2}[0-9]{6,9}\b",
}
KINDS = [*BASE, *ADDED]
KEPT = frozenset((*BASE, "iban"))       # kept whatever the score
# Length of an IBAN by its country (the registry, and countries that use IBANs outside it).
IBAN_LENGTH = {s[:2]: int(s[2:]) for s in (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BI27 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DJ27 DK18 DO28 EE20 EG29 ES24 FI18 FK18 FO18 FR27 GB22 GE22 GI23 "
    "GL18 GR27 GT28 HN28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 LY25 MC27 MD24 ME22 MK19 MN20 MR27 MT31 MU30 NI28 "
    "NL18 NO15 OM23 PK24 PL28 PS29 PT25 QA29 RO24 RS22 RU33 SA24 SC31 SD18 SE24 SI19 SK24 SM27 SO23 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20 YE30 "
    "AO25 BF28 BJ28 CF27 CG27 CI28 CM27 CV25 DZ26 GA27 GQ27 GW25 IR26 KM27 MA28 MG27 ML28 MZ25 NE28 SN28 TD27 TG28").split()}
# What a text must hold for the kind to occur at all (skips the pattern, never a match).
NEEDS = {"email": "@", "phone": "+", "ssn": "-"}
SCORE = {"email": 0.9, "ip": 0.7, "card": 0.8, "phone": 0.6, "iban": 0.8, "ssn": 0.4, "passport": 0.4}
CONTEXT = {
    "email": ("email", "e-mail", "mail", "contact", "correo", "courriel"),
    "ip": ("ip", "address", "host", "server", "login"),
    "card": ("card", "visa", "mastercard", "credit", "payment", "tarjeta", "carte", "karte"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "telefon", "teléfono", "téléphone"),
    "iban": ("iban", "bank", "account", "konto", "cuenta", "compte"),
    "ssn": ("ssn", "social", "security"),
    "passport": ("passport", "reisepass", "pasaporte", "passeport"),
}
AGAINST = ("version", "isbn", "order", "invoice", "serial", "example")
WORD = re.compile(r"[^\W\d_]+")
DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    """Luhn check: every second digit from the right doubled, digit sums end in 0."""
    total = 0
    for at, d in enumerate(reversed(digits)):
        n = int(d) * (1 + at % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """ISO 7064 mod-97-10 of an account number: first four characters to the end, letters as 10..35."""
    s = iban.replace(" ", "")
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def _valid(kind: str, found: str) -> bool:
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in found.split("."))
    if kind in ("card", "phone"):
        digits = re.sub("[^0-9]", "", found)
        return 12 <= len(digits) <= 19 and luhn(digits) if kind == "card" else 9 <= len(digits) <= 15
    return mod97(found) if kind == "iban" else True


# A start inside a run of digits can match only where the run's own start does, so the
# look-behind changes no match and keeps long runs linear; emails are anchored at "@" below.
_COMPILED = {k: re.compile(("(?<![0-9])" if k == "ip" else "") + p) for k, p in {**BASE, **ADDED}.items()}
_IBAN = {n: re.compile(r"(?:\x20?[A-Z0-9]{4}){%d}" % (n // 4 - 1) + (r"\x20?[A-Z0-9]{%d}\b" % (n % 4) if n % 4 else r"\b"))
         for n in set(IBAN_LENGTH.values())}
_IBAN_START = re.compile(r"\b[A-Z]{2}[0-9]{2}")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(BASE["email"].partition("@")[2])


def _matches(kind: str, text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping matches of the kind's pattern, in time linear in the text.
    For iban the valid ones: first those of the length of their country, then beside them
    those as long as the pattern goes."""
    if kind == "iban":
        starts, spans = [m.span() for m in _IBAN_START.finditer(text)], []
        for own in (True, False):
            taken, done, i = list(spans), 0, 0
            for start, at in starts:
                while i < len(taken) and taken[i][1] <= start:
                    done, i = max(done, taken[i][1]), i + 1
                if start < done or i < len(taken) and taken[i][0] <= start:
                    continue
                rule = _IBAN.get(IBAN_LENGTH.get(text[start:start + 2])) if own else _COMPILED[kind]
                found = rule and rule.match(text, at if own else start)
                if found and mod97(text[start:found.end()]) and not (i < len(taken) and taken[i][0] < found.end()):
                    spans.append((start, found.end()))
                    done = found.end()
            spans.sort()
        yield from spans
        return
    if kind != "email":
        yield from (m.span() for m in _COMPILED[kind].finditer(text))
        return
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def find(text: str | None, window: int = 60, threshold: float = 0.6) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) of every span, by start and then kind.

    Offsets are code points, the end is exclusive; null counts as empty. Failing
    matches are dropped without a retry inside them, but an IBAN may start at any
    country code. ``window`` code points on
    each side give the context: a listed word adds 0.3, a contrary one takes 0.3."""
    text = text or ""
    digits = DIGIT.search(text) is not None
    spans = []
    for kind in KINDS:
        if (kind != "email" and not digits) or NEEDS.get(kind, "") not in text:
            continue
        for start, end in _matches(kind, text):
            if not _valid(kind, text[start:end]):
                continue
            near = text[max(0, start - window):start] + " " + text[end:end + window]
            words = {w.lower() for w in WORD.findall(near)}
            score = SCORE[kind] + 0.3 * any(w in words for w in CONTEXT[kind]) - 0.3 * any(w in words for w in AGAINST)
            if kind in KEPT or score >= threshold:
                spans.append((kind, start, end, round(min(1.0, max(0.0, score)), 3)))
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


SPANS = ArrayType(StructType([StructField("kind", StringType()), StructField("start", IntegerType()),
                              StructField("end", IntegerType()), StructField("score", DoubleType())]))


def spans(text: Column, window: int = 60, threshold: float = 0.6) -> Column:
    """Array of (kind, start, end, score) for a text column; null and empty texts give an empty array."""
    @F.pandas_udf(SPANS)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([[dict(zip(("kind", "start", "end", "score"), s)) for s in find(t, window, threshold)]
                             for t in texts], dtype=object)

    return run(text)


def _joined(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def report(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: counts of the base kinds, sha256 of the base spans, all spans as
    text, and their scores. One narrow pass: no shuffle, no join; repeated rows,
    extra columns and empty tables go through unchanged in number."""
    found = df.select(F.col(key), spans(F.col(text).cast("string")).alias("_found"))
    base = F.filter("_found", lambda s: s["kind"].isin(*BASE))
    count = lambda k: F.size(F.filter("_found", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select(key, *[count(k) for k in BASE], F.sha2(_joined(base), 256).alias("base_sha256"),
                        _joined(F.col("_found")).alias("spans"),
                        F.transform("_found", lambda s: s["score"]).alias("scores"))


def mask(df: DataFrame, text: str = "text", threshold: float = 0.6) -> DataFrame:
    """Rows with every span replaced by its kind in angle brackets; overlapping spans
    merge under the kind that starts first. Null texts stay null."""
    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([_masked(t, threshold) for t in texts], dtype=object)

    return df.withColumn(text, run(F.col(text)))


def _masked(text: str | None, threshold: float) -> str | None:
    if text is None:
        return None
    out, done = [], 0
    for kind, start, end, _ in find(text, threshold=threshold):
        if start >= done:
            out += [text[done:start], f"<{kind}>"]
        done = max(done, end)
    return "".join(out) + text[done:]

