"""Main text of web pages by a maximum-scoring run of tokens.

A page is a sequence of words and tags. Words score up and tags score down,
with weights (log odds of lying in the article) learnt from labelled pages:
those whose markup names the article. One linear scan finds the contiguous run
with the greatest sum; its blocks, without those of boilerplate elements
inside it, are the text.
"""
from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

SAMPLE = 2000                       # most labelled pages that the weights are learnt from
# Fixed lists of HTML element names and of words in class, id and role values.
SKIPPED = ("script", "style", "template", "noscript", "textarea", "select", "svg", "iframe", "object", "math")
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br".split())
SPACED = frozenset("br img td th".split())          # inline, but they part words
BOILER_TAGS = frozenset("head nav header footer aside form button menu dialog fieldset".split())
CONTENT_TAGS = frozenset(("article", "main"))
BOILER_WORDS = frozenset("ad ads adv advert adverts advertisement advertising banner promo promotion sponsor sponsored nav navbar navigation menu breadcrumb breadcrumbs sidebar widget footer header masthead comment comments reply replies disqus cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login search share sharing social related recommended pagination pager toolbar copyright legal complementary contentinfo hidden skip".split())
CONTENT_WORDS = frozenset("article content post entry story main".split())
# First words of compound names whose last word says what the element is (site-footer); others (with-sidebar, overflow-hidden) tell of a layout or state.
PLACES = frozenset("site page main global top bottom left right primary secondary sub post entry article blog user reader google inline mobile desktop sticky floating social cookie newsletter email g c js widget block section".split())
STATES = frozenset("open opened closed free enabled disabled active inactive on off fixed visible collapsed expanded".split())     # last words of names that tell of a state (comments-open)
CLOSES_P = frozenset("address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre search section summary table ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
TAG_CLASSES = frozenset("p b br a li ul ol div span section table tr td th h1 h2 h3 h4 h5 h6 img input label option blockquote pre figure article main nav header footer aside form".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(" + "|".join(SKIPPED) + r")(?=[\s/>]).*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)", re.S | re.I)
_NAMED = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORDS = re.compile(r"[a-z]+")


def _boiler_name(words: list[str], in_content: bool) -> bool:
    """Whether a class, id or role name, as its words, names boilerplate: a listed word
    by itself or first (ad-slot, comments-area), or last after a place (site-footer)."""
    listed = lambda w: w in BOILER_WORDS and not (w == "header" and in_content)
    if len(words) < 2:
        return bool(words) and listed(words[0])
    if words[-1] in STATES:
        return False
    return (listed(words[0]) and words[0] != "hidden") or (listed(words[-1]) and words[0] in PLACES)


def _kind(name: str, attributes: str, in_content: bool) -> str:
    """'boiler' (by its element name), 'named' (boilerplate by class, id or role), 'both' (an
    article that is named so), 'content' or '' for an element. Whole names are judged, not any
    word in them; main, and an article or block with a content name, is content whatever else it is named."""
    if name in BOILER_TAGS and not (name == "header" and in_content):
        return "boiler"
    if name in ("body", "html"):
        return ""
    names = [_WORDS.findall(n) for m in _NAMED.finditer(attributes) for n in "".join(filter(None, m.groups())).lower().split()] if "=" in attributes else []
    boiler = any(_boiler_name(n, in_content) for n in names)
    named = any(CONTENT_WORDS.intersection(n) and not BOILER_WORDS.intersection(n) for n in names)
    if name == "main" or (name in ("article", "div", "section", "td") and named):
        return "content"
    if name == "article":
        return "both" if boiler else "content"
    return "named" if boiler else ""


def tokens(page: str | None) -> list[tuple[str, str, str]]:
    """(class, context, text) in page order. Text tokens have class 'w'; tags have
    their name (or 'other') and no text. The context says where a token stands:
    'content', 'inner' (boilerplate inside content), 'boiler' or 'plain'. Null
    counts as empty; broken markup ends where the page ends.

    Content wins over elements around it that are boilerplate by name only: main always,
    an article where none came before that element, other content outside content.
    An article that is itself named boilerplate (a comment) is content where nothing around it is either."""
    out, page, at = [], page or "", 0
    stack: list[tuple[str, str, str, int]] = []         # name, kind, context, lock: 1 no article, 2 nothing can be content inside
    seen = False                                        # an article, or other content as a whole

    def top() -> tuple[str, int]:
        return stack[-1][2:] if stack else ("plain", 0)

    def push(name: str, kind: str) -> None:
        nonlocal seen
        now, lock = top()
        if kind == "both":
            kind = "content" if now == "plain" else "named"
        if kind == "content" and (now in ("plain", "content") or (lock < 2 if name == "main" else lock == 0 and (name == "article" or now == "boiler"))):
            now = "content"
            seen = seen or name == "article"
        elif kind in ("boiler", "named"):
            now = "inner" if now in ("content", "inner") else "boiler"
            lock = max(lock, 2 if kind == "boiler" else int(seen))
        stack.append((name, kind, now, lock))

    def pop(name: str) -> None:
        nonlocal seen
        while stack:
            n, kind, where, _ = stack.pop()
            seen = seen or (kind == "content" and where == "content" and n != "main")
            if n == name:
                break

    def open_p() -> bool:
        """Whether a p is open with nothing but inline elements in it."""
        for n, *_ in reversed(stack):
            if n not in INLINE:
                return n == "p"
        return False

    now = "plain"
    for m in _TOKEN.finditer(page):
        if m.start() > at:
            out.append(("w", now, page[at:m.start()]))
        at = m.end()
        name = (m.group(3) or m.group(6) or "").lower()
        if not name:
            out.append(("block" if m.group(1) else "note", now, ""))
            continue
        closing, attributes = m.group(2) or m.group(5), m.group(4) or m.group(7) or ""
        if not closing:
            if name == "body":
                stack.clear()
            if name in CLOSES_P and open_p():
                pop("p")
            if name not in VOID and not attributes.endswith("/"):
                kind = _kind(name, attributes, top()[0] == "content")
                if name not in INLINE or kind == "named" or any(n == name for n, *_ in stack):
                    push(name, kind)
            now = top()[0]
        out.append((name, now, ""))
        if closing and any(n == name for n, *_ in stack):
            pop(name)
            now = top()[0]
    if at < len(page):
        out.append(("w", now, page[at:]))
    return out


def _classes(seq: list[tuple[str, str, str]], marked: bool) -> list[tuple[str, int]]:
    """(weight class, count) of each token: a word's class is its context, where
    unmarked pages know no content; a tag's class is its name."""
    return [("w:" + (c if marked else {"content": "plain", "inner": "boiler"}.get(c, c)), len(t.split())) if k == "w"
            else ("t:" + (k if k in TAG_CLASSES else "other"), 1) for k, c, t in seq]


def learn(pages: DataFrame, key: str = "page_id", page: str = "html") -> dict[bool, dict[str, float]]:
    """Weights for marked and unmarked pages: log odds of each class inside against
    outside the article, from the labelled pages (at most ``SAMPLE``, by key
    hash). Counts start from a prior, so unseen classes and an empty table still
    have weights: words up outside boilerplate, tags a little down."""
    few = (pages.select(F.xxhash64(F.col(key).cast("string")).alias("h"), F.col(page).cast("string").alias("t"))
           .where(F.lower("t").rlike("<(article|main)[ >]")))
    cut = few.select("h").orderBy("h").limit(SAMPLE).agg(F.max("h")).first()[0]

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = Counter()
        for b in batches:
            for t in b["t"]:
                seq = tokens(t)
                for marked in (True, False):
                    for (c, n), (_, where, _) in zip(_classes(seq, marked), seq):
                        total[marked, c, where == "content"] += n
        yield pd.DataFrame([(m, c, i, n) for (m, c, i), n in total.items()], columns=["marked", "c", "inside", "n"])

    rows = [] if cut is None else (few.where(F.col("h") <= F.lit(cut)).mapInPandas(count, "marked boolean, c string, inside boolean, n long")
                                   .groupBy("marked", "c", "inside").agg(F.sum("n").alias("n")).collect())
    seen = {(r["marked"], r["c"], r["inside"]): r["n"] for r in rows}
    return {marked: _weights({(c, i): n for (m, c, i), n in seen.items() if m == marked}, marked) for marked in (True, False)}


def _weights(seen: dict[tuple[str, bool], int], marked: bool) -> dict[str, float]:
    prior = {"w:content": (50, 1), "w:plain": (1, 20) if marked else (20, 1), "w:boiler": (1, 50), "w:inner": (1, 1)}
    out = {}
    for c in {*prior, "t:other", *("t:" + t for t in TAG_CLASSES)}:
        a, b = prior.get(c, (1, 2))
        odds = max(-6.0, min(6.0, math.log((seen.get((c, True), 0) + a) / (seen.get((c, False), 0) + b))))
        positive = c == "w:content" or (c == "w:plain" and not marked)
        out[c] = 0.0 if c == "w:inner" else max(odds, 0.2) if positive else min(odds, -0.05)
    return out


def best_run(scores: list[float]) -> tuple[int, int]:
    """[start, end) of the contiguous run with the greatest positive sum, in one
    pass; the first of equals, (0, 0) if no sum is positive."""
    best, run, start, found = 0.0, 0.0, 0, (0, 0)
    for i, s in enumerate(scores):
        if run <= 0:
            run, start = 0.0, i
        run += s
        if run > best:
            best, found = run, (start, i + 1)
    return found


def extract(page: str | None, weights: dict[bool, dict[str, float]]) -> str:
    """Main text of one page: blocks joined by a line feed, white space inside a
    block turned into single spaces, character references decoded."""
    seq = tokens(page)
    marked = any(c == "content" for k, c, _ in seq if k == "w")
    w = weights[marked]
    start, end = best_run([w[c] * n for c, n in _classes(seq, marked)])
    blocks, parts = [], []
    for k, c, t in seq[start:end]:
        if k == "w":
            if c in ("content", "plain") and not (marked and c == "plain"):
                parts.append(html.unescape(t))
        elif k in SPACED:
            parts.append(" ")
        elif k not in INLINE and k != "note":
            blocks.append(parts)
            parts = []
    joined = (" ".join("".join(p).split()) for p in [*blocks, parts])
    return "\n".join(b for b in joined if b)


def main_text(page: Column, weights: dict[bool, dict[str, float]]) -> Column:
    """Main text of an html column; null and empty pages give ''."""
    @F.pandas_udf("string")
    def run(pages: pd.Series) -> pd.Series:
        return pd.Series([extract(p, weights) for p in pages], dtype=object)

    return run(page)


def report(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """One row per page: key, url, text, n_chars. One narrow pass after the weights
    are learnt; repeated rows keep a row each, other columns are ignored."""
    weights = learn(pages, key, page)
    return (pages.select(F.col(key), F.col(url), main_text(F.col(page).cast("string"), weights).alias("text"))
            .withColumn("n_chars", F.length("text").cast("long")))
