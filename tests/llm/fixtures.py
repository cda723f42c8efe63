"""Small tables with the cases every operator must stand: nulls in any column, empty
and very long texts, ties and repeated rows, and extra columns whose names clash
with the operators' own."""
from __future__ import annotations

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "size long, shard int, score double, k long, h long, t long, d long, v long, _hash long, hash long, taken long, label string")


def words(n: int, seed: int) -> list[str]:
    r = random.Random(seed)
    return ["".join(r.choice("abcdefghiklmnoprstuvwxyzäé") for _ in range(r.randint(2, 9))) for _ in range(n)]


def texts() -> list[str | None]:
    base = words(120, 1)
    near = [*base[:60], "changed", *base[61:]]
    passage = words(60, 2)
    return [
        None, "", "   \n\t ", "one", "one two", "ONE Two", "one  two three　four",
        " ".join(base), " ".join(base), "\n".join(base), " ".join(near), " ".join(w.upper() for w in base),
        " ".join([*words(80, 3), *passage, *words(50, 4)]), " ".join([*passage, *words(90, 5)]),
        "the same line again and again\n" * 40, " ".join(words(20_000, 6)), " ".join(words(20, 7)), " ".join(words(19, 8)),
        "x" * 30_000, "\U0001F600 emoji <|endoftext|> text", "a\x0bb\x0cc\rd", "zero\x00byte",
    ]


def rows() -> list[tuple]:
    all_texts = texts()
    out = [(i, t, "en" if i % 3 else None, None if i % 7 == 3 else f"src{i % 4}", None if t is None else len(t)) for i, t in enumerate(all_texts)]
    out += [(7, all_texts[7], "en", "src3", 5)] * 2                     # repeated rows
    out += [(None, all_texts[12], None, None, None), (None, None, None, None, None), (3, "another text under key three", "en", "src1", 1)]
    return [(*r, 5, 3, 0.5, 1, 2, 3, 4, 5, 6, 7, 8, "x") for r in out]


def documents(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


def none(spark):
    return spark.createDataFrame([], SCHEMA)
