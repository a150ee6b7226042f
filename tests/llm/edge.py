"""Frames with the cases every operator has to take."""
from __future__ import annotations

import random

# operators' own working names, as extra columns of other types
CLASH = "n double, component boolean, rank string, tokens string, length string, share string, host binary"
EXTRA = (1.5, True, "r", "t", "l", "s", b"h")

DOCS = "doc_id long, text string, lang string, source string, n_chars long, " + CLASH


def words(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice("aeioulnrst") for _ in range(r.randint(2, 7))) for _ in range(n))


def documents(spark):
    base = words(1, 300)
    rows = [
        (1, base, "en", "a"), (2, base, "en", "a"), (3, base.upper(), "en", "b"),
        (4, base + " tail", "en", "b"), (5, words(2, 300), "de", "a"),
        (6, None, "en", "a"), (7, "", "en", None), (8, " \n\t ", None, "c"),
        (9, "one", "fr", "c"), (10, words(3, 60000), "en", "a"), (11, "x" * 50000, "en", "a"),
        (12, words(4, 200), None, None), (12, words(4, 200), None, None), (13, words(5, 40), "en", "a"),
        (13, words(6, 40), "en", "b"), (None, words(7, 80), "en", "a"), (None, None, None, None),
        (14, "<|endoftext|> ünïcödé  日本語\n\n end<|startoftext|>", "en", "a"),
        (15, "one", "fr", "c"), (16, "a\0b", "en", "a"),
    ]
    rows += [(100 + i, words(100 + i, 30 + i), "en", "abc"[i % 3]) for i in range(30)]
    return spark.createDataFrame([(i, t, g, s, len(t) if t else None, *EXTRA) for i, t, g, s in rows], DOCS)


def nothing(spark, schema: str):
    return spark.createDataFrame([], schema)
