"""Documents with every oddity an operator must stand: nulls, empty and long texts, repeats, clashing columns."""

from __future__ import annotations

import random

COLUMNS = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, size bigint, kept boolean, key string,"
    " __key string, ranges string, component string"
)


def words(seed: int, n: int, stock: int = 400) -> str:
    rng = random.Random(seed)
    return " ".join(f"{rng.choice('abcdefgh')}{rng.randrange(stock)}" for _ in range(n))


def odd_rows() -> list[tuple]:
    shared = words(1, 60)
    long = words(2, 30_000, 100_000)
    rows = [
        (1, words(3, 80) + " " + shared + " " + words(4, 80), "en", "a"),
        (2, words(5, 70) + " " + shared, "en", "a"),
        (3, "", "fr", "b"),
        (4, None, "fr", None),
        (5, " \t\n ", None, "b"),
        (6, long, "en", "a"),
        (7, long + " " + words(6, 300), "de", "b"),
        (8, "x " * 3000, "en", "a"),
        (9, "y" * 50_000, "en", "c"),
        (10, "Ünïcödé 日本語 <|endoftext|> 🙂\u2028 \x1c " + shared, "es", "ß"),
        (11, "!!! ### $$$", "en", "a"),
        (12, "one", None, None),
        (None, words(5, 70) + " " + shared, "en", "a"),
        (None, None, None, None),
    ]
    rows += [(20, words(9, 120), "en", "a")] * 3  # the same row again
    rows += [(20 + i, words(9, 120), "en", "a") for i in range(1, 5)]  # copies under other ids
    rows += [(30, words(10, 100), "fr", "b"), (30, words(11, 100), "fr", "b")]  # one id, two texts
    return rows


def odd_documents(spark, rows=None):
    rows = odd_rows() if rows is None else rows
    data = [
        (d, t, lang, s, None if t is None else len(t), 5, True, "k", "k", "r", "c") for d, t, lang, s in rows
    ]
    return spark.createDataFrame(data, COLUMNS)
