from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from edge_cases import COLUMNS, odd_documents, odd_rows, words

from delaylake.llm import repeats
from delaylake.llm.phrase_dedup import LENGTH as WORDS
from delaylake.llm.phrase_dedup import phrases, recompressed, without_earlier_passages, word_names
from delaylake.llm.suffix_dedup import LENGTH, suffixes, without_repeats

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_suffixes(rows):
    texts = [(d, (t or "").encode()) for d, t, *_ in rows]
    seen = Counter(b[i : i + LENGTH] for _, b in texts for i in range(len(b) - LENGTH + 1))
    out = []
    for d, b in texts:
        gone = bytearray(len(b))
        for i in range(len(b) - LENGTH + 1):
            if seen[b[i : i + LENGTH]] > 1:
                gone[i : i + LENGTH] = b"\1" * LENGTH
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = len(re.findall(b"\1+", bytes(gone)))
        out.append((str(d), len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def plain_passages(rows):
    texts = [(d, WORD.findall(t or "")) for d, t, *_ in rows]
    first = {}
    for d, w in texts:
        for i in range(len(w) - WORDS + 1):
            if d is not None:
                k = tuple(w[i : i + WORDS])
                first[k] = min(d, first.get(k, d))
    out = []
    for d, w in texts:
        gone = [False] * len(w)
        for i in range(len(w) - WORDS + 1):
            if d is not None and first[tuple(w[i : i + WORDS])] < d:
                gone[i : i + WORDS] = [True] * WORDS
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((str(d), len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def suffix_rows(docs):
    return sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in without_repeats(docs).collect())


def passage_rows(docs):
    return sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in without_earlier_passages(docs).collect())


def overlapping_rows(seed):
    """Documents cut and joined from few passages, so that repeats start and end anywhere."""
    rng = random.Random(seed)
    stock = [words(100 + seed * 10 + i, 150, 30) for i in range(5)]
    rows = []
    for d in range(40):
        parts = []
        for _ in range(rng.randrange(1, 4)):
            w = rng.choice(stock).split()
            a = rng.randrange(len(w) - 60)
            parts.append(" ".join(w[a : a + rng.randrange(14, 60)]))
            parts.append(words(rng.randrange(10**6), rng.randrange(4), 30))
        rows.append((d // 2 if d > 30 else d, rng.choice([" ", "\n"]).join(parts), "en", "a"))
    return rows


@pytest.mark.parametrize("bucket", [250_000, 40])
def test_odd_rows(spark, monkeypatch, bucket):
    monkeypatch.setattr(repeats, "BUCKET_ENTRIES", bucket)
    if bucket == 40:
        monkeypatch.setattr(repeats, "FLUSH_ENTRIES", 300)
    rows = odd_rows()
    docs = odd_documents(spark)
    assert suffix_rows(docs) == plain_suffixes(rows)
    assert passage_rows(docs) == plain_passages(rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_overlapping_repeats_across_bucket_borders(spark, monkeypatch, seed):
    monkeypatch.setattr(repeats, "BUCKET_ENTRIES", 10)
    rows = overlapping_rows(seed)
    docs = odd_documents(spark, rows)
    assert suffix_rows(docs) == plain_suffixes(rows)
    assert passage_rows(docs) == plain_passages(rows)


def test_empty_table(spark):
    docs = spark.createDataFrame([], COLUMNS)
    assert without_repeats(docs).collect() == [] and without_earlier_passages(docs).collect() == []


def test_multikey_order():
    rng = np.random.default_rng(0)
    keys = [rng.integers(0, 3, 500) for _ in range(4)]
    order = repeats.multikey_order(*keys)
    assert [tuple(int(k[i]) for k in keys) for i in order] == sorted(zip(*[k.tolist() for k in keys]))


def test_every_window_has_one_entry_that_its_content_decides():
    text = words(5, 400, 12).encode()
    for generate, size, data in ((suffixes, LENGTH, text), (phrases, WORDS, text)):
        core, full, start, count = generate(data)
        n = len(data) if size == LENGTH else len(data.split())
        assert np.concatenate([np.arange(s, s + c) for s, c in zip(start, count)]).tolist() == list(range(n - size + 1))
        unit = data if size == LENGTH else data.split()
        names: dict = {}
        for c, s, k in zip(core, start, count):
            for i in range(s, s + k):
                piece = bytes(unit[i : i + size]) if size == LENGTH else tuple(unit[i : i + size])
                assert names.setdefault(piece, c) == c


def test_symbols_depend_on_the_words_they_name():
    names = word_names(words(6, 300, 15).encode())
    whole = {}
    for s, a, b in zip(*recompressed(names)):
        if 0 <= a and b <= len(names):
            whole.setdefault(tuple(names[a:b]), s)
            assert whole[tuple(names[a:b])] == s and b - a <= 8
