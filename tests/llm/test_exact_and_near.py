from __future__ import annotations

import hashlib
import re

import pytest
import xxhash
from edge_cases import COLUMNS, odd_documents, odd_rows, words
from hypothesis import given, settings
from hypothesis import strategies as st

from delaylake.llm.components import connected_components
from delaylake.llm.exact_dedup import exact_duplicates, grace_groups, without_duplicates
from delaylake.llm.simhash import fingerprint, near_duplicates, near_links, without_near_duplicates

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_fingerprint(text):
    w = WORD.findall((text or "").translate(LOWER))
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


@given(st.text(alphabet="aB Ć\t\n\x0b é1", max_size=60))
@settings(max_examples=150, deadline=None)
def test_fingerprint_is_the_plain_one(text):
    assert fingerprint(text.encode()) == plain_fingerprint(text)


def test_grace_recursion_spills_and_keeps_every_record():
    records = [(words(i % 37, 50).encode(), i, 1) for i in range(500)] + [(b"", None, 1)]
    got = {t: (d, n) for t, d, n in grace_groups(iter(records), table_bytes=900)}
    assert len(got) == 38 and sum(n for _, n in got.values()) == 501
    assert got[words(0, 50).encode()][0] == max(i for i in range(500) if i % 37 == 0)
    assert got[b""] == (None, 1)


def test_exact_duplicates_on_odd_rows(spark):
    rows = odd_rows()
    got = exact_duplicates(odd_documents(spark)).collect()
    assert len(got) == len(rows)
    groups: dict[str, list] = {}
    for d, t, *_ in rows:
        groups.setdefault(t or "", []).append(d)
    for text, ids in groups.items():
        sha = hashlib.sha256(text.encode()).hexdigest()
        mine = [r for r in got if r.text_sha256 == sha]
        keep = max((i for i in ids if i is not None), default=None)
        assert len(mine) == len(ids)
        assert {(r.keep_id, r.group_size) for r in mine} == {(keep, len(ids))}
        assert sum(r.kept for r in mine) == 1
        assert next(r.doc_id for r in mine if r.kept) == keep


def test_stages_keep_columns_and_one_row_per_group(spark):
    docs = odd_documents(spark)
    once = without_duplicates(docs)
    assert once.columns == docs.columns
    texts = [r.text or "" for r in once.collect()]
    assert sorted(texts) == sorted({t or "" for _, t, *_ in odd_rows()})
    near = without_near_duplicates(docs)
    assert near.columns == docs.columns
    left = near.collect()
    assert len({plain_fingerprint(r.text) for r in left}) == len(left)


def components_of(ids_and_fps):
    parent = list(range(len(ids_and_fps)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (_, a) in enumerate(ids_and_fps):
        for j in range(i):
            if bin(a ^ ids_and_fps[j][1]).count("1") <= 2:
                parent[root(i)] = root(j)
    return [root(i) for i in range(len(ids_and_fps))]


def test_near_duplicates_on_odd_rows(spark):
    rows = odd_rows()
    got = near_duplicates(odd_documents(spark)).collect()
    assert len(got) == len(rows)
    fps = [(d, plain_fingerprint(t)) for d, t, *_ in rows]
    roots = components_of(fps)
    least = {}
    for (d, _), r in zip(fps, roots):
        least[r] = min((x for x in (least.get(r), d) if x is not None), default=None)
    expected = sorted((str(d), format(f, "016x"), str(least[r])) for (d, f), r in zip(fps, roots))
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == expected


def test_links_of_near_random_fingerprints(spark):
    import random

    rng = random.Random(4)
    fps = [rng.getrandbits(64) for _ in range(60)]
    fps += [f ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for f in fps for _ in range(3)]
    fps += [f ^ 7 for f in fps[:20]]
    fps += [(1 << i) for i in range(64)] + [0, (1 << 64) - 1]
    fps = sorted({f - (1 << 64) if f >= 1 << 63 else f for f in fps})
    edges = near_links(spark.createDataFrame([(f,) for f in fps], "fp bigint"))
    named = {r.node: r.component for r in connected_components(edges).collect()}
    roots = components_of([(f, f % (1 << 64)) for f in fps])
    groups: dict[int, set] = {}
    for f, r in zip(fps, roots):
        groups.setdefault(r, set()).add(f)
    for members in groups.values():
        assert {named.get(f, f) for f in members} == {min(members)}


@pytest.mark.parametrize("n", [1, 2, 50])
def test_components_of_paths(spark, n):
    edges = [(i, i + 1) for i in range(n)] + [(1000, 1001), (1001, 1000), (7000, 7000)]
    got = connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert {r.node: r.component for r in got} == {i: 0 for i in range(n + 1)} | {1000: 1000, 1001: 1000}


def test_empty_tables(spark):
    docs = spark.createDataFrame([], COLUMNS)
    assert exact_duplicates(docs).collect() == [] and near_duplicates(docs).collect() == []
    assert without_duplicates(docs).collect() == [] and without_near_duplicates(docs).collect() == []
