"""The manifest against a plain Python version."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from delaylake.llm.manifest import document_leaves, folded, manifest, proof_text

from edge_cases import odd_documents, odd_rows


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row) -> str:
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def plain_tree(leaves: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    """Root, and per leaf the siblings before and after it on every level."""
    paths, at, nodes = [[] for _ in leaves], list(range(len(leaves))), leaves
    while len(nodes) > 1:
        for i, path in enumerate(paths):
            first = at[i] // 3 * 3
            path.append(("".join(nodes[first : at[i]]), "".join(nodes[at[i] + 1 : first + 3])))
            at[i] //= 3
        nodes = [digest(*nodes[i : i + 3]) for i in range(0, len(nodes), 3)]
    return nodes[0], paths


def plain(rows) -> set[tuple]:
    """``doc_id, leaf, subroot, root, proof, folded`` of rows ``(doc_id, source, lang, n_chars, text)``."""
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source in sources:
        mine = [(r[0] is not None, r[0] or 0, leaf(r), r) for r in rows if r[1] == source]
        mine.sort(key=lambda x: x[:3])
        trees[source] = (mine, *plain_tree([m[2] for m in mine]))
    root, upper = plain_tree([trees[s][1] for s in sources])
    out = []
    for source, above in zip(sources, upper):
        mine, subroot, paths = trees[source]
        for (_, _, own, row), path in zip(mine, paths):
            path = path + above
            doc_id, text = row[0], row[4]
            start = own
            if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0 and text is not None:
                start = leaf((*row[:4], text.replace("\n", "")))
            for before, after in path:
                start = digest(before, start, after)
            out.append((doc_id, own, subroot, root, digest(*[b + a for b, a in path]), start))
    return sorted(out, key=str)


def found(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars bigint, text string")
    docs = docs.withColumns({c: F.lit("x") for c in ("tree", "lo", "hi", "n", "digest", "children", "part", "place", "path")})
    done = manifest(document_leaves(docs))
    path = F.col("path")
    done = done.select("doc_id", "leaf", "subroot", "root", F.sha2(proof_text(path), 256), folded(F.col("changed"), path))
    return sorted(map(tuple, done.collect()), key=str)


def generated(seed: int, n: int, sources: int):
    rng = random.Random(seed)
    names = [None, "é", "z", "Z", "", *[f"s{i}" for i in range(sources)]]
    pick = lambda: names[-1] if rng.random() < 0.4 else rng.choice(names)
    texts = ["a\nb", "", None, "plain", "ü\n\n日本"]
    return [(i * 3 % 101 if i % 7 else None, pick(), rng.choice(["en", None]), rng.choice([None, 4]), rng.choice(texts)) for i in range(n)]


@pytest.mark.parametrize(("seed", "n", "sources"), [(1, 260, 8), (2, 40, 30)])
def test_equals_the_plain_version(spark, seed, n, sources):
    rows = generated(seed, n, sources)
    assert found(spark, rows) == plain(rows)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 28])
def test_runs_that_are_not_full(spark, n):
    rows = [(i, "one", "en", 1, f"t{i}\n") for i in range(n)]
    assert found(spark, rows) == plain(rows)


def test_repeated_rows_and_many_in_one_source(spark):
    rows = [(None, "hot", None, None, "same")] * 50 + [(5, "hot", "en", 1, "a\n")] * 30 + [(6, None, None, None, None)]
    assert found(spark, rows) == plain(rows)


def test_empty_table(spark):
    assert found(spark, []) == []


def test_odd_documents(spark):
    rows = [(d, s, lang, None if t is None else len(t), t) for d, t, lang, s in odd_rows()]
    docs = odd_documents(spark)
    done = manifest(document_leaves(docs)).select("doc_id", "leaf", "subroot", "root", F.sha2(proof_text(F.col("path")), 256), folded(F.col("changed"), F.col("path")))
    assert sorted(map(tuple, done.collect()), key=str) == plain(rows)


def test_missing_is_not_empty_and_lengths_keep_fields_apart(spark):
    pairs = [((1, "a", None, None, ""), (1, "a", None, None, None)), ((1, "ab", "c", None, "d"), (1, "a", "bc", None, "d"))]
    for a, b in pairs:
        assert leaf(a) != leaf(b)
        assert found(spark, [a])[0][1] != found(spark, [b])[0][1]
