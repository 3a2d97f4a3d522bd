from __future__ import annotations

import random
import re
import time

import numpy as np
from edge_cases import COLUMNS, odd_documents, odd_rows, words

import corpus_pipeline
from delaylake.llm import near_copies as module
from delaylake.llm.near_copies import without_near_copies

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def shingles(text):
    w = WORD.findall((text or "").encode().lower())
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or {tuple(w)}


def survivors(rows):
    """Least doc_id of every component, all pairs compared."""
    sets = [shingles(t) for _, t, *_ in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if 5 * len(a & sets[j]) >= 4 * len(a | sets[j]):
                parent[root(i)] = root(j)
    groups: dict = {}
    for i, (d, *_) in enumerate(rows):
        groups.setdefault(root(i), []).append(d)
    return sorted(str(min((d for d in g if d is not None), default=None)) for g in groups.values())


def planted():
    """Texts with copies of one to nine changed words, chains of copies, and one passage in many texts."""
    rng = random.Random(11)
    passage = words(999, 40)
    rows = []
    for i in range(40):
        text = words(i, 60 + 5 * i, 3000).split()
        if i % 2:
            text += passage.split()
        rows.append(" ".join(text))
        for changed in (1, 2, 3, 5, 9):
            text = list(text) if changed % 2 else rows[-1].split()
            for at in rng.sample(range(len(text)), changed):
                text[at] = f"new{rng.randrange(10**6)}"
            rows.append(" ".join(text).upper() if changed == 2 else " ".join(text))
    rng.shuffle(rows)
    return [(i, t, "en", "a") for i, t in enumerate(rows)]


def test_stage_is_brute_force(spark, monkeypatch):
    rows = planted()
    expected = survivors(rows)
    assert 40 < len(expected) < len(rows) - 40
    docs = odd_documents(spark, rows)
    left = corpus_pipeline.near_dedup(spark, docs, "")
    assert left.columns == docs.columns
    assert sorted(str(r.doc_id) for r in left.collect()) == expected
    monkeypatch.setattr(module, "SAMPLED", 1)  # common shingles last
    assert sorted(str(r.doc_id) for r in without_near_copies(docs).collect()) == expected


def test_one_leader_that_fits_none_loses_no_link(spark, monkeypatch):
    monkeypatch.setattr(module, "LEADERS", 1)
    base = words(5, 100, 3000).split()
    rng = random.Random(3)
    rows = []
    for i in range(60):
        text = list(base)
        for at in rng.sample(range(100), 2 + i % 2):
            text[at] = f"n{rng.randrange(10**6)}"
        rows.append((i, " ".join(text), "en", "a"))
    assert sorted(str(r.doc_id) for r in without_near_copies(odd_documents(spark, rows)).collect()) == survivors(rows)


def test_odd_rows_and_no_rows(spark):
    left = without_near_copies(odd_documents(spark)).collect()
    assert sorted(str(r.doc_id) for r in left) == survivors(odd_rows())
    assert without_near_copies(spark.createDataFrame([], COLUMNS)).collect() == []


def test_a_passage_that_most_of_a_text_is_makes_no_pairs_of_all_its_carriers(spark, monkeypatch):
    """Texts of 13 own words and one passage of 84: similar to 0.75 only, and so many that all pairs would show."""
    monkeypatch.setattr(module, "SAMPLED", 1)
    passage = words(77, 84, 5000)
    counted = []
    original = module._rest_pairs

    def counting(open_):
        pairs = original(open_)
        counted.append((open_.count(), pairs.count()))
        return pairs

    monkeypatch.setattr(module, "_rest_pairs", counting)
    rows = [(i, f"{words(5000 + i, 13, 10**6)} {passage}", "en", "a") for i in range(400)]
    rows += [(1000 + i, f"{words(5000 + i, 12, 10**6)} extra {passage}", "en", "a") for i in range(0, 400, 40)]  # copies of some
    left = sorted(str(r.doc_id) for r in without_near_copies(odd_documents(spark, rows)).collect())
    assert left == sorted(str(i) for i in range(400))
    assert all(pairs <= 400 for _, pairs in counted)


def test_scratch_copies_go_and_the_result_stays(spark):
    from delaylake import session

    before = len(session._made)
    found = module.near_copies(odd_documents(spark, planted()[:60]))
    names = {p.rsplit("/", 1)[-1].rsplit("-", 1)[0] for p in session._made[before:]}
    assert names == {"near_rows", "near_components"}
    assert found.count() == 60


def test_variants_that_have_grown_apart_make_no_pairs_of_all(spark, monkeypatch):
    """Each differs from one text in a tenth of its words, so any two are similar to two thirds only."""
    counted = []
    original = module._rest_pairs

    def counting(open_):
        pairs = original(open_)
        counted.append(pairs.count())
        return pairs

    monkeypatch.setattr(module, "_rest_pairs", counting)
    base, rng = words(31, 300, 5000).split(), random.Random(8)
    rows = []
    for i in range(200):
        text = list(base)
        for at in rng.sample(range(300), 12):
            text[at] = f"own{i}x{at}"
        rows.append((i, " ".join(text), "en", "a"))
    rows += [(500 + i, f"{rows[i][1]} and one word more", "en", "a") for i in range(0, 200, 20)]
    assert sorted(str(r.doc_id) for r in without_near_copies(odd_documents(spark, rows)).collect()) == survivors(rows)
    assert all(pairs < 1000 for pairs in counted)


def test_only_what_has_a_partner_gets_a_set(spark, monkeypatch):
    """Short texts with one passage, long ones alike to three fifths: places and bitmaps refuse all but the copies, whose bitmaps fold."""
    wanted = []
    original = module.sets_of

    def counting(nodes, docs):
        wanted.append(nodes.count())
        return original(nodes, docs)

    monkeypatch.setattr(module, "sets_of", counting)
    passage, base, rng = words(41, 40, 5000), words(42, 3000, 10**6).split(), random.Random(5)
    rows = [(i, f"{words(2000 + i, 60, 10**6)} {passage}", "en", "a") for i in range(60)]
    for i in range(20):
        text = list(base)
        for at in rng.sample(range(3000), 150):
            text[at] = f"own{i}x{at}"
        rows.append((100 + i, " ".join(text), "en", "a"))
    rows += [(200 + i, f"{rows[i][1]} and one word more", "en", "a") for i in (7, 70)]
    rows += [(300, words(43, 1000, 10**6), "en", "a"), (301, f"{words(43, 1000, 10**6)} {words(44, 100, 10**6)}", "en", "a")]
    left = sorted(str(r.doc_id) for r in without_near_copies(odd_documents(spark, rows)).collect())
    assert left == survivors(rows)
    assert "301" not in left and len(left) == len(rows) - 3
    assert 6 <= sum(wanted) <= 12


def test_prefix_time_does_not_grow_with_the_list_of_common_shingles():
    """A set of a few shingles does not pay for 50,000 common ones; those of the list stand last, in order of their hashes."""
    rng = np.random.default_rng(5)
    common = np.unique(rng.integers(-(2**62), 2**62, module.MOST_COMMON))
    sets = [np.unique(np.concatenate([rng.integers(-(2**62), 2**62, 90), rng.choice(common, 10)])) for _ in range(300)]
    began = time.process_time()
    found = [module._prefix(s, common).tolist() for s in sets]
    assert time.process_time() - began < 0.5
    known = set(common.tolist())
    for s, prefix in zip(sets, found):
        order = sorted(s.tolist(), key=lambda x: (x in known, x))
        assert prefix == order[: len(s) - module.least_shared(len(s)) + 1]
    empty = np.zeros(0, np.int64)
    assert module._prefix(empty, common).tolist() == [] and module._prefix(sets[0], empty).tolist() == sets[0][: len(found[0])].tolist()
