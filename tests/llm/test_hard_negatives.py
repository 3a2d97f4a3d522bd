"""Hard negatives against a plain version, on odd rows, ties and skewed labels."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from delaylake.llm import hard_negatives as module
from delaylake.llm.hard_negatives import hard_negatives, pack_keys, scaled_vectors, unpack_keys

SCHEMA = "vec_id bigint, label int, vector array<bigint>, score string, tile int, row string"


def plain(rows, is_anchor, positives=5, negatives=3, low=50, high=95):
    """The contract, written down row by row."""
    by_id = {}
    for i, label, vector in rows:
        if i is not None and label is not None and vector is not None and None not in vector:
            by_id[i] = min(by_id.get(i, (label, vector)), (label, vector))
    out = set()
    for a, (label, vector) in by_id.items():
        if not is_anchor(a):
            continue
        scored = sorted(
            (-sum(x * y for x, y in zip(vector, v)), i, same == label)
            for i, (same, v) in by_id.items()
            if i != a and len(v) == len(vector)
        )
        scored = [(min(max(-s, -(2**63)), 2**63 - 1), i, same) for s, i, same in scored]
        for best, p, _ in [x for x in scored if x[2]][:positives]:
            found = [(s, i) for s, i, same in scored if not same and low * best <= 100 * s <= high * best]
            out |= {(a, p, r, i, best, s) for r, (s, i) in enumerate(found[:negatives], 1)}
    return out


def run(spark, rows, **options):
    df = spark.createDataFrame([(*r, "s", 1, "r") for r in rows], SCHEMA)
    found = hard_negatives(df, F.col("vec_id") % 4 == 0, **options).collect()
    assert len(found) == len(set(map(tuple, found)))
    return set(map(tuple, found))


def generated(seed, n, dimension=6, spread=40, labels=4):
    rng = random.Random(seed)
    return [
        (i, 0 if rng.random() < 0.4 else rng.randrange(labels), [rng.randint(-spread // 8, spread) for _ in range(dimension)])
        for i in range(n)
    ]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_the_plain_version(spark, seed):
    rows = generated(seed, 300)
    assert run(spark, rows) == plain(rows, lambda i: i % 4 == 0)


def test_ties_take_the_smaller_id(spark):
    rng = random.Random(3)
    # Few distinct vectors, one of them with half of the rows; zero vectors give windows of the single score 0.
    stock = [[3, 1], [2, 2], [0, 0], [4, 1], [-1, -1]]
    rows = [(i, rng.randrange(3), stock[0] if rng.random() < 0.5 else rng.choice(stock)) for i in range(240)]
    found = run(spark, rows)
    assert found == plain(rows, lambda i: i % 4 == 0)
    assert any(score == 0 for *_, score, _ in found)


def test_small_tiles_give_the_same(spark, monkeypatch):
    rows = generated(5, 200)
    monkeypatch.setattr(module, "CHUNK_BYTES", 500)
    monkeypatch.setattr(module, "TILE_PAIRS", 300)
    assert run(spark, rows) == plain(rows, lambda i: i % 4 == 0)


def test_odd_rows(spark):
    rows = generated(7, 60) + [
        (None, 1, [1] * 6),
        (61, None, [1] * 6),
        (64, 1, None),
        (68, 1, [1, None, 1, 1, 1, 1]),
        (72, 1, []),
        (73, 2, []),
        (76, 1, [5, 5]),
        (77, 2, [4, 5]),
        (79, 1, [5, 6]),
        (4, 3, [9] * 6),  # an id again
        (4, 3, [9] * 6),
        (-8, 0, [2**40, 2**40, 1, 1, 1, 1]),  # beyond what doubles hold exactly
        (-9, 0, [2**40, 2**22, 1, 1, 1, 1]),
        (-7, 1, [2**39, 2**22 + 1, 1, 1, 1, 1]),
        (-5, 2, [2**39, 2**22, 1, 1, 1, 1]),
    ]
    assert run(spark, rows) == plain(rows, lambda i: i % 4 == 0)


def test_other_numbers_of_each(spark):
    rows = generated(9, 120)
    found = run(spark, rows, positives=2, negatives=4, low=20, high=80)
    assert found == plain(rows, lambda i: i % 4 == 0, 2, 4, 20, 80)


def test_empty_and_anchorless_tables(spark):
    assert run(spark, []) == set()
    assert run(spark, [(1, 1, [1]), (2, 1, [1]), (3, 2, [1])]) == set()
    assert run(spark, [(4, 1, [1])]) == set()  # no positive


def test_components_become_whole_steps(spark):
    rows = [(1, 1, [0.5, -0.001]), (2, 1, [float("nan"), 1.0]), (3, 1, [float("-inf"), 1.0]), (4, 1, None), (5, 1, [None, 1.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<float>")
    assert [tuple(r) for r in scaled_vectors(df).collect()] == [(1, 1, [128, -1])]


def test_keys_sort_as_their_numbers():
    import numpy as np

    rng = random.Random(11)
    edge = [-(2**63), -1, 0, 1, 2**63 - 1]
    numbers = [(rng.choice(edge), rng.choice(edge), kind, rng.choice(edge)) for _ in range(200) for kind in (0, 1)]
    packed = []
    for a, s, k, i in numbers:
        packed += pack_keys(np.array([a]), np.array([s]), k, np.array([i])).to_pylist()
    import pyarrow as pa

    assert list(unpack_keys(pa.array(packed, pa.binary()))) == numbers
    by_bytes = [n for _, n in sorted(zip(packed, numbers))]
    assert by_bytes == sorted(numbers, key=lambda n: (n[0], -n[1], n[2], n[3]))
