"""Hard negatives against a search over all rows."""

from __future__ import annotations

import math
import random

import pytest
from llm_tables import CLASHES
from pyspark.sql import functions as F

from daybook.llm import hard_negatives as module
from daybook.llm.hard_negatives import hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int"


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def score(a, b):
    return sum(math.floor(256 * x) * math.floor(256 * y) for x, y in zip(a, b, strict=False))


def searched(rows, every, positives=5, negatives=5, low=80, high=100):
    def first(key):
        return -key[0], key[1] is None, key[1] or 0

    rows = [
        r for r in rows if r[1] is not None and r[2] is not None and all(x is not None and math.isfinite(x) for x in r[1])
    ]
    out = []
    for anchor, vector, label in rows:
        if anchor is None or anchor % every:
            continue
        others = [(score(vector, v), i, other) for i, v, other in rows]
        own = sorted([(s, i) for s, i, o in others if o == label and i != anchor], key=first)[:positives]
        for p, i in own:
            window = [(s, j) for s, j, o in others if o != label and low * p <= high * s <= high * p]
            for rank, (s, j) in enumerate(sorted(window, key=first)[:negatives], 1):
                out.append((anchor, i, rank, j, p, s))
    return sorted(out, key=str)


def check(spark, rows, every=10, **how):
    limits = {k: v for k, v in how.items() if k in ("positives", "negatives")}
    got = hard_negatives(table(spark, rows), f"vec_id % {every} = 0", **limits).collect()
    want = searched(rows, every, **limits)
    assert sorted([tuple(r) for r in got], key=str) == want
    return want


def vectors(count, seed=1, labels=4, width=8):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(width)] for _ in range(3)]
    return [
        (k, [rng.choice(centres)[c] * 0.4 + rng.gauss(0, 0.3) for c in range(width)], rng.randrange(labels))
        for k in range(count)
    ]


@pytest.fixture(scope="module")
def floats(spark):
    """Random rows as the table holds them, rounded to 32 bits."""
    return [(r.vec_id, list(r.embedding), r.label) for r in table(spark, vectors(300)).collect()]


def test_equals_a_search_over_all_rows(spark, floats):
    assert len(check(spark, floats)) > 300


def test_small_slices_and_chunks(spark, floats, monkeypatch):
    monkeypatch.setattr(module, "BLOCK_BYTES", 512)
    monkeypatch.setattr(module, "SLICE_BLOCKS", 2)
    monkeypatch.setattr(module, "TILE", 64)
    check(spark, floats, every=3, positives=3, negatives=7)


def test_odd_rows(spark):
    rows = [
        (0, [1.0, 0.5], 1), (0, [1.0, 0.25], 1), (10, [0.0, 0.0], 2), (20, [], 3), (30, [1.0], 1),
        (1, [1.0, 0.5], 1), (2, [1.0, 0.5], 1), (2, [1.0, 0.5], 1), (None, [1.0, 0.5], 1),
        (3, [1.0, 0.5], 2), (4, [1.0, 0.5], 2), (4, [1.0, 0.5], 2), (None, [1.0, 0.5], 2), (5, [0.875, 0.5], 3),
        (6, None, 1), (7, [1.0, None], 1), (8, [float("nan"), 1.0], 2), (9, [float("inf"), 1.0], 2),
        (11, [1.0, 0.5], None), (40, None, 1), (50, [float("-inf")], 1), (60, [1.0, 0.5], None),
        (12, [1.0, 0.5, 7.0, 7.0], 2), (13, [-1.0, -0.5], 2), (70, [-1.0, -0.5], 1), (-10, [0.5, 0.5], 4),
        (None, None, None), (14, [-0.001, 0.0], 4), (15, [], 4), (16, [0.0], 2),
    ]
    assert check(spark, rows, positives=9, negatives=9)
    check(spark, rows, positives=1, negatives=1)


def test_a_common_vector_and_label(spark):
    rows = [(k, [0.5, 0.5, 0.5], 1 if k % 3 else 2) for k in range(200)]
    assert len(check(spark, rows, every=50)) == 4 * 25


def test_large_components_stay_exact(spark):
    rows = [(k, [2.0**12 + k, 2.0**11 - k], k % 2) for k in range(40)]
    assert check(spark, rows)
    with pytest.raises(Exception, match="55 bits"):
        hard_negatives(table(spark, [(0, [2.0**30], 1), (1, [2.0**30], 1)]), "vec_id = 0").collect()


def test_clashing_columns_and_empty_tables(spark, floats):
    rows = floats[:60]
    names = {n: F.lit(f"own {n}") for n in (*CLASHES, "id", "vector", "anchor", "is_anchor", "slot", "chunk", "slice")}
    wide = table(spark, rows).withColumns(names)
    got = hard_negatives(wide, "vec_id % 10 = 0").collect()
    assert sorted([tuple(r) for r in got], key=str) == searched(rows, 10)
    for none in (table(spark, []), table(spark, [(1, [1.0], 1)]), table(spark, [(0, [1.0], 1)])):
        assert hard_negatives(none, "vec_id % 10 = 0").collect() == []
