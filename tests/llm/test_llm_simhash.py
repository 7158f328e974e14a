"""SimHash near-dedup against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash
from llm_tables import documents, odd_rows, prose
from pyspark.sql import functions as F

from daybook.llm import simhash
from daybook.llm.components import connected
from daybook.llm.simhash import near_duplicates, segments


def fingerprint(text, width=4):
    lowered = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
    words = lowered.split()
    if not words:
        return 0
    shingles = [b" ".join(words[k : k + width]) for k in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(ids, prints, most=4):
    parent = {d: d for d in ids if d is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    known = [(d, p) for d, p in zip(ids, prints, strict=True) if d is not None]
    for i, (a, p) in enumerate(known):
        for b, q in known[:i]:
            if (p ^ q).bit_count() <= most:
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    by_print = {p: root(d) for d, p in known}
    return [by_print.get(p) for p in prints]


def check(spark, rows, clashes=False):
    prints = [fingerprint(r[1]) for r in rows]
    want = components([r[0] for r in rows], prints)
    want = sorted(zip([r[0] for r in rows], [f"{p:016x}" for p in prints], want, strict=True), key=str)
    got = near_duplicates(documents(spark, rows, clashes)).collect()
    assert sorted([tuple(r) for r in got], key=str) == want
    return got


def variants(text, count, seed):
    rng = random.Random(seed)
    for _ in range(count):
        words = text.split()
        words[rng.randrange(len(words))] = f"new{rng.randrange(1000)}"
        yield " ".join(words)


@pytest.fixture(scope="module")
def near_rows():
    rows = [(k, prose(k, 30)) for k in range(40)]
    for base in range(5):
        rows += [(100 + 20 * base + k, t) for k, t in enumerate(variants(prose(base, 300), 15, base))]
        rows.append((90 + base, prose(base, 300).upper()))
    return rows


def test_near_copies_equal_brute_force(spark, near_rows):
    got = check(spark, near_rows)
    assert len({r.component_id for r in got}) < len(near_rows)


def test_crowded_groups_are_cut_without_losing_links(spark, near_rows, monkeypatch):
    monkeypatch.setattr(simhash, "GROUP_LIMIT", 3)
    monkeypatch.setattr(simhash, "SMALL_GROUP", 2)
    check(spark, near_rows)


def test_odd_rows(spark):
    check(spark, odd_rows(), clashes=True)


def test_an_id_with_several_texts_links_them(spark):
    texts = [prose(k, 60) for k in range(6)]
    rows = [(1, texts[0]), (5, texts[0]), (5, texts[1]), (9, texts[1])]
    assert {r.component_id for r in check(spark, rows)} == {1}
    more = [(30, texts[2]), (30, texts[3]), (30, texts[4]), (31, texts[4]), (29, texts[3]), (None, texts[3]), (40, texts[5])]
    assert len({r.component_id for r in check(spark, rows + more)}) == 3


def test_empty_table(spark):
    assert near_duplicates(documents(spark, [])).collect() == []


@pytest.mark.parametrize("most", [0, 1, 3, 4, 7])
def test_some_variant_is_shared_up_to_the_limit(most):
    rng = random.Random(most)
    parts = segments(most)
    assert sum(size for _, size in parts) == 64
    for _ in range(200):
        bits = rng.sample(range(64), most)
        apart = sum(1 << b for b in bits)
        assert min((apart >> first & (1 << size) - 1).bit_count() for first, size in parts) <= 1


def test_forest_connects_what_is_linked():
    prints = np.array([1 << k for k in range(40)] + [0, (1 << 63) - 1], np.uint64)
    group = np.ones(len(prints), np.int64)
    edges = [(a, b) for x, y in simhash._forests(group, prints, 1) for a, b in zip(x, y, strict=True)]
    assert len(edges) == 40 and {x for e in edges for x in e} == set(range(41))


def test_long_chain_is_one_component(spark):
    edges = spark.range(60).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    more = spark.createDataFrame([(200, 201), (200, 200), (None, 5), (201, 200)], "a long, b long")
    got = {r.node: r.component for r in connected(edges.union(more)).collect()}
    assert got == {**{k: 0 for k in range(61)}, 200: 200, 201: 200}
