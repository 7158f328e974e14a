"""Periodic runs against a search of every period, and their trees against plain comparison."""

from __future__ import annotations

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_tables import documents, odd_rows, prose

from daybook.llm.periodic_runs import Extensions, periodic_runs, runs_of, stretches, suffix_tree
from daybook.llm.queries import op13_periodic_runs


def searched(words, least=24, repeats=3):
    """Maximal stretches of equal words at each distance, without those that a shorter period explains."""
    n, found = len(words), {}
    for q in range(1, n // repeats + 1):
        k = 0
        while k + q < n:
            if words[k] != words[k + q]:
                k += 1
                continue
            start = k
            while k + q < n and words[k] == words[k + q]:
                k += 1
            length = k - start + q
            if length >= max(least, repeats * q):
                found.setdefault((start, length), q)
    return sorted(((s, length, q) for (s, length), q in found.items()), key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    return [w for k, w in enumerate(words) if k not in gone]


def texts(seed):
    rng = random.Random(seed)
    for _ in range(30):
        words = []
        while len(words) < 200:
            root = [rng.choice("abc") for _ in range(rng.randrange(1, 12))]
            words += root * rng.randrange(1, 9) + root[: rng.randrange(len(root) + 1)]
            words += [rng.choice("abcxyz") for _ in range(rng.randrange(6))]
        yield words


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 2), min_size=1, max_size=60), st.integers(1, 8), st.integers(2, 4))
def test_runs_equal_a_search(words, least, repeats):
    assert sorted(runs_of(words, least, repeats), key=lambda r: (r[0], r[2])) == searched(words, least, repeats)


@pytest.mark.parametrize("seed", range(4))
def test_runs_in_their_stretches(seed):
    for words in texts(seed):
        want = searched(words)
        _, numbers = np.unique(words, return_inverse=True)
        hashes = numbers.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        got = []
        for a, b in stretches(hashes, np.array([0, len(words)]), 24, 3):
            got += [(a + s, n, q) for s, n, q in runs_of(numbers[a:b].tolist(), 24, 3)]
        assert sorted(got, key=lambda r: (r[0], r[2])) == want


def test_stretches_keep_texts_apart_and_far_repeats_out():
    rng = np.random.default_rng(1)
    free = rng.integers(0, 1 << 62, 300).astype(np.uint64)
    far = np.r_[free[:40], free[100:], free[:40]]
    assert stretches(far, np.array([0, len(far)]), 24, 3) == []
    periodic = np.tile(free[:5], 12)
    cut = np.array([0, 30, 60])
    assert stretches(periodic, cut, 24, 3) == [(0, 30), (30, 60)]
    assert stretches(periodic, np.array([0, 0, 60, 60]), 24, 3) == [(0, 60)]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=80))
def test_extensions_equal_plain_comparison(words):
    n = len(words)
    links, first, last = suffix_tree(words)
    assert sum(below is None for below in links) == n + 1
    tree = Extensions(words)
    assert [int(k) for k in np.argsort(tree.rank)] == sorted(range(n), key=lambda k: words[k:])
    pairs = [(a, b) for a in range(n + 1) for b in range(n + 1) if a != b]
    a, b = np.array(pairs).T
    for (x, y), got in zip(pairs, tree.of(a, b).tolist(), strict=True):
        want = next((k for k in range(n) if max(x, y) + k >= n or words[x + k] != words[y + k]), n)
        assert got == want


def rows_with_runs():
    line = " ".join(f"l{k}" for k in range(9))
    return [
        *[(100 + k, " ".join(words)) for k, words in enumerate(texts(9))],
        (200, " ".join(["same"] * 5000)),
        (201, "\n".join([line] * 40) + " end"),
        (202, f"{prose(1)} {' '.join([line] * 3)} {prose(2)} {' '.join([line] * 4)}"),
        (203, " ".join(["a b c d e f g h"] * 3)),
        (204, " ".join(["a b c d e f g h"] * 3)[:-2]),
        (205, f"{line} {prose(3)} {line} {prose(4)} {line}"),
        (206, f"{prose(5)} {prose(5)} {prose(5)}"),
        (207, f"{prose(5)} {prose(5)} {prose(5)}".rsplit(" ", 1)[0]),
        (208, "ab\x1fab " * 30),
    ]


def check(spark, rows, clashes=False, **how):
    got = periodic_runs(documents(spark, rows, clashes), **how).collect()
    want = []
    for row in rows:
        words = [w.decode() for w in (row[1] or "").encode().split()]
        runs = searched(words, how.get("least", 24), how.get("repeats", 3)) if len(words) < 6000 else []
        want.append((row[0], len(runs), runs, " ".join(collapsed(words, runs))))
    found = [(r.doc_id, r.n_runs, [tuple(x) for x in r.runs], r.kept) for r in got]
    assert sorted(found, key=str) == sorted(want, key=str)
    return found


def test_documents_equal_a_search(spark):
    found = check(spark, rows_with_runs(), clashes=True)
    assert sum(n > 0 for _, n, _, _ in found) > 20


def test_other_limits(spark):
    check(spark, rows_with_runs()[:12], least=10, repeats=2)
    with pytest.raises(ValueError):
        periodic_runs(documents(spark, []), repeats=1)


def test_odd_rows_and_empty_tables(spark):
    check(spark, odd_rows(), clashes=True)
    assert periodic_runs(documents(spark, [])).collect() == []


def test_query_equals_a_search(spark, sf):
    """Every document of the table, tails planted and digests made step by step."""
    got = {r.doc_id: r for r in op13_periodic_runs(spark, sf).collect()}
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(rows)
    planted = 0
    for doc_id, text in rows:
        words = (text or "").encode().split()
        h, n = zlib.crc32(str(doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = searched(words) if n < 700 or h % 10 == 0 and n < 3000 else None
        if runs is None:
            continue
        planted += bool(runs)
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
        digest = hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest()
        kept = hashlib.sha256(b" ".join(collapsed(words, runs))).hexdigest()
        r = got[doc_id]
        assert (r.n_runs, r.runs_sha256, r.collapsed_sha256) == (len(runs), digest, kept)
        want = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        assert (r.start, r.length, r.period, r.exponent_milli) == want
    assert planted > 8
