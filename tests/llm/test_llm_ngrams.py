"""The n-gram join against brute force over all pairs."""

from __future__ import annotations

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_tables import documents, odd_rows, prose

from daybook.llm import ngram_join, substring_dedup
from daybook.llm.ngram_join import Trie, ngram_components


def shingles(text, width=5):
    words = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()).split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[k : k + width]) for k in range(max(1, len(words) - width + 1)))


def components(rows, share=(80, 100)):
    """The least id that each row reaches over links between rows."""
    sets = [shingles(r[1]) for r in rows]
    root = list(range(len(rows)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and share[1] * len(a & b) >= share[0] * len(a | b):
                root[top(i)] = top(j)
    least = {}
    for k, r in enumerate(rows):
        if r[0] is not None:
            least[top(k)] = min(least.get(top(k), r[0]), r[0])
    return [(r[0], len(s), least.get(top(k))) for k, (r, s) in enumerate(zip(rows, sets, strict=True))]


def check(spark, rows, clashes=False, **how):
    got = ngram_components(documents(spark, rows, clashes), **how).collect()
    want = components(rows, how.get("share", (80, 100)))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    return want


def changed(text, count, rng):
    words = text.split()
    for _ in range(count):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def near_rows():
    """Families of near copies at every distance around the bar, chains, and shared passages."""
    rng = random.Random(5)
    passage = prose(77, 40)
    rows = [(k, prose(k, 60)) for k in range(20)]
    rows += [(50 + k, f"{passage} {prose(300 + k, 30)}") for k in range(20)]
    lines = [prose(900 + k, 12) for k in range(8)]
    rows += [(80 + k, " ".join(rng.sample(lines, 5))) for k in range(40)]
    for base in range(4):
        text = prose(50 + base, 150)
        rows += [(200 + 40 * base + k, changed(text, k % 6, rng)) for k in range(30)]
        rows += [(230 + 40 * base, " ".join(text.split()[: 100 + base * 12])), (231 + 40 * base, text.upper())]
    chain = prose(60, 200).split()
    rows += [(500 - k, " ".join(chain[4 * k : 100 + 4 * k])) for k in range(20)]
    rows += [(600 + k, " ".join(prose(61, 4 + k).split()[: 1 + k])) for k in range(6)]
    rows += [(610 + k, " ".join(prose(61, 4 + k).split()[: 1 + k])) for k in range(6)]
    rng.shuffle(rows)
    return rows


def test_near_copies_equal_brute_force(spark, near_rows):
    want = check(spark, near_rows)
    sizes = [sum(c == d for *_, c in want) for d, *_ in want]
    assert max(sizes) > 15 and sizes.count(1) > 40


def test_many_rounds_small_batches_and_tries(spark, near_rows, monkeypatch):
    monkeypatch.setattr(substring_dedup, "PACK_BYTES", 4096)
    monkeypatch.setattr(ngram_join, "TRIE_TOKENS", 300)
    monkeypatch.setattr(ngram_join, "MORE_CENTRES", 2)
    check(spark, near_rows, clashes=True)


def test_another_bar(spark, near_rows):
    check(spark, near_rows[::2], share=(1, 2))


def test_odd_rows(spark):
    rows = [*odd_rows(), (30, "One"), (31, "one two three four"), (None, "ONE two Three four"), (29, "a b"), (None, "x y z")]
    want = check(spark, rows, clashes=True)
    assert (31, 1, 31) in want and (None, 1, 31) in want and (None, 1, None) in want


def test_row_without_id_connects_others(spark):
    words = prose(8, 120).split()
    rows = [(5, " ".join(words[:100])), (None, " ".join(words[6:106])), (3, " ".join(words[12:112]))]
    assert {r[2] for r in check(spark, rows, share=(85, 100))} == {3}


def test_one_text_many_times(spark):
    text = prose(1, 80)
    rows = [(k, text) for k in range(300, 0, -1)] + [(0, text + " more")]
    assert {r[2] for r in check(spark, rows)} == {0}


def test_empty_table(spark):
    assert ngram_components(documents(spark, [])).collect() == []


numbers = st.sets(st.integers(0, 30), min_size=1, max_size=20)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(numbers, st.integers(0, 5)), min_size=1, max_size=25), numbers, st.integers(0, 5))
def test_trie_equals_plain_comparison(sets, query, more):
    """Sizes may be above the lengths: not all of a set need be stored."""
    trie = Trie([np.array(sorted(s), np.uint64) for s, _ in sets], [len(s) + k for s, k in sets])
    for share in ((80, 100), (1, 2), (1, 10)):
        size = len(query) + more
        want = []
        for k, (s, own) in enumerate(sets):
            met = len(s & query)
            if share[1] * met >= share[0] * (size + len(s) + own - met):
                want.append(k)
        assert sorted(trie.similar(np.array(sorted(query), np.uint64), size, share).tolist()) == want
