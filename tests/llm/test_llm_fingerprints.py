"""Phrase fingerprints against a plain parse."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest
from llm_tables import documents, odd_rows, prose
from pyspark.sql import functions as F

from daybook.llm import fingerprints
from daybook.llm.fingerprints import Parse, compare_with_next, fingerprint_texts, likeness, signature_of
from daybook.llm.words import mix, word_hashes
from daybook.scratch import settle


def phrases(text):
    seen, phrase = set(), ""
    for letter in text:
        phrase += letter
        if phrase not in seen:
            seen.add(phrase)
            phrase = ""
    return seen


def signature(text):
    smallest = {}
    for phrase in phrases(text):
        raw = np.frombuffer(phrase.encode(), np.uint8)
        value = int(word_hashes(raw, np.array([0]), np.array([len(raw)]))[0])
        smallest[value % 128] = min(value, smallest.get(value % 128, value))
    out = np.zeros(128, ">u2")
    for k, value in smallest.items():
        out[k] = max(int(mix(np.array([value], np.uint64))[0]) & 0xFFFF, 1)
    return out


def check(spark, rows, clashes=False):
    docs = documents(spark, rows, clashes)
    got = sorted(map(tuple, compare_with_next(docs).collect()), key=str)
    order = docs.select("doc_id", "text", F.xxhash64("text").alias("own_hash")).collect()
    order = sorted(order, key=lambda r: (r.doc_id is None, -(r.doc_id or 0), -r.own_hash))
    want = []
    for k, r in enumerate(order):
        text, other = r.text or "", order[(k + 1) % len(order)].text or ""
        third = len(text) // 3
        edited = text[: len(text) - third] + other[:third]
        a, b, c = signature(text), signature(edited), signature(other)
        digest = hashlib.sha256(edited.encode()).hexdigest()
        want.append((r.doc_id, len(text), digest, a.tobytes().hex(), b.tobytes().hex(), likeness(a, b), likeness(a, c)))
    assert got == sorted(want, key=str)
    return got


def test_random_texts_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "RANGE_BYTES", 200)
    rows = [(7 * k % 101, prose(k, 3 + k % 50) + "é" * (k % 3)) for k in range(101)]
    check(spark, rows)


@pytest.mark.parametrize("count", [0, 1, 2])
def test_few_rows(spark, count):
    check(spark, [(k, f"some text {k}") for k in range(count)])


def test_odd_rows(spark):
    check(spark, odd_rows(), clashes=True)


@pytest.mark.parametrize("doc_id", [None, 7])
def test_rows_of_one_id_are_cut_over_ranges(spark, monkeypatch, doc_id):
    monkeypatch.setattr(fingerprints, "RANGE_BYTES", 2000)
    rows = [(doc_id, prose(k % 40, 20)) for k in range(400)] + [(doc_id, "the same words")] * 400 + [(3, "x"), (9, "y")]
    written = []

    def watched(df, label):
        table = settle(df, label)
        written.append(table)
        return table

    monkeypatch.setattr(fingerprints, "settle", watched)
    check(spark, rows)
    sizes = [r["count"] for r in written[0].filter(f"kind <> {fingerprints.TAIL}").groupBy("part").count().collect()]
    assert sum(sizes) == len(rows) and len(sizes) >= 8 and max(sizes) < len(rows) / 3


def test_no_range_goes_through_the_driver(spark, monkeypatch):
    docs, seen = documents(spark, [(k, prose(k, 30)) for k in range(50)]), []
    collect = type(docs).collect

    def watched(df):
        rows = collect(df)
        seen.append(len(rows))
        return rows

    monkeypatch.setattr(type(docs), "collect", watched)
    for name in ("toLocalIterator", "approxQuantile"):
        monkeypatch.setattr(type(docs), name, lambda *a, **k: pytest.fail("rows go to the driver"))
    compare_with_next(docs)
    assert seen == [1]


def test_equal_texts_have_equal_fingerprints(spark):
    got = fingerprint_texts(documents(spark, [(1, "same text"), (2, "same text"), (3, None), (4, "")])).collect()
    prints = {r.doc_id: r.fingerprint for r in got}
    assert prints[1] == prints[2] != prints[3] == prints[4]
    assert likeness(signature_of(prints[1]), signature_of(prints[2])) == 1.0
    assert likeness(signature_of(prints[3]), signature_of(prints[4])) == 1.0
    assert likeness(signature_of(prints[1]), signature_of(prints[3])) == 0.0


def test_parse_goes_on_where_it_stands():
    text = prose(3, 400)
    parts = Parse().feed(text[:777]).copy().feed(text[777:])
    assert (parts.signature() == Parse().feed(text).signature()).all()
    assert (Parse().feed(text).signature() == signature(text)).all()


def test_likeness_estimates_shared_phrases():
    a, b = prose(1, 3000), prose(2, 3000)
    half = a[: len(a) // 2] + b[: len(b) // 2]
    one, two = phrases(a), phrases(half)
    truth = len(one & two) / len(one | two)
    assert abs(likeness(signature(a), signature(half)) - truth) < 0.15
    assert likeness(signature(a), signature(half)) > likeness(signature(a), signature(b)) + 0.1


def test_dictionary_starts_anew(monkeypatch):
    monkeypatch.setattr(fingerprints, "DICTIONARY", 50)
    text = prose(5, 500)
    parse = Parse().feed(text)
    assert len(parse.seen) < 50 and (parse.signature() == Parse().feed(text[:1000]).feed(text[1000:]).signature()).all()
