"""Language ID: held-out accuracy, odd rows and the profile's counts."""

from __future__ import annotations

import zlib
from collections import Counter

import pytest
from llm_tables import documents, odd_rows
from pyspark.sql import functions as F

from daybook.llm import language_id
from daybook.llm.language_id import _gram_counts, held_out, identify, keep_recognised, learn_profiles


@pytest.fixture(scope="module")
def found(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    profiles = learn_profiles(docs)
    rows = identify(docs, profiles).join(docs.select("doc_id", "lang", "text"), "doc_id").collect()
    return rows, profiles


def test_held_out_accuracy(found):
    rows = [r for r in found[0] if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    long = [r for r in rows if len(r.text) >= 100]
    assert len(rows) > 20
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) >= 0.9
    assert sum(r.lang == r.lang_pred for r in long) / len(long) >= 0.95
    assert all(0 <= r.score <= 1 and r.margin >= 0 for r in rows)


def brute_grams(text):
    counts = Counter()
    line = "".join(c if c.isalpha() else " " for c in text.lower())
    for word in line.split():
        padded = f" {word} "
        counts.update(word)
        counts.update(padded[k : k + 2] for k in range(len(padded) - 1))
        counts.update(padded[k : k + 3] for k in range(len(padded) - 2))
    return counts


def code(gram):
    number = 0
    for letter in gram:
        number = number << 21 | ord(letter)
    return number


@pytest.mark.parametrize("chunk", [4, 1 << 18])
def test_gram_counts(chunk, monkeypatch):
    monkeypatch.setattr(language_id, "CHUNK", chunk)
    for text in ["Ab c, ab!", " x", "żółw 漢字 9 a", "", "!!", "don't"]:
        codes, counts = _gram_counts(text)
        want = {code(g): n for g, n in brute_grams(text).items()}
        assert dict(zip(codes.tolist(), counts.tolist(), strict=True)) == want


def test_profiles_equal_brute_force(spark, found, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    counts = Counter()
    for r in docs:
        if r.lang == "de" and zlib.crc32(str(r.doc_id).encode()) % 5:
            counts.update(brute_grams(r.text))
    best = sorted(((-n, code(g)) for g, n in counts.items()))[: language_id.PROFILE]
    got = found[1].filter("lang = 'de'").orderBy("rank").collect()
    assert [r.gram for r in got] == [g for _, g in best]


def brute_nearest(text, profiles, size):
    """Language, score and lead by ranking every n-gram and looking each up in every profile."""
    counts = {code(g): n for g, n in brute_grams(text or "").items()}
    ranked = sorted(counts, key=lambda g: (-counts[g], g))[:size]
    if not ranked:
        return "und", 0.0, 0.0
    scores = {}
    for lang, profile in profiles.items():
        off = sum(abs(profile[g] - k) if g in profile else size for k, g in enumerate(ranked))
        scores[lang] = 1 - off / (size * len(ranked))
    best, *others = sorted(scores, key=lambda lang: (-scores[lang], lang))
    return best, scores[best], scores[best] - max((scores[x] for x in others), default=0.0)


def check_identify(docs, learned, size):
    profiles = {}
    for lang, gram, rank in learned.collect():
        profiles.setdefault(lang, {})[gram] = rank
    key = lambda r: (str(r[0]), r[1], str(r[2:]))
    got = sorted((tuple(r) for r in identify(docs, learned, size=size).collect()), key=key)
    texts = docs.select("doc_id", "text").collect()
    want = sorted(((r.doc_id, *brute_nearest(r.text, profiles, size)) for r in texts), key=key)
    assert [r[:2] for r in got] == [r[:2] for r in want]
    for one, other in zip(got, want, strict=True):
        assert one[2:] == pytest.approx(other[2:], abs=1e-12)


def test_nearest_language_equals_brute_force(spark, found, sf):
    check_identify(spark.read.parquet(f"{sf}/documents.parquet"), found[1], language_id.PROFILE)
    check_identify(documents(spark, odd_rows(), clashes=True), found[1], language_id.PROFILE)


@pytest.mark.parametrize("size", [3, 20])
def test_short_profiles_and_ties_equal_brute_force(spark, size):
    """Two languages that learned the same text tie everywhere; the first by name wins."""
    rows = [(k, text, lang, "s") for k, (text, lang) in enumerate(
        (text, lang) for text in ("abc abd", "cab dab", "xyz é") for lang in ("b", "a", "c") if (text, lang) != ("xyz é", "a"))]
    docs = documents(spark, rows)
    check_identify(docs, learn_profiles(docs, size=size), size)


def test_odd_rows(spark, found):
    docs = documents(spark, odd_rows(), clashes=True)
    got = identify(docs, found[1]).collect()
    assert len(got) == len(odd_rows())
    by_id = {r.doc_id: r for r in got}
    for doc_id in (3, 4, 5):
        assert (by_id[doc_id].lang_pred, by_id[doc_id].score) == ("und", 0.0)
    assert by_id[1].lang_pred in {"en", "de", "fr", "es"}
    kept = keep_recognised(docs, found[1])
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert not {3, 4, 5} & set(ids) and {1, 2, 6, 7, 9}.issubset(ids) and ids.count(2) == 2


def test_nothing_learned(spark):
    docs = documents(spark, [(1, "words", None, "s"), (2, "!!", "en", "s")])
    profiles = learn_profiles(docs.filter("doc_id = 1"))
    assert [tuple(r) for r in identify(docs, profiles).select("lang_pred", "score").collect()] == [("und", 0.0)] * 2
    assert [r.doc_id for r in keep_recognised(docs, profiles).collect()] == [1]
    empty = documents(spark, [])
    assert identify(empty, learn_profiles(empty)).collect() == []


def test_held_out_follows_crc(spark):
    rows = spark.range(100).select("id", held_out(F.col("id")).alias("out")).collect()
    assert all(r.out == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in rows)
    assert spark.sql("SELECT CAST(null AS BIGINT) id").select(held_out(F.col("id"))).first()[0] is False
