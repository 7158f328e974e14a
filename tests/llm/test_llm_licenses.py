"""License scans against a word-by-word reading."""

from __future__ import annotations

import random
import re

import pytest
from llm_tables import documents, odd_rows, prose

from daybook.llm.licenses import BASE, KNOWN, TEMPLATES, scan_licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered_words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def places(words, phrase):
    phrase = phrase.split()
    return [k for k in range(len(words) - len(phrase) + 1) if words[k : k + len(phrase)] == phrase]


def base_columns(doc_id, text):
    words = lowered_words(text)
    found = {p: places(words, p) for p in BASE}
    every = sorted(k for at in found.values() for k in at)
    labels = ",".join(sorted({BASE[p] for p, at in found.items() if at}))
    ends = (every[0], every[-1]) if every else (None, None)
    return (doc_id, len(words), len(every), *ends, labels)


def check(docs):
    got = scan_licenses(docs).collect()
    have = [(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got]
    want = [base_columns(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(have, key=str) == sorted(want, key=str)
    for r in got:
        assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(","))
        assert r.labels.split(",") == sorted(set(r.labels.split(",")))
        assert 0 <= r.score <= 1 and (r.score > 0) == (r.labels != "")
    return {r.doc_id: r for r in got}


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_given_documents(spark, sf):
    got = check(spark.read.parquet(f"/root/testdata/sf{sf}/documents.parquet"))
    assert {"mit", "gpl", "apache-2.0"} & {x for r in got.values() for x in r.labels.split(",")}


def test_every_template_is_found_inside_other_words(spark):
    rows = [(k, f"{prose(k)}\n{notice.title()}.\n{prose(k + 99)}") for k, (_, notice, _) in enumerate(TEMPLATES)]
    got = check(documents(spark, rows))
    for k, (label, _, _) in enumerate(TEMPLATES):
        assert label in got[k].labels.split(",")
        assert (k, 200) in [tuple(t) for t in got[k].templates]


def test_key_phrase_is_mandatory_and_order_counts(spark):
    rows = [
        (1, "released under the old license"),
        (2, "license mit the under released"),
        (3, "Released under the MIT-License"),
        (4, "general general public license cc by cc by all rights all rights reserved"),
        (5, "GENERAL, publicé license"),
        (6, "cc" + "K" + " by, CC.BY"),
        (7, "the the of and a to this is in"),
    ]
    got = check(documents(spark, rows))
    assert [got[k].labels for k in (1, 2, 3, 5, 7)] == ["", "", "mit", "", ""]
    assert (got[4].n_base, got[4].first_word, got[4].last_word) == (4, 1, 10)
    assert got[4].base_labels == "cc-by,gpl,reserved"


def test_several_notices_in_one_long_text(spark):
    plain = [prose(k, 40) + " person charge software forms foundation" for k in range(40)]
    pairs = [(a, b) for a in range(len(TEMPLATES)) for b in range(len(TEMPLATES)) if a != b]
    texts = [f"{plain[a]} {TEMPLATES[a][1]}. {plain[b]} {TEMPLATES[b][1]}." for a, b in pairs]
    texts.append(" ; ".join(f"{prose(k, 30)} {notice}" for k, (_, notice, _) in enumerate(TEMPLATES)))
    got = check(documents(spark, list(enumerate(texts + plain))))
    for k, text in enumerate(texts + plain):
        words, want = lowered_words(text), set()
        for n, (_, notice, key) in enumerate(TEMPLATES):
            before = len(notice.split(key)[0].split())
            want |= {(n, at - before) for at in places(words, key)}
        assert {tuple(t) for t in got[k].templates or []} == want


def labels_by_reading(text):
    """Labels from every place of every key phrase that is not inside a longer one of another label."""
    words = lowered_words(text)
    found = [(at, at + len(key.split()), label) for label, _, key in KNOWN for at in places(words, key)]
    inside = lambda a, b: b[0] <= a[0] and a[1] <= b[1] and b[1] - b[0] > a[1] - a[0] and a[2] != b[2]
    own = {label for phrase, label in BASE.items() if places(words, phrase)}
    return ",".join(sorted(own | {a[2] for a in found if not any(inside(a, b) for b in found)}))


VARIANTS = {
    "Creative Commons Attribution-NonCommercial-NoDerivatives 4.0": "cc-by-nc-nd",
    "Creative Commons Attribution-ShareAlike 3.0": "cc-by-sa",
    "a Creative Commons Attribution 4.0 licence": "cc-by",
    "Creative Commons Attribution Non-Commercial Share Alike": "cc-by-nc-sa",
    "Apache License 2.0": "apache-2.0",
    "SPDX-License-Identifier: Apache-2.0": "apache-2.0",
    "// SPDX-License-Identifier: GPL-2.0-only": "gpl",
    "SPDX-License-Identifier: CC-BY-SA-4.0": "cc-by,cc-by-sa",
    "the Eclipse Public License 2.0": "epl",
    "identifier license spdx mit": "",
    "creative attribution commons": "",
}


def test_variants_and_identifiers(spark):
    got = check(documents(spark, list(enumerate(VARIANTS))))
    assert [got[k].labels for k in range(len(VARIANTS))] == list(VARIANTS.values())


def test_every_variant_and_identifier_is_found(spark):
    got = check(documents(spark, [(k, f"{prose(k)} {notice.upper()} {prose(k + 9)}") for k, (_, notice, _) in enumerate(KNOWN)]))
    for k, (label, _, _) in enumerate(KNOWN):
        assert label in got[k].labels.split(",") and (k, 200) in [tuple(t) for t in got[k].templates]


def test_labels_against_reading(spark):
    """Key phrases and their pieces in random order, so that longer ones hold shorter ones or not."""
    rng = random.Random(11)
    pieces = [key for _, _, key in KNOWN] + [w for _, _, key in KNOWN for w in key.split()[:3]] + ["and", "4.0"]
    texts = [" ".join(rng.choice(pieces) for _ in range(rng.randrange(1, 12))) for _ in range(300)]
    texts += [f"{a} {b}" for a in VARIANTS for b in VARIANTS]
    got = check(documents(spark, list(enumerate(texts))))
    assert [got[k].labels for k in range(len(texts))] == [labels_by_reading(t) for t in texts]


def test_odd_rows(spark):
    check(documents(spark, odd_rows(), clashes=True))
    assert scan_licenses(documents(spark, [])).collect() == []


def test_no_python_runs(spark, sf):
    plan = scan_licenses(spark.read.parquet(f"{sf}/documents.parquet"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop") if x in text]
