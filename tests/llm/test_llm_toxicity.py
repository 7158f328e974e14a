"""Toxicity: held-out accuracy, folding, exceptions and odd rows."""

from __future__ import annotations

import pytest
from llm_tables import documents, odd_rows

from daybook.llm.toxicity import Model, all_terms, automaton, fold, learn, score, strength, strength_of


@pytest.fixture(scope="module")
def small(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = learn(docs, labels)
    return model, docs, labels


def test_held_out_accuracy(small):
    import zlib

    model, docs, labels = small
    rows = [r for r in score(docs, model).join(labels, "doc_id").collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    toxic, clean = [r for r in rows if r.toxic], [r for r in rows if not r.toxic]
    assert len(toxic) >= 50
    pairs = [(a.score > b.score) + (a.score == b.score) / 2 for a in toxic for b in clean]
    assert sum(pairs) / len(pairs) >= 0.9
    assert sum(r.predicted for r in clean) / len(clean) <= 0.02
    assert sum(r.predicted == r.toxic for r in rows) / len(rows) >= 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def test_folding():
    assert fold("You 1d10t!") == fold("yоu ｉdіοt") == " you idiot "
    assert fold("$cum, tr@sh.") == " scum trash "
    assert fold("word$$$ 5 km 100") == " word 5 km 100 "
    assert fold(None) == fold("") == fold("!!") == "  "


def test_matching_counts_words_once_and_spares_exceptions():
    machine = automaton({" trash ": 3.0, " idio": 2.0, " idiot ": 5.0})
    assert strength(" you idiot ", machine) == (5.0, 1, 2)
    assert strength(" idiotic idiots ", machine) == (4.0, 2, 2)
    assert strength(" the trash can is trash ", machine) == (3.0, 1, 5)
    assert strength(" nonidiot ", machine) == (0.0, 0, 1)
    assert strength("  ", machine) == (0.0, 0, 0)
    assert strength(" a ", automaton({}, ())) == (0.0, 0, 1)


def test_signs_before_and_behind_words_are_read_both_ways():
    terms = (" loser ", " idiot ", " trash", " scum ", " ass ", " dumbass ", " l0l ")
    machine = automaton(dict.fromkeys(terms, 2.0))
    for text in ("@loser", "@l0ser", "you!idiot", "Wow!Trash", "Wow!tr@sh", "$scum", "$cum", "a$$", "dumb4$$", "idiot!", "l0l"):
        assert strength_of(text, machine)[:2] == (2.0, 1), text
    assert strength_of("scum!idiot @friend! word$$$ 100", machine) == (4.0, 2, 4)
    assert strength_of("the tr@sh can! @trash can, trash @can and trash bin!", machine)[:2] == (0.0, 0)
    assert strength_of("scum!trash can", machine)[:2] == (2.0, 1)
    assert strength_of("__a$$__ you", machine) == (2.0, 1, 2)
    assert " loser " in all_terms("@loser") and " ass " in all_terms("a$$") and " friend " in all_terms("@friend")
    assert strength_of(None, machine) == strength_of("!!", machine) == (0.0, 0, 0)
    assert strength_of("a$$", automaton({}, ()), ()) == (0.0, 0, 1)


def test_longer_texts_score_lower(spark):
    model = Model({" scum ": 5.0}, -3.0, 2.0)
    docs = documents(spark, [(1, "scum"), (2, "scum " + "word " * 2000), (3, "word")])
    got = {r.doc_id: r.score for r in score(docs, model).collect()}
    assert got[1] > got[2] > got[3]


def test_odd_rows(spark, small):
    docs = documents(spark, odd_rows() + [(20, "MOR0N pathetic $cum idiot")], clashes=True)
    got = score(docs, small[0]).collect()
    assert len(got) == len(odd_rows()) + 1
    by_id = {r.doc_id: r for r in got}
    assert by_id[20].predicted == 1 and by_id[20].hits == 4
    assert by_id[3].score == by_id[4].score < 0.5 and by_id[3].n_words == 0


def test_rare_but_clear_terms_enter_the_lexicon(spark):
    vocabulary = [f"vile{chr(97 + k // 26)}{chr(97 + k % 26)}zz" for k in range(200)]
    toxic = [(k, f"you {vocabulary[k % 200]} and {vocabulary[(k * 7 + 3) % 200]} there") for k in range(6000)]
    clean = [(k, f"word{k % 900} and some{k % 700} there, you") for k in range(6000, 12_000)]
    clean += [(k, f"{vocabulary[0]} word") for k in range(12_000, 12_600)]
    rows = [(k, 0, int(k < 6000)) for k, _ in toxic + clean]
    model = learn(documents(spark, toxic + clean), spark.createDataFrame(rows, "doc_id long, quality int, toxic int"))
    assert all(f" {word} " in model.lexicon for word in vocabulary[1:])
    assert not [t for t in model.lexicon if "vile" not in t] and f" {vocabulary[0]} " not in model.lexicon
    got = {r.doc_id: r for r in score(documents(spark, toxic[1:400] + clean[:400]), model).collect()}
    assert sum(r.predicted == (k < 6000) for k, r in got.items()) / len(got) >= 0.99


def test_labels_that_teach_nothing(spark):
    docs = documents(spark, [(1, "scum"), (None, "x"), (2, None)])
    kind = "doc_id long, quality int, toxic int"
    for rows in ([], [(1, 0, 0)], [(None, 0, 1), (2, 1, None), (2, 0, 1)], [(1, 0, 1), (1, 0, 0), (1, 0, 1)]):
        model = learn(docs, spark.createDataFrame(rows, kind))
        got = score(docs, model).collect()
        assert len(got) == 3 and all(0 <= r.score <= 1 for r in got)
    assert score(documents(spark, []), model).collect() == []
