"""Small tables of documents for the tests of the operators."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

# Columns under names that operators use for themselves.
CLASHES = (
    "size", "place", "bin", "row", "words", "hash", "text_hash", "part", "guest", "print", "node",
    "component_id", "key", "batch_id", "ids", "texts", "target", "whole", "rest", "edge", "below",
    "extra", "share", "gram", "rank", "score", "surplus", "shared", "items", "lengths", "data",
    "_size", "_place", "_bin", "_part", "_of", "_hash", "_e", "_p", "_s",
)


def documents(spark, rows, clashes=False):
    """Documents from (doc_id, text[, lang, source]) rows."""
    full = []
    for row in rows:
        doc_id, text, lang, source = (*row, "en", "src0")[:4] if len(row) < 4 else row
        full.append((doc_id, text, lang, source, None if text is None else len(text)))
    docs = spark.createDataFrame(full, SCHEMA)
    if clashes:
        docs = docs.withColumns({name: F.lit(f"own {name}") for name in CLASHES})
    return docs


def odd_rows(seed=7):
    """Nulls in any column, empty and very long texts, repeated rows, shared ids, odd characters."""
    rng = random.Random(seed)
    words = ["the", "of", "and", "tion", "ing", "Er", "ça", "über", "x.", "y,"]
    long = " ".join(rng.choice(words) for _ in range(60_000))
    passage = " ".join(f"w{k}" for k in range(40))
    return [
        (1, passage, "en", "src1"),
        (2, f"start {passage} end", "en", "src1"),
        (2, f"start {passage} end", "en", "src1"),
        (3, None, None, None),
        (None, f"no id {passage}", "de", "src2"),
        (None, None, None, None),
        (4, "", "fr", None),
        (5, " \t\n\x0b\x0c\r ", "fr", "src2"),
        (6, long, "de", "src2"),
        (7, long, None, "src3"),
        (8, " 　 é́ \U0001f600   İK", "es", ""),
        (9, "one", "en", "src3"),
        (9, "two words", "en", "src3"),
        (10, "<|endoftext|> <|ENDOFTEXT|> don't DON'T it's 3.14, a.b.", "en", "src1"),
        (-5, "negative " + passage, "en", "src1"),
        (11, "x" * 200_000, "en", "src1"),
    ]


def prose(seed, words=200, vocabulary=400):
    """A text of random made-up words."""
    rng = random.Random(seed)
    pool = [f"{a}{b}{c}" for a in "kmprt" for b in "aeiou" for c in ("n", "s", "rel", "tion", "sk", "", "wi", "du")]
    pool = (pool * 3)[:vocabulary]
    return " ".join(rng.choice(pool) for _ in range(words))
