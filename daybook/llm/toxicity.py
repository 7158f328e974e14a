"""Toxicity by a weighted lexicon, matched with an Aho-Corasick automaton.

Texts are folded first: lower case, letters of other scripts that look like Latin
ones, and digits and signs that stand for letters before a letter. Where signs or
digits touch letters, the other readings are tried too: as separators, as letters at
the end of a word, or as they are; the heaviest reading counts. Terms are whole
words or word beginnings, so that inflected and compound forms match. Their weights
are learned from labelled rows. The matched weights of a text, less what stands in
exception phrases, are divided by the root of its length and turned into a
probability by a logistic curve fitted on the same rows.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.language_id import held_out
from daybook.llm.words import ready
from daybook.scratch import settle

# Labelled rows of a class that the lexicon and the curve learn from.
ROWS_PER_CLASS = 10_000

# A term's least log-odds, the least number of toxic rows that hold it, and the least
# evidence: chance spreads a term so unevenly with probability e ** -evidence at most.
LEAST_WEIGHT = 2.5
LEAST_ROWS = 3
LEAST_EVIDENCE = math.log(10_000)

# Lengths of word beginnings that may become terms.
BEGINNINGS = (4, 5, 6)

# Words added to a length, so that a single word does not decide for a short text.
LENGTH_PRIOR = 20

# Phrases in which a term is harmless.
EXCEPTIONS = (
    "trash can",
    "trash bag",
    "trash bin",
    "clown fish",
    "circus clown",
    "pond scum",
    "soap scum",
)

# Letters of other scripts and their Latin look-alikes.
LOOK_ALIKES = str.maketrans(
    "авеёікмнорстухѕјԁɡ" "αβεικνορτυχ" "ıł",
    "abeeikmhopctyxsjdg" "abeikvoptux" "il",
)
FULL_WIDTH = {0xFF41 + k: 0x61 + k for k in range(26)}
STAND_INS = str.maketrans("0134578@$!", "oieastbasi")
STAND_IN = re.compile(r"(?<![0-9@$!])[0134578@$!]+(?=[^\W\d_])")
STAND_IN_BEHIND = re.compile(r"(?<=[^\W\d_])[0134578@$!]+(?![0-9@$!])")
SIGNS = "@$!"
GAP = re.compile(r"[\W_]+")

# Runs of letters, digits and signs, and the places that make several readings of one.
CHUNK = re.compile(r"(?:[^\W_]|[@$!])+")
SEVERAL = re.compile(r"[0134578@$!](?:(?<=[^\W\d_].)|(?=[^\W\d_]))")


def fold(text: str | None) -> str:
    """A text's words between single blanks, written in plain small letters."""
    return _folded(_small(text))


def _small(text: str | None) -> str:
    """A text in small letters, those of other scripts that look Latin made Latin."""
    text = (text or "").lower()
    return text if text.isascii() else text.translate(LOOK_ALIKES).translate(FULL_WIDTH)


def _folded(small: str) -> str:
    small = STAND_IN.sub(_letters, small)
    return f" {GAP.sub(' ', small).strip()} "


def _letters(found: re.Match) -> str:
    return found[0].translate(STAND_INS)


@lru_cache(1 << 14)
def forms(chunk: str) -> tuple[str, ...]:
    """The readings of a run of letters, digits and signs, each as words between blanks.

    First that of ``fold``; then with every choice of the signs that occur taken as
    separators and the other stand-ins as letters, before letters only or behind them
    too; last with all signs as separators and digits as they are.
    """
    found = [_folded(chunk)]
    signs = [x for x in SIGNS if x in chunk]
    for n in range(len(signs) + 1):
        for apart in combinations(signs, n):
            parted = chunk.translate({ord(x): " " for x in apart})
            found += [_folded(parted), _folded(STAND_IN_BEHIND.sub(_letters, STAND_IN.sub(_letters, parted)))]
    found.append(f" {GAP.sub(' ', chunk).strip()} ")
    return tuple(dict.fromkeys(found))


def ambiguous(small: str) -> set[str]:
    """The chunks of a text in small letters that have several readings."""
    if not SEVERAL.search(small):
        return set()
    return {c for c in CHUNK.findall(small) if SEVERAL.search(c) and len(forms(c)) > 1}


def all_terms(text: str | None) -> set[str]:
    """The terms a text holds in any reading."""
    small = _small(text)
    terms = terms_of(_folded(small))
    for chunk in ambiguous(small):
        for form in forms(chunk)[1:]:
            terms |= terms_of(form)
    return terms


def terms_of(folded: str) -> set[str]:
    """The terms a folded text holds: word beginnings, and words with the blank behind."""
    terms = set()
    for word in set(folded.split()):
        terms.add(f" {word} ")
        terms.update(f" {word[:n]}" for n in BEGINNINGS if len(word) >= n)
    return terms


def automaton(lexicon: dict[str, float], exceptions: tuple[str, ...] = EXCEPTIONS):
    """An automaton whose values are (length, weight); exceptions weigh nothing."""
    machine = ahocorasick.Automaton()
    for term, weight in lexicon.items():
        machine.add_word(term, (len(term), weight))
    for phrase in exceptions:
        machine.add_word(f" {phrase} ", (len(phrase) + 2, 0.0))
    if len(machine):
        machine.make_automaton()
    return machine


def strength(folded: str, machine) -> tuple[float, int, int]:
    """(matched weight, matched words, words) of a folded text.

    A word counts once, with the heaviest term that begins it. Words inside an
    exception phrase do not count.
    """
    words = folded.count(" ") - 1 if folded.strip() else 0
    if not len(machine) or not words:
        return 0.0, 0, words
    weights, _ = _found(folded, machine)
    return math.fsum(weights.values()), len(weights), words


def _found(folded: str, machine) -> tuple[dict[int, float], set[int]]:
    """Weights by where their words start, and the starts of those in exception phrases."""
    weights: dict[int, float] = {}
    spared: set[int] = set()
    harmless: list[tuple[int, int]] = []
    for end, (length, weight) in machine.iter(folded):
        start = end - length + 1
        if weight:
            weights[start] = max(weight, weights.get(start, 0.0))
        else:
            harmless.append((start, end))
    for start, end in harmless:
        for at in [x for x in weights if start <= x < end]:
            del weights[at]
            spared.add(at)
    return weights, spared


def strength_of(text: str | None, machine, exceptions: tuple[str, ...] = EXCEPTIONS) -> tuple[float, int, int]:
    """(matched weight, matched words, words) of a text over all its readings.

    Of a run of letters, digits and signs the heaviest reading counts, or the heaviest
    of those in which an exception phrase holds a term of it. Words are those of ``fold``.
    """
    small = _small(text)
    folded = _folded(small)
    plain = strength(folded, machine)
    harmless = {w for phrase in exceptions for w in phrase.split()}
    doubtful = {
        c
        for c in ambiguous(small)
        if any(_touches(form, machine, harmless) for form in forms(c)[1:])
    }
    if not doubtful:
        return plain
    chunks = CHUNK.findall(small)
    read = [forms(c) if c in doubtful else (_folded(c),) for c in chunks]
    best: dict[int, tuple[bool, float, int]] = {}
    for k in range(max(map(len, read))):
        line, begins, owners = [" "], [], []
        length = 1
        for at, options in enumerate(read):
            words = options[min(k, len(options) - 1)][1:]
            if words.strip():
                begins.append(length)
                owners.append(at)
                line.append(words)
                length += len(words)
        weights, spared = _found("".join(line), machine)
        sums: dict[int, list] = {}
        for start in [*weights, *spared]:
            owner = owners[bisect_right(begins, start + 1) - 1]
            entry = sums.setdefault(owner, [False, [], 0])
            if start in spared:
                entry[0] = True
            else:
                entry[1].append(weights[start])
                entry[2] += 1
        for owner, (spares, found, hits) in sums.items():
            best[owner] = max(best.get(owner, (False, 0.0, 0)), (spares, math.fsum(found), hits))
    return math.fsum(w for _, w, _ in best.values()), sum(n for _, _, n in best.values()), plain[2]


def _touches(form: str, machine, harmless: set[str]) -> bool:
    """Whether a reading holds a term, or a word of an exception phrase."""
    if len(machine) and next(machine.iter(form), None) is not None:
        return True
    return not harmless.isdisjoint(form.split())


def feature(weight: float, words: int) -> float:
    """Matched weight by length, on a scale that separates little from nothing."""
    return math.log1p(10 * weight / math.sqrt(words + LENGTH_PRIOR))


class Model:
    """A lexicon and the logistic curve over its feature."""

    def __init__(self, lexicon: dict[str, float], bias: float, slope: float, exceptions=EXCEPTIONS):
        self.lexicon, self.bias, self.slope, self.exceptions = lexicon, bias, slope, exceptions


def learn(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    rows_per_class: int = ROWS_PER_CLASS,
    exceptions: tuple[str, ...] = EXCEPTIONS,
) -> Model:
    """A model from labelled rows that are not held out.

    Learns from about ``rows_per_class`` rows of each class, chosen by a hash of the
    id, or from all if there are fewer. An id with several labels counts as toxic if
    one of them says so. A term enters the lexicon if at least three toxic rows hold
    it, its log-odds are 2.5 or more, and it is so unevenly spread over the classes that
    chance would do it in one of 10,000 cases at most. Null ids, labels and texts do not teach; without toxic rows the lexicon is empty and every
    score is the bias.
    """
    ready(docs.sparkSession)
    marked = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("toxic"))
    marked = marked.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").filter(~held_out(F.col("doc_id")))
    marked = settle(marked.groupBy("doc_id").agg(F.max("toxic").alias("toxic")), "marked")
    sizes = {r["toxic"]: r["n"] for r in marked.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20))
    cut = F.when(F.col("toxic") == 1, rows_per_class * (1 << 20) // max(sizes.get(1, 0), 1))
    cut = cut.otherwise(rows_per_class * (1 << 20) // max(sizes.get(0, 0), 1))
    chosen = settle(marked.filter(place < cut), "chosen")
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    sample = settle(texts.filter("text IS NOT NULL").join(chosen, "doc_id").select("toxic", "text"), "sample")
    rows = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, clean = rows.get(1, 0), rows.get(0, 0)

    # Rows that a term needs even if no clean row holds it: fewer cannot enter.
    alone = (n for n in range(LEAST_ROWS, toxic + 1) if _weight(n, 0, toxic, clean) is not None)
    least = next(alone, toxic + 1)
    held = sample.filter("toxic = 1").select("text").mapInArrow(_term_rows(None), "term string, n long")
    held = held.groupBy("term").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    positive = dict(tuple(r) for r in held.collect())
    also = sample.filter("toxic = 0").select("text").mapInArrow(_term_rows(set(positive)), "term string, n long")
    negative = dict(tuple(r) for r in also.groupBy("term").agg(F.sum("n").alias("n")).collect())
    weights = {term: _weight(n, negative.get(term, 0), toxic, clean) for term, n in positive.items()}
    lexicon = {term: weight for term, weight in weights.items() if weight is not None}

    scored = sample.mapInArrow(_features(lexicon, exceptions), "toxic int, x double")
    points = [tuple(r) for r in scored.collect()]
    weigh = {1: sizes.get(1, 0) / max(toxic, 1), 0: sizes.get(0, 0) / max(clean, 1)}
    return Model(lexicon, *_fitted(points, weigh), exceptions)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, predicted, hits, n_words) of every row.

    Score is the probability of label 1, predicted whether it reaches one half. Null
    and empty texts have no hits and get the score of the bias alone.
    """
    ready(docs.sparkSession)
    kinds = (pa.float64(), pa.int32(), pa.int64(), pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(model.lexicon, model.exceptions)
        for batch in batches:
            rows = []
            for text in batch.column("text"):
                weight, hits, words = strength_of(text.as_py(), machine, model.exceptions)
                p = _logistic(model.bias + model.slope * feature(weight, words))
                rows.append((p, int(p >= 0.5), hits, words))
            columns = list(zip(*rows, strict=True)) or [()] * 4
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            names = ["doc_id", "score", "predicted", "hits", "n_words"]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], names)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double, predicted int, hits long, n_words long")


def _weight(n: int, others: int, toxic: int, clean: int) -> float | None:
    """A term's log-odds from the toxic and clean rows that hold it, or None if not clear.

    Evidence is the Chernoff bound of the binomial tail: rows times the divergence of
    the toxic share among the term's rows from that among all rows.
    """
    odds = math.log((n + 0.5) / (toxic + 1)) - math.log((others + 0.5) / (clean + 1))
    if odds < LEAST_WEIGHT:
        return None
    rows, share = n + others, (toxic + 0.5) / (toxic + clean + 1)
    evidence = n * math.log(n / rows / share)
    if others:
        evidence += others * math.log(others / rows / (1 - share))
    return odds if evidence >= LEAST_EVIDENCE else None


def _logistic(x: float) -> float:
    return 1 / (1 + math.exp(-x)) if x >= 0 else math.exp(x) / (1 + math.exp(x))


def _term_rows(only: set[str] | None):
    """Counts the texts of a partition that hold each term, of all terms or of some."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column("text"):
                terms = all_terms(text.as_py())
                counts.update(terms if only is None else terms & only)
        arrays = [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())]
        yield pa.RecordBatch.from_arrays(arrays, ["term", "n"])

    return run


def _features(lexicon: dict[str, float], exceptions: tuple[str, ...]):
    """(label, feature) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(lexicon, exceptions)
        for batch in batches:
            found = [strength_of(t.as_py(), machine, exceptions) for t in batch.column("text")]
            x = pa.array([feature(weight, words) for weight, _, words in found], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), x], ["toxic", "x"])

    return run


def _fitted(points: list[tuple[int, float]], weigh: dict[int, float], steps: int = 50) -> tuple[float, float]:
    """Bias and slope of a logistic curve by Newton's method, the slope held back a little."""
    if not points:
        return -3.0, 0.0
    y = np.array([p[0] for p in points], float)
    x = np.c_[np.ones(len(points)), [p[1] for p in points]]
    w = np.where(y > 0, weigh[1], weigh[0])
    ridge = np.diag([1e-2, 1e-1])
    b = np.zeros(2)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        gradient = x.T @ (w * (y - p)) - ridge @ b
        step = np.linalg.solve((x * (w * p * (1 - p))[:, None]).T @ x + ridge, gradient)
        b = b + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(b[0]), float(b[1])
