"""Language ID by rank-order profiles.

A language's profile is the ranking of its most frequent letter n-grams (one to
three letters, word ends as blanks). A document is ranked the same way, and each of
its n-grams costs as many places as its rank is off, or the most possible where the
profile lacks it. The language with the least total wins.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.words import give_back, ready
from daybook.scratch import settle

# N-grams of a profile, and labelled rows of a language that profiles learn from.
PROFILE = 400
ROWS_PER_LANGUAGE = 5_000

UNDETERMINED = "und"

# Letters counted at a time, and distinct n-grams held before they are handed on.
CHUNK = 1 << 18
HELD_GRAMS = 1 << 20


def held_out(doc_id: Column) -> Column:
    """Whether the CRC-32 of an id's text leaves no remainder by 5; false without an id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def learn_profiles(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    rows_per_language: int = ROWS_PER_LANGUAGE,
    size: int = PROFILE,
) -> DataFrame:
    """(lang, gram, rank), ranks from 0, from labelled rows that are not held out.

    Learns from about ``rows_per_language`` rows of a language, chosen by a hash of
    the id, or from all if there are fewer. Rows without id, text or language do not
    teach. Equal counts rank by the n-gram's code.
    """
    ready(docs.sparkSession)
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")
    ).filter("doc_id IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL")
    rows = rows.filter(~held_out(F.col("doc_id")))
    counts = rows.groupBy("lang").agg(F.count("*").alias("rows"))
    share = F.lit(float(rows_per_language << 20)) / F.col("rows")
    # Written, so that Spark knows how small it is and does not shuffle texts by language.
    shares = settle(counts.select("lang", share.alias("share")), "shares")
    keep = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < F.col("share")
    chosen = rows.join(shares, "lang").filter(keep)
    grams = chosen.select("lang", "text").mapInArrow(_count_grams, "lang string, gram long, n long")
    totals = grams.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    best = Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram")
    ranked = totals.withColumn("rank", F.row_number().over(best) - 1).filter(F.col("rank") < size)
    return ranked.select("lang", "gram", "rank")


def identify(
    docs: DataFrame,
    profiles: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = PROFILE,
) -> DataFrame:
    """(doc_id, lang_pred, score, margin) of every row.

    Score is 1 less the share of the largest possible distance, margin its lead over
    the second language. A null text, or one without a letter, is ``und`` with score
    0, and so is everything when no profile was learned. Equal distances go to the
    first language in code point order. The profiles, a few hundred rows a language,
    are the only thing that every task receives.
    """
    ready(docs.sparkSession)
    langs, grams, ranks = _ranks(profiles)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [_nearest(x.as_py(), langs, grams, ranks, size) for x in batch.column("text")]
            columns = [list(c) for c in zip(*made, strict=True)] or [[], [], []]
            kinds = (pa.string(), pa.float64(), pa.float64())
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            arrays = [batch.column("doc_id"), *arrays]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "lang_pred", "score", "margin"])
        give_back()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double, margin double")


def keep_recognised(docs: DataFrame, profiles: DataFrame, size: int = PROFILE) -> DataFrame:
    """The rows of ``docs`` whose text some language's profile recognises.

    Rejected are null texts, texts without a letter, and texts none of whose frequent
    n-grams is near its place in any profile (score 0). Where nothing was learned, only
    texts without a letter are. All columns stay as they are.
    """
    ready(docs.sparkSession)
    langs, grams, ranks = _ranks(profiles)

    def known(text: str | None) -> bool:
        if not langs:
            return bool(len(_gram_counts(text or "")[0]))
        return _nearest(text, langs, grams, ranks, size)[1] > 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([known(x.as_py()) for x in batch.column("text")], pa.bool_()))
        give_back()

    return docs.mapInArrow(run, docs.schema)


def _ranks(profiles: DataFrame) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, their n-grams, and each one's rank in each language or -1."""
    known = [tuple(r) for r in profiles.collect()]
    langs = sorted({lang for lang, _, _ in known})
    grams = np.array(sorted({gram for _, gram, _ in known}), np.int64)
    ranks = np.full((len(langs), len(grams)), -1, np.int64)
    for lang, gram, rank in known:
        ranks[langs.index(lang), np.searchsorted(grams, gram)] = rank
    return langs, grams, ranks


@cache
def _letters() -> np.ndarray:
    """Which code points are letters."""
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def _gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a text as numbers of 21 bits a letter, with their counts."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[points]
    kept = letter.copy()
    kept[1:] |= letter[:-1]
    line = np.full(int(kept.sum()) + 2, 32, np.int64)
    line[1:-1] = np.where(letter, points, 32)[kept]
    if not letter.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    if line[-2] == 32:
        line = line[:-1]
    held: list[tuple[np.ndarray, np.ndarray]] = []
    for at in range(0, len(line), CHUNK):
        a = line[at : at + CHUNK + 2]
        own = min(CHUNK, len(line) - at)
        two = (a[:-1] << 21 | a[1:])[:own]
        three = (a[:-2] << 42 | a[1:-1] << 21 | a[2:])[:own]
        one = a[:own]
        codes = np.concatenate([one[one != 32], two, three[a[1:-1][:own] != 32]])
        held.append(np.unique(codes, return_counts=True))
    return held[0] if len(held) == 1 else _merged(held)


def _merged(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Counts added up by n-gram."""
    codes, place = np.unique(np.concatenate([c for c, _ in held]), return_inverse=True)
    return codes, np.bincount(place, np.concatenate([n for _, n in held])).astype(np.int64)


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, n) of a partition, added up as far as memory for them goes."""
    held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
    size = 0

    def rows() -> Iterator[pa.RecordBatch]:
        for lang, counts in held.items():
            codes, n = _merged(counts)
            arrays = [pa.array([lang] * len(codes), pa.string()), pa.array(codes), pa.array(n)]
            yield pa.RecordBatch.from_arrays(arrays, ["lang", "gram", "n"])

    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
            found = _gram_counts(text.as_py())
            held.setdefault(lang, []).append(found)
            size += len(found[0])
        if size > HELD_GRAMS:
            held = {lang: [_merged(counts)] for lang, counts in held.items()}
            size = sum(len(counts[0][0]) for counts in held.values())
            if size > HELD_GRAMS // 2:
                yield from rows()
                held, size = {}, 0
    yield from rows()


def _nearest(
    text: str | None, langs: list[str], grams: np.ndarray, ranks: np.ndarray, size: int
) -> tuple[str, float, float]:
    """The language whose profile is nearest to a text's, its score and its lead."""
    codes, counts = _gram_counts(text or "")
    if not len(codes) or not langs:
        return UNDETERMINED, 0.0, 0.0
    top = codes[np.lexsort((codes, -counts))[:size]]
    place = np.minimum(np.searchsorted(grams, top), len(grams) - 1)
    theirs = np.where(grams[place] == top, ranks[:, place], -1)
    off = np.where(theirs < 0, size, np.abs(theirs - np.arange(len(top))))
    scores = 1 - off.sum(axis=1) / (size * len(top))
    best = int(np.argmax(scores))
    others = np.delete(scores, best)
    lead = float(scores[best] - others.max()) if len(others) else float(scores[best])
    return langs[best], float(scores[best]), lead
