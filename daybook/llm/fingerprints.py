"""Document fingerprints from Lempel-Ziv phrases.

A text is parsed as LZ78 does: every phrase is the shortest piece that is not yet in
the dictionary of pieces before it. Texts that compress well together share phrases.
The phrase set is hashed, and a fingerprint keeps the smallest hash of each of 128
bins; the share of equal bins estimates how alike two phrase sets are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.words import mix, partitions, ready, text_volume, word_hashes
from daybook.scratch import settle

BINS = 128

# Phrases in a dictionary before it starts anew, which bounds the memory of a long text.
DICTIONARY = 1 << 18

# Bytes of text in a range of the order of documents.
RANGE_BYTES = 64 << 20

class Parse:
    """An LZ78 parse that can be copied and goes on from where it stands."""

    def __init__(self) -> None:
        self.seen: set[str] = set()
        self.pending = ""
        self.smallest = np.full(BINS, np.iinfo(np.uint64).max, np.uint64)

    def copy(self) -> Parse:
        other = Parse()
        other.seen, other.pending, other.smallest = set(self.seen), self.pending, self.smallest.copy()
        return other

    def feed(self, text: str) -> Parse:
        """Parse more text; what is left of the last phrase waits for the next."""
        phrases: list[str] = []
        seen, add, keep, phrase = self.seen, self.seen.add, phrases.append, self.pending
        for letter in text:
            phrase += letter
            if phrase not in seen:
                add(phrase)
                keep(phrase)
                phrase = ""
                if len(seen) >= DICTIONARY:
                    seen.clear()
                    self._take(phrases)
                    phrases.clear()
        self.pending = phrase
        self._take(phrases)
        return self

    def _take(self, phrases: list[str]) -> None:
        if not phrases:
            return
        text = "".join(phrases)
        if text.isascii():
            sizes = np.fromiter(map(len, phrases), np.int64, len(phrases))
            data = text.encode()
        else:
            coded = [p.encode("utf-8", "surrogatepass") for p in phrases]
            sizes = np.fromiter(map(len, coded), np.int64, len(coded))
            data = b"".join(coded)
        ends = np.cumsum(sizes)
        hashes = word_hashes(np.frombuffer(data, np.uint8), ends - sizes, ends)
        np.minimum.at(self.smallest, (hashes % np.uint64(BINS)).astype(np.int64), hashes)

    def signature(self) -> np.ndarray:
        """16 bits of each bin's smallest hash; 0 for an empty bin."""
        empty = self.smallest == np.iinfo(np.uint64).max
        short = (mix(self.smallest) & np.uint64(0xFFFF)).astype(np.uint16)
        return np.where(empty, 0, np.maximum(short, 1)).astype(">u2")


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal bins among those that either has; 1 for two empty signatures."""
    used = (a != 0) | (b != 0)
    return float((a == b)[used].mean()) if used.any() else 1.0


def signature_of(fingerprint: str) -> np.ndarray:
    """The signature behind a fingerprint, to compare fingerprints that were kept."""
    return np.frombuffer(bytes.fromhex(fingerprint), ">u2")


# Rows of a walked range: its first document, its last, and results.
HEAD, INNER, TAIL = 0, 1, 2
ENDS = "kind int, part int, text string"

# Results as they are kept, with hashes in bytes.
KEPT = (
    "doc_id long, n_chars long, edited_sha256 binary, fingerprint binary, "
    "edited_fingerprint binary, near_edited double, near_next double"
)
KINDS = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.float64(), pa.float64())


def fingerprint_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars, fingerprint) of every row; a null text counts as empty."""
    ready(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [x.as_py() or "" for x in batch.column("text")]
            prints = pa.array([Parse().feed(t).signature().tobytes().hex() for t in texts], pa.string())
            arrays = [batch.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()), prints]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_chars", "fingerprint"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_chars long, fingerprint string")


def compare_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, and two likenesses.

    Documents follow each other by descending id, after the last the first again. The
    edited text has the last third of the code points replaced by the first as many
    of the next document. A null text is empty; null ids come last, and rows with
    equal ids by descending hash of the text. A single row is its own next, and an empty
    table gives an empty result. Other columns are ignored, whatever their names.

    Texts are shuffled once, into ranges of id, hash and row, so that many rows without
    an id, with one id, or even of one text are cut over several tasks. A task walks its
    range and lays out the first and the last document of it, whose neighbours are in
    other ranges; these, one pair a range, meet in a second step. ``docs`` should come
    from files or a settled table, as its rows are numbered in the order they are read.
    """
    spark = ready(docs.sparkSession)
    count = max(partitions(spark), text_volume(docs, text_col) // RANGE_BYTES)
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.xxhash64(F.col(text_col)).alias("hash"),
        F.monotonically_increasing_id().alias("row"),
        F.col(text_col).alias("text"),
    )
    order = [F.col("doc_id").desc_nulls_last(), F.col("hash").desc(), F.col("row")]
    ranged = rows.repartitionByRange(count, *order).sortWithinPartitions(*order)
    walked = settle(ranged.select("doc_id", "text").mapInArrow(_walk, f"{ENDS}, {KEPT}"), "walked")
    inner = walked.filter(F.col("kind") == INNER).select(*_names(KEPT))

    heads = walked.filter(F.col("kind") == HEAD).select("part", F.col("text").alias("next_text"))
    tails = walked.filter(F.col("kind") == TAIL).select("part", "doc_id", "text")
    # One narrow row for each range with rows in it: what follows it, the last by the first.
    turns = Window.orderBy("part")
    first = F.min("part").over(turns.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    turn = tails.select("part", F.coalesce(F.lead("part").over(turns), first).alias("following"))
    heads = heads.withColumnRenamed("part", "following")
    pairs = tails.join(turn, "part").join(heads, "following").select("doc_id", "text", "next_text")
    outer = pairs.mapInArrow(_meet, KEPT)
    digest, prints = [F.lower(F.hex("edited_sha256")).alias("edited_sha256")], ("fingerprint", "edited_fingerprint")
    shown = [*digest, *[F.lower(F.hex(c)).alias(c) for c in prints]]
    return inner.unionByName(outer).select("doc_id", "n_chars", *shown, "near_edited", "near_next")


class Held:
    """A document whose next has not come yet."""

    def __init__(self, doc_id: int | None, text: str):
        self.doc_id, self.text = doc_id, text
        kept = len(text) - len(text) // 3
        self.cut = Parse().feed(text[:kept])
        self.signature = self.cut.copy().feed(text[kept:]).signature()

    def row(self, next_text: str, next_signature: np.ndarray) -> tuple:
        third = len(self.text) // 3
        replaced = next_text[:third]
        edited = self.text[: len(self.text) - third] + replaced
        other = self.cut.feed(replaced).signature()
        return (
            self.doc_id,
            len(self.text),
            hashlib.sha256(edited.encode("utf-8", "surrogatepass")).digest(),
            self.signature.tobytes(),
            other.tobytes(),
            likeness(self.signature, other),
            likeness(self.signature, next_signature),
        )


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _batch(rows: list[tuple], kinds: tuple, schema: str) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
    arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, _names(schema))


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Result rows of a sorted range, each document against the next one, and its two ends."""
    part, held = TaskContext.get().partitionId(), None
    nothing = (None,) * (len(KINDS) - 1)
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
            now = Held(doc_id.as_py(), text.as_py() or "")
            if held is None:
                rows.append((HEAD, part, now.text, now.doc_id, *nothing))
            else:
                rows.append((INNER, part, None, *held.row(now.text, now.signature)))
            held = now
        yield _batch(rows, (pa.int32(), pa.int32(), pa.string(), *KINDS), f"{ENDS}, {KEPT}")
    if held is not None:
        end = [(TAIL, part, held.text, held.doc_id, *nothing)]
        yield _batch(end, (pa.int32(), pa.int32(), pa.string(), *KINDS), f"{ENDS}, {KEPT}")


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Result rows of documents that stand beside their next ones."""
    for batch in batches:
        rows = []
        for doc_id, text, following in zip(*batch.columns, strict=True):
            signature = Parse().feed(following.as_py()).signature()
            rows.append(Held(doc_id.as_py(), text.as_py()).row(following.as_py(), signature))
        yield _batch(rows, KINDS, KEPT)
