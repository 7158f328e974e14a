"""Token files compressed by Re-Pair grammars.

Documents are put in id order, encoded, and cut into shards of whole documents. In a
shard, frequent pairs of ids become nonterminals, round after round; rules, their
expansion lengths and the remaining sequence are stored. No nonterminal reaches past
the end of a document, so any document, and any range of ids in it, is decoded
without the others.

A file row holds one shard. Rows are written by Spark as Parquet part files, which
gives commits, retries and any file system; the bytes of a shard stand on their own.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daybook.llm.words import (
    LOWER,
    SPACE,
    give_back,
    partitions,
    pieces,
    ready,
    text_bytes,
    text_volume,
    word_bounds,
    word_hashes,
)
from daybook.scratch import settle, settled_path

# The id behind every document, ids of a shard, and bytes of text of a file.
END_ID = 1
SHARD_IDS = 1 << 20
FILE_BYTES = 64 << 20

# Rules of a Re-Pair round, and how often a pair must occur to become a rule; rounds
# go on until none does.
ROUND_RULES = 4000
LEAST_COUNT = 24

# Bits of the hash by which pairs are counted and found again.
PAIR_BITS = 18

# Words whose ids a worker remembers, slots of the last ones, and words that one call encodes.
REMEMBERED = 400_000
SLOTS = 1 << 20
ENCODED_AT_ONCE = 1000

MAGIC = b"RPG1"
SHARDS = "part int, shard int, doc_ids array<bigint>, lengths array<bigint>, n_ids long, data binary"

# ASCII signs; an apostrophe is none here, as it may begin the tokenizer's contractions.
_SIGN = np.zeros(256, bool)
_SIGN[0x21:0x30] = _SIGN[0x3A:0x41] = _SIGN[0x5B:0x61] = _SIGN[0x7B:0x7F] = True
_SIGN[0x27] = False

# A word of small Latin letters: one pre-token, whose normal form is itself.
PLAIN = re.compile("[a-zß-öø-ÿ]+")
_workers: dict[str, WordEncoder] = {}


class WordEncoder:
    """Encodes texts word by word with a tokenizer that never joins words.

    White space ends a word for this tokenizer, and so does a letter before signs that
    end a word, so the ids of a text are those of its words and signs. Each distinct
    one is encoded once while it is remembered, found again by its hash. Capitals are lowered first, as the
    tokenizer does, except where a text may spell a special token.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        # How a byte-level vocabulary writes letters beyond ASCII.
        level = ByteLevel(add_prefix_space=False, use_regex=False)
        self.letters = {c: level.pre_tokenize_str(chr(c))[0][0] for c in range(0xC0, 0x100)}
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.flat = np.zeros(1 << 16, np.uint32)
        self.ends = np.zeros((1 << 14) + 1, np.int64)
        # The last word seen in each slot of hashes, which spares most look-ups.
        self.slot_hash = np.zeros(SLOTS, np.uint64)
        self.slot_code = np.full(SLOTS, -1, np.int64)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, number of ids of each text)."""
        if len(self.known) > REMEMBERED:
            self._forget()
        data, starts, ends, bounds = _split(*text_bytes(texts))
        hashes = word_hashes(data, starts, ends)
        slots = (hashes & np.uint64(SLOTS - 1)).astype(np.int64)
        codes = np.where(self.slot_hash[slots] == hashes, self.slot_code[slots], -1)
        missing = np.flatnonzero(codes < 0)
        if len(missing):
            distinct, first, place = np.unique(hashes[missing], return_index=True, return_inverse=True)
            raw = data.tobytes()
            at = missing[first]
            words = [raw[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist(), strict=True)]
            self._learn([w for w in words if w not in self.known])
            found = np.array([self.known[w] for w in words], np.int64)
            codes[missing] = found[place]
            self.slot_hash[slots[at]], self.slot_code[slots[at]] = distinct, found
        begins = self.ends[codes]
        sizes = self.ends[codes + 1] - begins
        before = np.r_[0, np.cumsum(sizes)]
        steps = np.arange(before[-1], dtype=np.int32)
        ids = self.flat[np.repeat((begins - before[:-1]).astype(np.int32), sizes) + steps]
        return ids, np.diff(before[bounds])

    def _learn(self, words: list[bytes]) -> None:
        """Encode words that are not known yet and remember their ids.

        Words of small Latin letters go straight to the model, which is faster; others
        are encoded as one text and told apart by where their tokens begin.
        """
        plain, others = [], []
        for word in words:
            text = word.decode().lower()
            if PLAIN.fullmatch(text):
                plain.append((word, text if text.isascii() else text.translate(self.letters)))
            else:
                others.append(word)
        found = [[token.id for token in self.model.tokenize(text)] for _, text in plain]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        self._remember([word for word, _ in plain], [x for ids in found for x in ids], sizes)
        for at in range(0, len(others), ENCODED_AT_ONCE):
            part = others[at : at + ENCODED_AT_ONCE]
            texts = [word.decode() for word in part]
            made = self.tokenizer.encode(" ".join(texts), add_special_tokens=False)
            starts = np.cumsum([0] + [len(t) + 1 for t in texts])
            begins = np.array([a for a, _ in made.offsets], np.int64)
            word = np.searchsorted(starts, begins, "right") - 1
            self._remember(part, made.ids, np.bincount(word, minlength=len(part)))

    def _remember(self, words: list[bytes], ids: list[int], sizes: np.ndarray) -> None:
        if not words:
            return
        first = len(self.known)
        ends = int(self.ends[first]) + np.cumsum(sizes)
        while len(self.flat) < ends[-1]:
            self.flat = np.r_[self.flat, np.zeros_like(self.flat)]
        while len(self.ends) < first + len(words) + 1:
            self.ends = np.r_[self.ends, np.zeros_like(self.ends)]
        self.flat[self.ends[first] : ends[-1]] = ids
        self.ends[first + 1 : first + len(words) + 1] = ends
        self.known.update(zip(words, range(first, first + len(words)), strict=True))


def _split(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """The texts in small letters, (start, end) of their words, and each text's first word."""
    edges = offsets
    if b"<|" not in data.tobytes():
        data = LOWER[data]
        sign = _SIGN[data]
        letter = (data >= 0x61) & (data <= 0x7A)
        # The second byte of a letter from U+00C0 to U+00FF; two signs lie among these.
        letter[1:] |= (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)
        begins = sign.copy()
        begins[1:] &= letter[:-1]
        begins[:1] = False
        begins[offsets[:-1][offsets[:-1] < len(data)]] = False
        at = np.flatnonzero(begins)
        # Where the signs behind a letter end: at white space, or with the text.
        others = np.r_[np.flatnonzero(~sign), len(data)]
        ends = others[np.searchsorted(others, at)]
        last = offsets[np.searchsorted(offsets, at, "right")]
        white = np.r_[SPACE[data], True]
        edges = np.sort(np.concatenate([offsets, at[(ends >= last) | white[ends]]]))
    starts, ends, _ = word_bounds(data, edges)
    return data, starts, ends, np.searchsorted(starts, offsets)


def _encoder(path: str) -> WordEncoder:
    """The encoder of this worker process."""
    if path not in _workers:
        _workers[path] = WordEncoder(path)
    return _workers[path]


def compress(ids: np.ndarray) -> bytes:
    """A shard's ids as a grammar. Documents end with ``END_ID``; no rule crosses that."""
    ids = ids.astype(np.uint32)
    first_rule = int(ids.max(initial=END_ID)) + 1
    closed = np.zeros(first_rule, bool)
    closed[END_ID] = True
    rules = np.zeros((0, 2), np.uint32)
    sequence = ids
    # The most frequent pair is replaced at least once a round, so rounds end.
    while len(at := _candidates(sequence, closed)):
        left, right = sequence[at], sequence[at + 1]
        pairs = _frequent(left, right)
        if not len(pairs):
            break
        sequence, pairs = _replaced(sequence, at, left, right, pairs, first_rule + len(rules))
        closed = np.concatenate([closed, closed[pairs[:, 1]]])
        rules = np.concatenate([rules, pairs])
    lengths = np.ones(first_rule + len(rules), np.int64)
    for k, (a, b) in enumerate(rules.tolist()):
        lengths[first_rule + k] = lengths[a] + lengths[b]
    width = "<u2" if first_rule + len(rules) <= 1 << 16 else "<u4"
    head = np.array([first_rule, len(rules), len(sequence), int(width[-1])], "<i8")
    parts = (head, rules.astype("<u4"), lengths[first_rule:].astype("<u4"), sequence.astype(width))
    return MAGIC + b"".join(p.tobytes() for p in parts)


def _hashed(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    mixed = (left * np.uint32(2654435761)) ^ (right * np.uint32(2246822519))
    return ((mixed ^ (mixed >> np.uint32(15))) * np.uint32(739982445)) >> np.uint32(32 - PAIR_BITS)


def _candidates(sequence: np.ndarray, closed: np.ndarray) -> np.ndarray:
    """Where pairs inside documents stand that may be frequent, counted by hash without sorting."""
    left, right = sequence[:-1], sequence[1:]
    places = _hashed(left, right).astype(np.intp)
    often = np.bincount(places, minlength=1 << PAIR_BITS) >= LEAST_COUNT
    at = np.flatnonzero(often.take(places))
    return at[~closed.take(sequence.take(at))]


def _frequent(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The most frequent of some pairs, the most frequent first."""
    ranked = np.sort(left.astype(np.uint64) << np.uint64(32) | right)
    first = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]][: len(ranked)])
    counts = np.diff(np.r_[first, len(ranked)])
    often = np.flatnonzero(counts >= LEAST_COUNT)
    best = often[np.lexsort((ranked[first[often]], -counts[often]))[:ROUND_RULES]]
    keys = ranked[first[best]]
    return np.stack([keys >> np.uint64(32), keys & np.uint64(0xFFFFFFFF)], axis=1).astype(np.uint32)


def _replaced(
    sequence: np.ndarray, at: np.ndarray, left: np.ndarray, right: np.ndarray, pairs: np.ndarray, fresh: int
) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, pairs used), pairs replaced where the more frequent neighbours leave room."""
    slots = np.full(1 << PAIR_BITS, -1, np.int16)
    # Where two pairs share a slot, the more frequent has it in this round.
    slots[_hashed(pairs[::-1, 0], pairs[::-1, 1])] = np.arange(len(pairs))[::-1]
    rank = slots[_hashed(left, right)]
    some = np.flatnonzero(rank >= 0)
    rank = rank[some].astype(np.int64)
    real = (pairs[rank, 0] == left[some]) & (pairs[rank, 1] == right[some])
    at, rank = at[some[real]], rank[real]
    # In a run of one symbol every second hit counts.
    alike = np.r_[False, (at[1:] == at[:-1] + 1) & (rank[1:] == rank[:-1])][: len(at)]
    begins = np.maximum.accumulate(np.where(alike, 0, np.arange(len(at))))
    every_second = (np.arange(len(at)) - begins) % 2 == 0
    at, rank = at[every_second], rank[every_second]
    # A run of overlapping hits is settled by rank.
    before = np.r_[False, at[1:] == at[:-1] + 1][: len(at)]
    after = np.r_[before[1:], False][: len(at)]
    wins = ~before | (rank < np.r_[0, rank[:-1]][: len(at)])
    wins &= ~after | (rank <= np.r_[rank[1:], 0][: len(at)])
    at, rank = at[wins], rank[wins]
    used = np.zeros(len(pairs), bool)
    used[rank] = True
    out = sequence.copy()
    out[at] = fresh + (np.cumsum(used) - 1)[rank]
    keep = np.ones(len(sequence), bool)
    keep[at + 1] = False
    return out[keep], pairs[used]


class Shard:
    """Random access to the ids of a compressed shard."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a shard")
        self.first_rule, n_rules, n_sequence, width = np.frombuffer(data, "<i8", 4, 4).tolist()
        at = 4 + 32
        self.rules = np.frombuffer(data, "<u4", 2 * n_rules, at).reshape(-1, 2)
        self.lengths = np.frombuffer(data, "<u4", n_rules, at + 8 * n_rules)
        self.sequence = np.frombuffer(data, f"<u{width}", n_sequence, at + 12 * n_rules)
        symbols = self.sequence.astype(np.int64)
        rule = symbols >= self.first_rule
        sizes = np.ones(len(symbols), np.int64)
        sizes[rule] = self.lengths[symbols[rule] - self.first_rule]
        self.ends = np.cumsum(sizes)
        self.places: np.ndarray | None = None

    def ids(self, start: int = 0, stop: int | None = None) -> np.ndarray:
        """The ids from ``start`` to ``stop``; only symbols that reach into them are expanded."""
        stop = (int(self.ends[-1]) if len(self.ends) else 0) if stop is None else stop
        if stop <= start:
            return np.zeros(0, np.uint32)
        a = int(np.searchsorted(self.ends, start, "right"))
        b = int(np.searchsorted(self.ends, stop, "left")) + 1
        skipped = int(self.ends[a - 1]) if a else 0
        symbols = self.sequence[a:b].astype(np.int64)
        sizes = np.diff(self.ends[a:b], prepend=skipped)
        at = self._places()[symbols]
        before = np.cumsum(sizes) - sizes
        out = self.pool[np.repeat(at - before, sizes) + np.arange(int(sizes.sum()))]
        return out[start - skipped : stop - skipped]

    def _places(self) -> np.ndarray:
        """Where each symbol's expansion begins in ``pool``, which holds them one by one."""
        if self.places is None:
            expanded = [self.first_rule + np.cumsum(self.lengths, dtype=np.int64) - self.lengths]
            self.places = np.concatenate([np.arange(self.first_rule), *expanded]).astype(np.int64)
            size = self.first_rule + int(self.lengths.sum())
            self.pool = np.arange(size, dtype=np.uint32)
            places, pool = self.places.tolist(), self.pool
            whole = [1] * self.first_rule + self.lengths.tolist()
            for k, (left, right) in enumerate(self.rules.tolist(), self.first_rule):
                at, cut = places[k], places[k] + whole[left]
                pool[at:cut] = pool[places[left] : places[left] + whole[left]]
                pool[cut : at + whole[k]] = pool[places[right] : places[right] + whole[right]]
        return self.places


def write_tokens(
    docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text"
) -> None:
    """Write the ids of all texts, in ascending id order, to a folder of shards.

    A null text is empty and has the end id only. Null ids come last; rows with equal
    ids are ordered by the hash of the text. An empty table gives an empty folder.
    ``tokenizer`` is the path of a vocabulary file that every machine has.
    """
    spark = ready(docs.sparkSession)
    count = max(partitions(spark), text_volume(docs, text_col) // FILE_BYTES)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text")]
    rows = rows.repartitionByRange(count, *order).sortWithinPartitions(*order)
    rows = rows.select(F.spark_partition_id().alias("part"), "doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        held: list[tuple] = []
        size, shard, part = 0, 0, 0
        for batch in batches:
            for piece in pieces(batch, "text"):
                part = piece.column("part")[0].as_py()
                ids, counts = encoder.encode(piece.column("text"))
                ends = np.cumsum(counts)
                closed = np.insert(ids, ends, END_ID).astype(np.uint32)
                held.append((piece.column("doc_id"), counts + 1, closed))
                size += len(closed)
                if size >= SHARD_IDS:
                    yield _shard_row(part, shard, held)
                    held, size, shard = [], 0, shard + 1
        if held:
            yield _shard_row(part, shard, held)
        held.clear()
        give_back()

    rows.mapInArrow(run, SHARDS).write.parquet(path)


def _shard_row(part: int, shard: int, held: list[tuple]) -> pa.RecordBatch:
    doc_ids = pa.concat_arrays([h[0] for h in held])
    lengths = np.concatenate([h[1] for h in held])
    ids = np.concatenate([h[2] for h in held])
    edges = pa.array([0, len(doc_ids)], pa.int32())
    arrays = [
        pa.array([part], pa.int32()),
        pa.array([shard], pa.int32()),
        pa.ListArray.from_arrays(edges, doc_ids.cast(pa.int64())),
        pa.ListArray.from_arrays(edges, pa.array(lengths, pa.int64())),
        pa.array([len(ids)], pa.int64()),
        pa.array([compress(ids)], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in SHARDS.split(", ")])


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document, from the files alone.

    ``start`` counts the ids of all documents before. Shard totals, one small row each,
    are summed in their order.
    """
    ready(spark)
    shards = spark.read.schema(SHARDS).parquet(path)
    within = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    parts = shards.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inner = shards.select("part", "shard", F.coalesce(F.sum("n_ids").over(within), F.lit(0)).alias("inner"))
    bases = inner.join(parts, "part").select("part", "shard", (F.col("base") + F.col("inner")).alias("base"))
    bases = settle(bases, "bases")
    rows = shards.join(bases, ["part", "shard"]).select("base", "doc_ids", "lengths", "data")
    return rows.mapInArrow(_documents, "doc_id long, start long, n_tokens long, ids binary")


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every document of every shard, its ids as little-endian 32-bit integers."""
    names = ["doc_id", "start", "n_tokens", "ids"]
    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1)
            lengths = row.column("lengths").flatten().to_numpy()
            ends = np.cumsum(lengths)
            ids = Shard(row.column("data")[0].as_py()).ids().astype("<u4")
            own = [ids[a:b].tobytes() for a, b in zip(ends - lengths, ends, strict=True)]
            starts = pa.array(row.column("base")[0].as_py() + ends - lengths, pa.int64())
            arrays = [row.column("doc_ids").flatten(), starts, pa.array(lengths, pa.int64())]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(own, pa.binary())], names)
    give_back()


def packed(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write the token files of ``docs`` to the shared folder and read them back."""
    spark = docs.sparkSession
    path = settled_path(spark, "tokens")
    write_tokens(docs, path, tokenizer)
    return read_tokens(spark, path)
