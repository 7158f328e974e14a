"""Edit-aware token counts.

A document's text is cut into leaves at places where a pre-token begins whatever
stands further left or right: before a single space between two visible characters.
A segment tree over the leaves keeps bytes and tokens of every subtree. An edit
re-encodes the leaves it touches plus the boundary context on both sides, and
updates the sums on the way to the root; the rest of the text is not looked at.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.words import pieces, ready, text_bytes

# Bytes of a leaf, about, and pieces whose counts a worker remembers.
LEAF_BYTES = 512
REMEMBERED = 600_000

# Bytes beyond a cut on which the cut depends: the character before it, and the one behind.
CONTEXT = 2

VISIBLE = np.zeros(256, bool)
VISIBLE[0x21:0x7F] = True
# First bytes of two-byte characters from U+00C0 on, none of which is white space.
LEADS = np.zeros(256, bool)
LEADS[0xC3:0xE0] = True

EDIT = "struct<start:bigint,removed:bigint,inserted:string>"
COUNTED = "doc_id long, n_tokens long, tree binary"
EDITED = (
    "doc_id long, n_tokens long, n_tokens_edited long, n_bytes_encoded long, "
    "n_bytes_edited long, edited_sha256 string, edited string, edited_tree binary"
)
_workers: dict[str, Counter] = {}


class Counter:
    """Counts the tokens of pieces of text with a byte-level vocabulary."""

    def __init__(self, path: str, pattern: str):
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("counted", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.known: dict[bytes, int] = {}

    def counts(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Tokens of each piece."""
        raw = data.tobytes()
        found = [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        if len(self.known) > REMEMBERED:
            self.known = {}
        known = self.known
        for piece in dict.fromkeys(found):
            if piece not in known:
                known[piece] = len(self.encoding.encode_ordinary(piece.decode()))
        return np.fromiter(map(known.__getitem__, found), np.int64, len(found))


def _counter(vocabulary: tuple[str, str]) -> Counter:
    """The counter of this worker process."""
    if vocabulary[0] not in _workers:
        _workers[vocabulary[0]] = Counter(*vocabulary)
    return _workers[vocabulary[0]]


def safe_cuts(data: np.ndarray) -> np.ndarray:
    """Positions of single spaces between visible characters."""
    if len(data) < 3:
        return np.zeros(0, np.int64)
    before = VISIBLE[data[:-2]]
    before[1:] |= LEADS[data[:-3]] & (data[1:-2] >= 0x80)
    behind = VISIBLE[data[2:]] | LEADS[data[2:]]
    return np.flatnonzero((data[1:-1] == 0x20) & before & behind) + 1


class Tree:
    """Sums of bytes and tokens over leaves, the root at 1 and the leaves from ``width`` on."""

    def __init__(self, size: np.ndarray, tokens: np.ndarray):
        self.width = 1 << max(len(size) - 1, 0).bit_length()
        self.size = self._summed(size)
        self.tokens = self._summed(tokens)

    def _summed(self, leaves: np.ndarray) -> np.ndarray:
        sums = np.zeros(2 * self.width, np.int64)
        sums[self.width : self.width + len(leaves)] = leaves
        at = self.width
        while at > 1:
            sums[at // 2 : at] = sums[at : 2 * at].reshape(-1, 2).sum(axis=1)
            at //= 2
        return sums

    @classmethod
    def load(cls, raw: bytes) -> Tree:
        tree = cls.__new__(cls)
        both = np.frombuffer(raw, "<i8").reshape(2, -1).copy()
        tree.size, tree.tokens = both
        tree.width = len(tree.size) // 2
        return tree

    def dump(self) -> bytes:
        return self.size.astype("<i8").tobytes() + self.tokens.astype("<i8").tobytes()

    def leaf_at(self, position: int) -> tuple[int, int]:
        """(leaf, its first byte) of the leaf that holds a byte position."""
        node, start = 1, 0
        while node < self.width:
            node *= 2
            if position >= start + self.size[node] and self.size[node + 1]:
                start += int(self.size[node])
                node += 1
        return node - self.width, start

    def replace(self, first: int, size: np.ndarray, tokens: np.ndarray) -> None:
        """New values for leaves from ``first`` on, and new sums above them."""
        low, high = self.width + first, self.width + first + len(size) - 1
        self.size[low : high + 1], self.tokens[low : high + 1] = size, tokens
        while low > 1:
            low, high = low // 2, high // 2
            for sums in (self.size, self.tokens):
                sums[low : high + 1] = sums[2 * low : 2 * high + 2].reshape(-1, 2).sum(axis=1)


def _cut(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of the pieces of one text between safe cuts."""
    starts = np.r_[0, safe_cuts(data)] if len(data) else np.zeros(0, np.int64)
    return starts, np.r_[starts[1:], len(data)][: len(starts)]


def _leaves(data: np.ndarray, counter: Counter) -> Tree:
    """The tree of a text: a leaf begins at the first cut of each block of bytes."""
    starts, ends = _cut(data)
    if not len(starts):
        return Tree(np.zeros(1, np.int64), np.zeros(1, np.int64))
    counts = counter.counts(data, starts, ends)
    block = starts // LEAF_BYTES
    first = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
    return Tree(np.diff(np.r_[starts[first], len(data)]), np.add.reduceat(counts, first))


def edit(data: np.ndarray, tree: Tree, change: dict, counter: Counter) -> tuple[np.ndarray, int]:
    """The text after one edit, with the tree brought up to date; bytes that were encoded.

    Positions count code points and are moved into the text where they lie outside.
    """
    start, removed = max(change["start"] or 0, 0), max(change["removed"] or 0, 0)
    inserted = np.frombuffer((change["inserted"] or "").encode(), np.uint8)
    points = np.flatnonzero((data & 0xC0) != 0x80)
    points = np.r_[points, len(data)]
    a = int(points[min(start, len(points) - 1)])
    b = int(points[min(start + removed, len(points) - 1)])
    first, low = tree.leaf_at(max(a - CONTEXT, 0))
    last, high = tree.leaf_at(min(b + CONTEXT, max(len(data) - 1, 0)))
    # The leaf behind starts at a cut that depends on the two bytes before it.
    while True:
        end = high + int(tree.size[tree.width + last])
        if end >= min(b + CONTEXT, len(data)) or last + 1 >= tree.width:
            break
        last, high = last + 1, end
    region = np.concatenate([data[low:a], inserted, data[b:end]])
    starts, ends = _cut(region)
    counts = counter.counts(region, starts, ends)
    slots = last - first + 1
    slot = starts * slots // max(len(region), 1)
    size = np.bincount(slot, ends - starts, slots).astype(np.int64)
    tree.replace(first, size, np.bincount(slot, counts, slots).astype(np.int64))
    return np.concatenate([data[:a], inserted, data[b:]]), len(region)


def count_tokens(
    docs: DataFrame, vocabulary: tuple[str, str], id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, n_tokens, tree) of every row; ``vocabulary`` is (file of ranks, pattern).

    A null or empty text has no tokens. Special tokens are ordinary text. Repeated
    rows are counted each; an empty table gives an empty result.
    """
    ready(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(vocabulary)
        for batch in batches:
            for piece in pieces(batch, "text"):
                data, offsets = text_bytes(piece.column("text"))
                bounds = zip(offsets[:-1], offsets[1:], strict=True)
                trees = [_leaves(data[a:b], counter) for a, b in bounds]
                totals = pa.array([int(t.tokens[1]) for t in trees], pa.int64())
                dumps = pa.array([t.dump() for t in trees], pa.binary())
                arrays = [piece.column("doc_id"), totals, dumps]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_tokens", "tree"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, COUNTED)


def recount(rows: DataFrame, vocabulary: tuple[str, str]) -> DataFrame:
    """Counts after the edits of rows (doc_id, text, tree, edits).

    ``edits`` is an array of (start, removed, inserted) in code points, applied one
    after the other; null edits are none. A null tree is built first. Returns the
    counts before and after, the bytes that edits made it encode, the edited text with
    its bytes, its hash and its tree, ready for the next edits.
    """
    ready(rows.sparkSession)
    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.binary()]
    names = [c.split()[0] for c in EDITED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(vocabulary)
        for batch in batches:
            made = []
            columns = [batch.column(c) for c in ("text", "tree", "edits")]
            for text, kept, edits in zip(*columns, strict=True):
                data = np.frombuffer((text.as_py() or "").encode(), np.uint8)
                tree = Tree.load(kept.as_py()) if kept.is_valid else _leaves(data, counter)
                total, encoded = int(tree.tokens[1]), 0
                for change in edits.as_py() or ():
                    if change is not None:
                        data, more = edit(data, tree, change, counter)
                        encoded += more
                raw = data.tobytes()
                digest = hashlib.sha256(raw).hexdigest()
                made.append((total, int(tree.tokens[1]), encoded, len(raw), digest, raw.decode(), tree.dump()))
            columns = list(zip(*made, strict=True)) or [()] * len(kinds)
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], names)

    return rows.select("doc_id", "text", "tree", "edits").mapInArrow(run, EDITED)


def with_trees(docs: DataFrame, vocabulary: tuple[str, str]) -> DataFrame:
    """The rows (doc_id, text, edits, ...) with a ``tree`` built beside each text."""
    ready(docs.sparkSession)
    columns = ["doc_id", "text", "edits"]
    kinds = f"doc_id long, text string, edits array<{EDIT}>, tree binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(vocabulary)
        for batch in batches:
            for piece in pieces(batch, "text"):
                data, offsets = text_bytes(piece.column("text"))
                bounds = zip(offsets[:-1], offsets[1:], strict=True)
                dumps = [_leaves(data[a:b], counter).dump() for a, b in bounds]
                arrays = [*piece.columns, pa.array(dumps, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, [*columns, "tree"])

    picked = docs.select(F.col("doc_id").cast("long"), "text", "edits")
    return picked.mapInArrow(run, kinds)
