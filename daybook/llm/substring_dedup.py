"""Substring dedup by fixed-block anchors.

Two texts that share a window of 13 words share a whole block of 7 words that
starts at a multiple of 7 in one of them. So the blocks of every document that
do not overlap are the index, and every rolling window of 7 words probes it. What
is hit is extended: the 13-word windows around a hit are compared by a 128-bit
hash, and windows that touch merge into maximal repeats.

Documents travel in packed batches, and batches talk to index buckets in packed
arrays. A batch names each hash once, however often its documents hold it, and a
bucket answers with one bit for it, so a passage in a third of all documents costs
one entry a batch and no pairs are ever formed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.words import (
    inside_one_text,
    partitions,
    ranges,
    ready,
    text_bytes,
    text_volume,
    window_hashes,
    word_bounds,
    word_hashes,
)

# Bytes of text in a packed batch, and bytes of text behind one index bucket.
PACK_BYTES = 4 << 20
BUCKET_BYTES = 16 << 20

LAST = np.iinfo(np.int64).max

PACKED = "batch_id long, ids array<bigint>, texts array<string>"
ENTRIES = "bucket int, batch_id long, stage int, payload binary"
REPLIES = "batch_id long, stage int, bucket int, bits binary"
REPEATS = (
    "doc_id long, n_words long, n_removed long, "
    "spans array<struct<first_word:bigint,past_last_word:bigint>>, kept string"
)


def repeated_passages(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 13
) -> DataFrame:
    """Every document without the words it repeats from documents with smaller ids.

    A word goes if some window of ``window`` consecutive words that covers it also
    starts in a document with a smaller id; windows are judged on the input. Returns
    doc_id, n_words, n_removed, spans (maximal removed runs, from word to past the
    last word) and kept (the other words, joined by one space), one row per row.

    A null text has no words. A null id counts as larger than all others. Rows with
    equal ids do not remove each other's words. Texts shorter than a window stay.
    An empty table gives an empty result; other columns are ignored.
    """
    spark = ready(docs.sparkSession)
    block = (window + 1) // 2
    n = partitions(spark)
    buckets = max(n, text_volume(docs, text_col) // BUCKET_BYTES)
    picked = docs.select(
        (F.spark_partition_id().cast("long") * (1 << 32)).alias("batch_id"),
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).alias("text"),
    )
    packed = picked.mapInArrow(_pack, PACKED).repartition(n, "batch_id")

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                yield Batch(batch.slice(row, 1), window, block, buckets).anchors()

    def extensions(key, left: pa.Table, right: pa.Table) -> pa.Table:
        made = [Batch(b, window, block, buckets).extensions(right) for b in _single(left)]
        return pa.Table.from_batches(made, schema=_schema(ENTRIES))

    def repeats(key, left: pa.Table, right: pa.Table) -> pa.Table:
        made = [Batch(b, window, block, buckets).repeats(right) for b in _single(left)]
        return pa.Table.from_batches(made, schema=_schema(REPEATS))

    hits = packed.mapInArrow(anchors, ENTRIES).groupBy("bucket").applyInArrow(_anchor_hits, REPLIES)
    own = packed.groupBy("batch_id")
    found = own.cogroup(hits.groupBy("batch_id")).applyInArrow(extensions, ENTRIES)
    earlier = found.groupBy("bucket").applyInArrow(_earlier, REPLIES)
    replies = hits.unionByName(earlier)
    return own.cogroup(replies.groupBy("batch_id")).applyInArrow(repeats, REPEATS)


class Batch:
    """The windows of a packed batch, computed anew wherever the batch arrives."""

    def __init__(self, row: pa.RecordBatch, window: int, block: int, buckets: int):
        self.batch_id = row.column("batch_id")[0].as_py()
        ids = row.column("ids").flatten()
        self.ids = ids
        self.order = ids.fill_null(LAST).to_numpy()
        self.texts = row.column("texts").flatten()
        self.window, self.block, self.buckets = window, block, buckets
        self.data, self.offsets = text_bytes(self.texts)
        self.starts, self.ends, self.bounds = word_bounds(self.data, self.offsets)
        self.hashes = word_hashes(self.data, self.starts, self.ends)

    def doc_of(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.bounds, positions, "right") - 1

    def block_keys(self) -> tuple[np.ndarray, ...]:
        """Distinct (bucket, hash) keys of the rolling blocks, and what refers to them."""
        at = np.flatnonzero(inside_one_text(self.bounds, self.block))
        rolled = window_hashes(self.hashes, self.block)[at]
        bucket = (rolled >> np.uint64(32)) % np.uint64(self.buckets)
        keys = (bucket << np.uint64(32)) | (rolled & np.uint64(0xFFFFFFFF))
        order = np.argsort(keys)
        ranked = keys[order]
        first = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]][: len(ranked)])
        return at, order, ranked, first

    def anchors(self) -> pa.RecordBatch:
        """Each distinct block hash with two flags: stands at a block, stands in two texts."""
        at, order, ranked, first = self.block_keys()
        if not len(at):
            return _entries([], self.batch_id, 1, [])
        doc = self.doc_of(at)
        aligned = ((at - self.bounds[doc]) % self.block == 0)[order]
        doc = doc[order]
        aligned = np.logical_or.reduceat(aligned, first)
        several = np.minimum.reduceat(doc, first) != np.maximum.reduceat(doc, first)
        keys = ranked[first]
        parts = _by_bucket(keys >> np.uint64(32))
        low = keys.astype(np.uint32)
        payloads = [
            _join(low[a:b], np.packbits(aligned[a:b]), np.packbits(several[a:b])) for _, a, b in parts
        ]
        return _entries([k for k, _, _ in parts], self.batch_id, 1, payloads)

    def candidates(self, replies: pa.Table) -> np.ndarray:
        """Windows that hold a block which another text holds too."""
        at, order, ranked, first = self.block_keys()
        count = max(0, len(self.hashes) - self.window + 1)
        if not len(at) or not count:
            return np.zeros(0, np.int64)
        hit = _bits(replies, 1, _by_bucket(ranked[first] >> np.uint64(32)))
        shared = np.zeros(len(self.hashes) + 1, np.int64)
        spread = np.repeat(hit, np.diff(np.r_[first, len(ranked)]))
        shared[at[order[spread]] + 1] = 1
        shared = np.cumsum(shared)
        inner = self.window - self.block + 1
        held = shared[inner : inner + count] - shared[:count]
        return np.flatnonzero(inside_one_text(self.bounds, self.window) & (held > 0))

    def window_keys(self, replies: pa.Table) -> tuple[np.ndarray, ...]:
        """Candidate windows in the order of their hashes, and where equal ones begin."""
        at = self.candidates(replies)
        high = window_hashes(self.hashes, self.window, 2)[at]
        low = window_hashes(self.hashes, self.window, 3)[at]
        bucket = (high >> np.uint64(32)) % np.uint64(self.buckets)
        order = np.lexsort((low, high, bucket))
        high, low, bucket = high[order], low[order], bucket[order]
        fresh = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
        first = np.flatnonzero(np.r_[True, fresh][: len(high)])
        return at[order], high, low, bucket, first

    def extensions(self, replies: pa.Table) -> pa.RecordBatch:
        """Each distinct candidate window with the smallest id of this batch that has it."""
        at, high, low, bucket, first = self.window_keys(replies)
        if not len(at):
            return _entries([], self.batch_id, 2, [])
        least = np.minimum.reduceat(self.order[self.doc_of(at)], first)
        high, low = high[first], low[first]
        parts = _by_bucket(bucket[first])
        payloads = [_join(high[a:b], low[a:b], least[a:b]) for _, a, b in parts]
        return _entries([k for k, _, _ in parts], self.batch_id, 2, payloads)

    def repeats(self, replies: pa.Table) -> pa.RecordBatch:
        """The result rows of this batch."""
        at, _, _, bucket, first = self.window_keys(replies)
        gone = np.zeros(len(self.hashes) + 1, np.int64)
        if len(at):
            earlier = _bits(replies, 2, _by_bucket(bucket[first]))
            ids = self.order[self.doc_of(at)]
            sizes = np.diff(np.r_[first, len(at)])
            least = np.repeat(np.minimum.reduceat(ids, first), sizes)
            covered = at[np.repeat(earlier, sizes) | (ids > least)]
            np.add.at(gone, covered, 1)
            np.add.at(gone, covered + self.window, -1)
        gone = np.cumsum(gone)[:-1] > 0
        rows = []
        for doc in range(len(self.texts)):
            a, b = int(self.bounds[doc]), int(self.bounds[doc + 1])
            words = self.data[self.offsets[doc] : self.offsets[doc + 1]].tobytes().split()
            lost = np.flatnonzero(gone[a:b])
            spans = list(zip(*(x.tolist() for x in ranges(lost, lost + 1)), strict=True))
            if len(lost):
                words = [words[k] for k in np.flatnonzero(~gone[a:b])]
            spans = [{"first_word": s, "past_last_word": e} for s, e in _touching(spans)]
            rows.append((b - a, len(lost), spans, b" ".join(words)))
        columns = list(zip(*rows, strict=True)) or [(), (), (), ()]
        schema = _schema(REPEATS)
        arrays = [self.ids.cast(pa.int64())]
        arrays += [pa.array(c, f.type) for c, f in zip(columns, list(schema)[1:], strict=True)]
        return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _touching(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges with those that touch made one."""
    merged: list[tuple[int, int]] = []
    for start, end in spans:
        if merged and merged[-1][1] == start:
            merged[-1] = (merged[-1][0], end)
        else:
            merged.append((start, end))
    return merged


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packs the rows of one partition into batches of about PACK_BYTES of text."""
    held, size, count, base = [], 0, 0, 0
    for batch in batches:
        base = batch.column("batch_id")[0].as_py() if batch.num_rows else base
        _, offsets = text_bytes(batch.column("text"))
        first = 0
        while first < batch.num_rows:
            room = max(PACK_BYTES - size, 0)
            last = int(np.searchsorted(offsets, offsets[first] + room, "right")) - 1
            last = min(max(last, first + (not held)), batch.num_rows)
            if last > first:
                held.append(batch.slice(first, last - first))
                size += int(offsets[last] - offsets[first])
            if last < batch.num_rows:
                yield _packed(held, base + count)
                held, size, count = [], 0, count + 1
            first = last
    if held:
        yield _packed(held, base + count)


def _packed(held: list[pa.RecordBatch], batch_id: int) -> pa.RecordBatch:
    table = pa.Table.from_batches(held).combine_chunks()
    schema = _schema(PACKED)
    arrays = [pa.array([batch_id], pa.int64())]
    for name, field in (("doc_id", "ids"), ("text", "texts")):
        values = table.column(name).combine_chunks()
        values = values.chunk(0) if isinstance(values, pa.ChunkedArray) else values
        kind = schema.field(field).type
        arrays.append(pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values).cast(kind))
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _schema(ddl: str) -> pa.Schema:
    """The Arrow schema of the few column types used here."""
    kinds = {
        "long": pa.int64(),
        "int": pa.int32(),
        "binary": pa.binary(),
        "string": pa.string(),
        "array<bigint>": pa.list_(pa.int64()),
        "array<string>": pa.list_(pa.string()),
        "array<struct<first_word:bigint,past_last_word:bigint>>": pa.list_(
            pa.struct([("first_word", pa.int64()), ("past_last_word", pa.int64())])
        ),
    }
    return pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in ddl.split(", ")])


def _single(table: pa.Table) -> Iterator[pa.RecordBatch]:
    for batch in table.to_batches():
        for row in range(batch.num_rows):
            yield batch.slice(row, 1)


def _by_bucket(buckets: np.ndarray) -> list[tuple[int, int, int]]:
    """(bucket, from, to) of the runs in a sorted array."""
    if not len(buckets):
        return []
    first = np.flatnonzero(np.r_[True, buckets[1:] != buckets[:-1]])
    last = np.r_[first[1:], len(buckets)]
    return [(int(k), int(a), int(b)) for k, a, b in zip(buckets[first], first, last, strict=True)]


def _entries(buckets: list, batch_id: int, stage: int, payloads: list) -> pa.RecordBatch:
    n = len(buckets)
    arrays = [
        pa.array(buckets, pa.int32()),
        pa.array([batch_id] * n, pa.int64()),
        pa.array([stage] * n, pa.int32()),
        pa.array(payloads, pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=_schema(ENTRIES))


def _join(*arrays: np.ndarray) -> bytes:
    """Arrays as bytes behind the length of the first."""
    head = np.array([len(arrays[0])], np.int64).tobytes()
    return head + b"".join(a.tobytes() for a in arrays)


def _bits(replies: pa.Table, stage: int, parts: list[tuple[int, int, int]]) -> np.ndarray:
    """The answers of all buckets, in the order in which they were asked."""
    rows = zip(
        replies.column("stage").to_pylist(),
        replies.column("bucket").to_pylist(),
        replies.column("bits").to_pylist(),
        strict=True,
    )
    by_bucket = {bucket: bits for at, bucket, bits in rows if at == stage}
    answers = [
        np.unpackbits(np.frombuffer(by_bucket[bucket], np.uint8), count=b - a) for bucket, a, b in parts
    ]
    return np.concatenate([np.zeros(0, np.uint8), *answers]).astype(bool)


def _replies(table: pa.Table, stage: int, counts: list[int], hit: np.ndarray) -> pa.Table:
    ends = np.cumsum([0, *counts])
    bits = [np.packbits(hit[a:b]).tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)]
    n = len(counts)
    return pa.table(
        {
            "batch_id": table.column("batch_id").combine_chunks(),
            "stage": pa.array([stage] * n, pa.int32()),
            "bucket": table.column("bucket").combine_chunks(),
            "bits": pa.array(bits, pa.binary()),
        }
    )


def _anchor_hits(table: pa.Table) -> pa.Table:
    """Which block hashes stand at an index block and in two documents at least."""
    counts, hashes, aligned, several = [], [], [], []
    for payload in table.column("payload"):
        raw = payload.as_buffer()
        n = int(np.frombuffer(raw, np.int64, 1)[0])
        size = (n + 7) // 8
        counts.append(n)
        hashes.append(np.frombuffer(raw, np.uint32, n, 8))
        flags = np.frombuffer(raw, np.uint8, 2 * size, 8 + 4 * n)
        aligned.append(np.unpackbits(flags[:size], count=n))
        several.append(np.unpackbits(flags[size:], count=n))
    hashes = np.concatenate(hashes)
    order = np.argsort(hashes)
    ranked = hashes[order]
    first = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
    sizes = np.diff(np.r_[first, len(ranked)])
    shared = (sizes > 1) | (np.maximum.reduceat(np.concatenate(several)[order], first) > 0)
    shared &= np.maximum.reduceat(np.concatenate(aligned)[order], first) > 0
    hit = np.empty(len(hashes), bool)
    hit[order] = np.repeat(shared, sizes)
    return _replies(table, 1, counts, hit)


def _earlier(table: pa.Table) -> pa.Table:
    """For which windows some other batch has a document with a smaller id."""
    counts, high, low, ids = [], [], [], []
    for payload in table.column("payload"):
        raw = payload.as_buffer()
        n = int(np.frombuffer(raw, np.int64, 1)[0])
        counts.append(n)
        high.append(np.frombuffer(raw, np.uint64, n, 8))
        low.append(np.frombuffer(raw, np.uint64, n, 8 + 8 * n))
        ids.append(np.frombuffer(raw, np.int64, n, 8 + 16 * n))
    high, low, ids = np.concatenate(high), np.concatenate(low), np.concatenate(ids)
    order = np.lexsort((low, high))
    a, b = high[order], low[order]
    first = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
    least = np.repeat(np.minimum.reduceat(ids[order], first), np.diff(np.r_[first, len(a)]))
    hit = np.empty(len(ids), bool)
    hit[order] = least < ids[order]
    return _replies(table, 2, counts, hit)
