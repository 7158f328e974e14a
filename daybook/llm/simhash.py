"""SimHash near-dedup by deletion-variant signatures.

For at most k differing bits a fingerprint is cut into k // 2 + 1 segments, so in
two linked fingerprints some segment differs by one bit at most. Every segment is
indexed once for each of its bits with that bit left out: two segments that differ
by at most one bit share such a variant. Rows with an equal variant meet in an
equality grouping, and the whole fingerprints are compared there.

Only distinct fingerprints take part, so copies of a text cost nothing. Inside a
group a spanning forest of the links is emitted, never all pairs, and a group of
many fingerprints is cut into chunks whose pairs meet in different tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.components import connected
from daybook.llm.words import LOWER, give_back, partitions, pieces, ready, text_bytes, word_bounds
from daybook.scratch import settle

BITS = 64
SEED = 42

# Fingerprints of one group in one task; a larger group is cut into chunks.
GROUP_LIMIT = 8192

# Up to this size a group's links are found by comparing neighbours at all distances.
SMALL_GROUP = 32

# Shingles hashed at a time.
SHINGLES = 1 << 16


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 4,
    max_bits: int = 4,
) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row.

    Fingerprints of word shingles link at ``max_bits`` or fewer differing bits, and
    component_id is the smallest id reachable over links, the row's own included.
    A text without words, or null, has fingerprint zero, which links like any other.
    Rows with equal ids are rows of one document, which links all their fingerprints. A
    row without an id takes the
    component of the rows with its fingerprint, or null if none of them has an id.
    An empty table gives an empty result; other columns are ignored.
    """
    ready(docs.sparkSession)
    prints = settle(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    nodes = prints.groupBy("print").agg(F.min("doc_id").alias("node"))
    nodes = settle(nodes.filter("node IS NOT NULL"), "nodes")
    groups = connected(_links(nodes, max_bits).unionByName(_bridges(prints, nodes)))
    known = nodes.join(groups, "node", "left").select(
        "print", F.coalesce("component", "node").alias("component_id")
    )
    return prints.join(known, "print", "left").select(
        "doc_id", F.lower(F.lpad(F.hex("print"), BITS // 4, "0")).alias("fingerprint"), "component_id"
    )


def _bridges(prints: DataFrame, nodes: DataFrame) -> DataFrame:
    """(a, b): the nodes of fingerprints that rows of one id have, linked to the least of them."""
    several = prints.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.min("print").alias("low"), F.max("print").alias("high")
    )
    several = settle(several.filter("low <> high").select("doc_id"), "several")
    held = prints.join(several, "doc_id").join(nodes, "print").select("doc_id", "node").distinct()
    least = held.groupBy("doc_id").agg(F.min("node").alias("a"))
    return held.join(least, "doc_id").filter("a < node").select("a", F.col("node").alias("b"))


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(doc_id, print): a 64-bit SimHash of each text's word shingles, as a long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                values = [_fingerprint(*one, shingle) for one in _lowered(piece.column("text"))]
                prints = pa.array(np.array(values, np.uint64).view(np.int64))
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), prints], ["doc_id", "print"])
        give_back()

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return picked.mapInArrow(run, "doc_id long, print long")


def _lowered(texts: pa.Array) -> Iterator[tuple[bytes, np.ndarray]]:
    """Each text's words in lower case joined by one space, and the words' lengths."""
    data, offsets = text_bytes(texts)
    data = LOWER[data]
    starts, ends, bounds = word_bounds(data, offsets)
    lengths = ends - starts
    for k in range(len(texts)):
        joined = b" ".join(data[offsets[k] : offsets[k + 1]].tobytes().split())
        yield joined, lengths[bounds[k] : bounds[k + 1]]


def _fingerprint(joined: bytes, lengths: np.ndarray, shingle: int) -> int:
    """Bits that are set in over half of the hashes of all shingles."""
    if not len(lengths):
        return 0
    width = min(shingle, len(lengths))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(lengths) - width + 1]
    ends = ends[width - 1 :]
    counts = np.zeros(BITS, np.int64)
    for k in range(0, len(starts), SHINGLES):
        spans = zip(starts[k : k + SHINGLES].tolist(), ends[k : k + SHINGLES].tolist(), strict=True)
        hashes = np.array([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in spans], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    majority = np.packbits(2 * counts > len(starts), bitorder="little")
    return int(majority.view("<u8")[0])


def segments(max_bits: int) -> list[tuple[int, int]]:
    """(first bit, number of bits) of the segments of which one differs by one bit at most."""
    count = max_bits // 2 + 1
    cuts = [BITS * k // count for k in range(count + 1)]
    return [(a, b - a) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _variants(max_bits: int):
    """An array of keys: each segment without one of its bits, tagged with that bit."""
    keys = []
    for first, size in segments(max_bits):
        segment = F.shiftrightunsigned("print", first).bitwiseAND(F.lit((1 << size) - 1))
        for bit in range(size):
            left_out = segment.bitwiseAND(F.lit(((1 << size) - 1) ^ (1 << bit)))
            keys.append(F.xxhash64(left_out, F.lit(first + bit)))
    return F.array(*keys)


def _links(nodes: DataFrame, max_bits: int) -> DataFrame:
    """(a, b): links between nodes that connect what is linked at all."""
    n = partitions(nodes.sparkSession)
    # A row becomes one for each bit, so rows are dealt out before.
    rows = nodes.repartition(n, "print").select(F.explode(_variants(max_bits)).alias("key"), "print", "node")
    crowded = rows.groupBy("key").agg(F.count("*").alias("size")).filter(f"size > {GROUP_LIMIT}")
    crowded = settle(crowded.select("key", F.ceil(F.col("size") / GROUP_LIMIT).alias("chunks")), "crowded")
    if crowded.isEmpty():
        meet = rows.select("key", F.lit(0).alias("low"), F.lit(0).alias("high"), "print", "node")
    else:
        rows = rows.join(crowded, "key", "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
        rows = rows.withColumn("chunk", F.pmod(F.xxhash64("print"), F.col("chunks")))
        other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
        meet = rows.withColumn("other", other).select(
            "key",
            F.least("chunk", "other").alias("low"),
            F.greatest("chunk", "other").alias("high"),
            "print",
            "node",
        )
    meet = meet.repartition(n, "key", "low", "high").sortWithinPartitions("key", "low", "high")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
        for group, prints, node in _whole_groups(batches):
            found = list(_forests(group, prints, max_bits))
            a = node[np.concatenate([np.zeros(0, np.int64), *[x for x, _ in found]])]
            b = node[np.concatenate([np.zeros(0, np.int64), *[y for _, y in found]])]
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], schema=schema)

    return meet.mapInArrow(run, "a long, b long").distinct()


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """(group number, fingerprint, node) arrays that never cut a group in two."""
    held: list[np.ndarray] = [np.zeros(0, np.int64)] * 5
    for batch in batches:
        held = [np.r_[h, c.to_numpy()] for h, c in zip(held, batch.columns, strict=True)]
        last = np.flatnonzero(_fresh(held[:3]))[-1] if len(held[0]) else 0
        if last:
            yield _numbered([h[:last] for h in held])
            held = [h[last:] for h in held]
    if len(held[0]):
        yield _numbered(held)


def _fresh(keys: list[np.ndarray]) -> np.ndarray:
    """Where the keys differ from the row before."""
    fresh = np.ones(len(keys[0]), bool)
    fresh[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return fresh


def _numbered(columns: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    group = np.cumsum(_fresh(columns[:3]))
    return group, columns[3].astype(np.int64).view(np.uint64), columns[4]


def _forests(group: np.ndarray, prints: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links inside each group: all of a small one, a spanning forest of a large one."""
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    sizes = np.diff(np.r_[first, len(group)])
    size = np.repeat(sizes, sizes)
    for step in range(1, SMALL_GROUP):
        at = np.flatnonzero((size[:-step] > step) & (size[:-step] <= SMALL_GROUP))
        at = at[group[at] == group[at + step]]
        if len(at):
            near = at[np.bitwise_count(prints[at] ^ prints[at + step]) <= most]
            yield near, near + step
        if step >= len(group) - 1:
            break
    for start, count in zip(first[sizes > SMALL_GROUP], sizes[sizes > SMALL_GROUP], strict=True):
        rest = np.arange(start, start + count)
        while len(rest):
            frontier, rest = [rest[0]], rest[1:]
            while frontier and len(rest):
                here = frontier.pop()
                near = np.bitwise_count(prints[rest] ^ prints[here]) <= most
                reached = rest[near]
                if len(reached):
                    yield np.full(len(reached), here), reached
                    frontier.extend(reached.tolist())
                    rest = rest[~near]
