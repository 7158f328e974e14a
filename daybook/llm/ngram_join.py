"""N-gram Jaccard join by prefix trees.

Each document is the set of its distinct word n-grams. A global order puts rare n-grams
before common ones: first by the power of two of how many documents hold them, then by
hash. Two sets that link share an n-gram among the first few of each, the prefixes, so
sets meet where their prefixes do. Whether they link is decided on a trie: the sets that
met one set are stored in it in the same order from its common end, so that they share
paths, and the one set walks down it. What a path overlaps with the set is counted once
for all sets below it, and a subtree goes as soon as what is left of the set or of the
longest path below cannot reach the overlap that the shortest one needs.

N-grams of one document alone link nothing. They count in the size of its set and take
places of its prefix, but only the others are stored, and a document with too few others
takes no further part. Equal sets are one class with one set.

Sets that share a prefix n-gram are not paired with one another. In each round the first
few of them by a hash are centres, and the others that do not belong to a centre's
component yet are compared with it, where what follows the n-gram in both is enough. Then the centres go, and the n-grams whose remaining
sets are one component go with them, until none is left: every pair that meets was either
compared or connected by other links.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.components import connected
from daybook.llm.substring_dedup import BUCKET_BYTES, PACKED, _by_bucket, _pack, _single
from daybook.llm.words import (
    LOWER,
    partitions,
    ready,
    text_bytes,
    text_volume,
    window_hashes,
    word_bounds,
    word_hashes,
)
from daybook.scratch import settle

# Stored n-grams of the sets in one trie.
TRIE_TOKENS = 1 << 20

# Centres of an n-gram in the first round, and how many times more in each later one.
CENTRES, MORE_CENTRES = 1, 8

# Of a stored n-gram's 64 bits, the low ones are its hash, the high ones how common it is.
HASH_BITS = 58

ENTRIES = "bucket int, batch_id long, payload binary"
REPLIES = "batch_id long, bucket int, common binary"
SETS = "doc_id long, n_shingles long, digest binary, stored binary"
PREFIXES = "token long, node long, n long, rest long"
LINKS = "a long, b long"


def ngram_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 5,
    share: tuple[int, int] = (80, 100),
) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row.

    A row's set holds the distinct runs of ``width`` words of its text, with ASCII
    capitals lowered; of a shorter text the whole is the only one. Two rows link when
    ``share[1]`` times the size of their sets' intersection is at least ``share[0]`` times
    that of their union. component_id is the smallest id reachable over links, the row's
    own included.

    A null text and one without words have an empty set, which links with nothing. Each
    row is judged by itself: rows that repeat an id link by their texts only, and rows
    without an id link like any other but name no component, so one that reaches no id
    has none. An empty table gives an empty result; other columns are ignored, whatever
    their names. N-grams are compared by 58 bits of a hash.
    """
    ready(docs.sparkSession)
    sets = settle(_sets(docs, id_col, text_col, width, share), "sets")
    grouped = sets.filter("digest IS NOT NULL").groupBy("digest").agg(
        F.min("doc_id").alias("least"),
        F.first("n_shingles").alias("n"),
        F.first("stored", ignorenulls=True).alias("stored"),
    )
    classes = settle(grouped.withColumn("node", F.monotonically_increasing_id()), "classes")
    members = _components(classes, share)
    named = classes.select("digest", "node", "least").join(members, "node", "left")
    named = named.withColumn("root", F.coalesce("component", "node"))
    roots = named.groupBy("root").agg(F.min("least").alias("component_id"))
    found = named.select("digest", "root").join(roots, "root").select(F.col("digest").alias("key"), "component_id")
    return sets.join(found, sets["digest"] == found["key"], "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def _sets(docs: DataFrame, id_col: str, text_col: str, width: int, share: tuple[int, int]) -> DataFrame:
    """Every row's set: its size, and what is stored of it where it may link at all."""
    n = partitions(docs.sparkSession)
    buckets = max(n, text_volume(docs, text_col) // BUCKET_BYTES)
    picked = docs.select(
        (F.spark_partition_id().cast("long") * (1 << 32)).alias("batch_id"),
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).alias("text"),
    )
    packed = picked.mapInArrow(_pack, PACKED).repartition(n, "batch_id")

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                yield Batch(batch.slice(row, 1), width, buckets).entries()

    def judged(key, left: pa.Table, right: pa.Table) -> pa.Table:
        made = [Batch(b, width, buckets).sets(right, share) for b in _single(left)]
        return pa.Table.from_batches(made, schema=SET_SCHEMA)

    common = packed.mapInArrow(held, ENTRIES).groupBy("bucket").applyInArrow(_common, REPLIES)
    return packed.groupBy("batch_id").cogroup(common.groupBy("batch_id")).applyInArrow(judged, SETS)


SET_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("digest", pa.binary()), ("stored", pa.binary())]
)


class Batch:
    """The sets of a packed batch, computed anew wherever the batch arrives."""

    def __init__(self, row: pa.RecordBatch, width: int, buckets: int):
        self.batch_id = row.column("batch_id")[0].as_py()
        self.ids = row.column("ids").flatten()
        data, offsets = text_bytes(row.column("texts").flatten())
        data = LOWER[data]
        starts, ends, bounds = word_bounds(data, offsets)
        words = word_hashes(data, starts, ends)
        counts = np.diff(bounds)
        hashes = window_hashes(words, width)
        # Of a text of fewer words the whole: hashed apart, by its number of words.
        whole = {k: window_hashes(words, k, 1 + k) for k in range(1, width) if (counts == k).any()}
        sets = []
        for a, count in zip(bounds[:-1].tolist(), counts.tolist(), strict=True):
            if count >= width:
                sets.append(np.unique(hashes[a : a + count - width + 1]))
            else:
                sets.append(whole[count][a : a + 1] if count else hashes[:0])
        self.sizes = np.array([len(s) for s in sets], np.int64)
        self.values = np.concatenate([np.zeros(0, np.uint64), *sets])
        self.distinct, self.place, self.holders = np.unique(self.values, return_inverse=True, return_counts=True)
        # The buckets are ranges of hashes, so distinct hashes are in their order.
        bucket = ((self.distinct >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
        self.parts = _by_bucket(bucket)

    def entries(self) -> pa.RecordBatch:
        """For each bucket the hashes held here, each with the power of two of its holders."""
        low = self.distinct.astype(np.uint32)
        power = (np.frexp(self.holders.astype(float))[1] - 1).astype(np.uint8)
        payloads = [low[a:b].tobytes() + power[a:b].tobytes() for _, a, b in self.parts]
        schema = pa.schema([("bucket", pa.int32()), ("batch_id", pa.int64()), ("payload", pa.binary())])
        return pa.RecordBatch.from_arrays(
            [
                pa.array([k for k, _, _ in self.parts], pa.int32()),
                pa.array([self.batch_id] * len(self.parts), pa.int64()),
                pa.array(payloads, pa.binary()),
            ],
            schema=schema,
        )

    def sets(self, replies: pa.Table, share: tuple[int, int]) -> pa.RecordBatch:
        """The rows of this batch; of equal sets the first one's n-grams are stored."""
        answers = dict(zip(replies.column("bucket").to_pylist(), replies.column("common").to_pylist(), strict=True))
        common = np.frombuffer(b"".join(answers[bucket] for bucket, _, _ in self.parts), np.uint8)
        common = common.astype(np.uint64)[self.place]
        stored = (common << np.uint64(HASH_BITS)) | (self.values >> np.uint64(64 - HASH_BITS))
        shared = common > 0
        digests: list[bytes | None] = []
        kept: list[bytes | None] = []
        seen = set()
        at = 0
        for size in self.sizes.tolist():
            own = shared[at : at + size]
            digest = tokens = None
            if size and share[1] * int(np.count_nonzero(own)) >= share[0] * size:
                digest = hashlib.blake2b(self.values[at : at + size].tobytes(), digest_size=16).digest()
                if digest not in seen:
                    seen.add(digest)
                    tokens = np.sort(stored[at : at + size][own]).tobytes()
            digests.append(digest)
            kept.append(tokens)
            at += size
        arrays = [self.ids.cast(pa.int64()), pa.array(self.sizes), pa.array(digests, pa.binary()), pa.array(kept, pa.binary())]
        return pa.RecordBatch.from_arrays(arrays, schema=SET_SCHEMA)


def _common(table: pa.Table) -> pa.Table:
    """How common the hashes of a bucket are: the power of two of their holders, 0 for one alone."""
    keys, powers, counts = [], [], []
    for payload in table.column("payload"):
        raw = payload.as_buffer()
        n = raw.size // 5
        counts.append(n)
        keys.append(np.frombuffer(raw, np.uint32, n))
        powers.append(np.frombuffer(raw, np.uint8, n, 4 * n))
    keys = np.concatenate(keys)
    order = np.argsort(keys)
    ranked = keys[order]
    first = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
    holders = np.add.reduceat(np.exp2(np.concatenate(powers)[order]), first)
    power = (np.frexp(holders)[1] - 1).astype(np.uint8)
    common = np.empty(len(keys), np.uint8)
    common[order] = np.repeat(power, np.diff(np.r_[first, len(keys)]))
    ends = np.cumsum([0, *counts])
    return pa.table(
        {
            "batch_id": table.column("batch_id").combine_chunks(),
            "bucket": table.column("bucket").combine_chunks(),
            "common": pa.array([common[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.binary()),
        }
    )


def _components(classes: DataFrame, share: tuple[int, int]) -> DataFrame:
    """(node, component) of the classes that link with others."""
    part, whole = share

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(c.split()[0], pa.int64()) for c in PREFIXES.split(", ")])
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("node", "n", "stored")), strict=True)
            for node, size, raw in rows:
                stored = np.frombuffer(raw, np.int64)
                # N-grams that only this set holds come first in the order and are not stored.
                length = size + (-part * size) // whole + 1 - (size - len(stored))
                tokens = stored[: max(0, length)]
                rest = len(stored) - np.arange(len(tokens))
                columns = [tokens, np.full(len(tokens), node), np.full(len(tokens), size), rest]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=schema)

    spark = classes.sparkSession
    entries = classes.select("node", "n", "stored").mapInArrow(prefixes, PREFIXES)
    entries = _unsettled(entries.withColumn("component", F.col("node")))
    members = spark.createDataFrame([], "node long, component long")
    centres = CENTRES
    stored = classes.select("node", "n", "stored")
    while not entries.isEmpty():
        # Only sets that may still meet others move on.
        stored = settle(stored.join(entries.select("node").distinct(), "node", "left_semi"), "stored")
        order = Window.partitionBy("token").orderBy(F.xxhash64("node"), "node")
        chosen = entries.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= centres)
        chosen = settle(chosen.drop("place"), "centres")
        met = chosen.select("token", *(F.col(c).alias(f"centre_{c}") for c in ("node", "n", "rest", "component")))
        # At the first n-gram that two sets share, they share no more than what follows it in
        # either; and the longer must not outgrow the overlap.
        least = (whole + part) * F.least("rest", "centre_rest") >= part * (F.col("n") + F.col("centre_n"))
        sized = whole * F.least("n", "centre_n") >= part * F.greatest("n", "centre_n")
        apart = F.col("component") != F.col("centre_component")
        pairs = entries.join(met, "token").filter(apart & least & sized)
        pairs = pairs.groupBy("centre_node", "node", "component", "centre_component").agg(F.max("rest").alias("m"))
        links = _linked(settle(pairs, "pairs"), stored, share)
        rest = entries.join(chosen.select("token", "node"), ["token", "node"], "left_anti")
        links = settle(links, "links")
        if not links.isEmpty():
            groups = settle(connected(links), "groups")
            renamed = groups.select(F.col("node").alias("component"), F.col("component").alias("new"))
            rest, known = (
                x.join(renamed, "component", "left").withColumn("component", F.coalesce("new", "component")).drop("new")
                for x in (rest, members)
            )
            fresh = groups.join(members.select("node"), "node", "left_anti")
            members = settle(known.select("node", "component").unionByName(fresh), "members")
        entries = _unsettled(rest)
        centres *= MORE_CENTRES
    return members


def _unsettled(entries: DataFrame) -> DataFrame:
    """The entries of n-grams that several components hold."""
    entries = entries.select("token", "node", "n", "rest", "component")
    spread = entries.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    return settle(entries.join(spread.filter("low < high").select("token"), "token", "left_semi"), "entries")


def _linked(pairs: DataFrame, stored: DataFrame, share: tuple[int, int]) -> DataFrame:
    """(a, b): the components of the pairs that link."""
    sizes = pairs.groupBy("centre_node").agg(F.ceil(F.sum("m") / TRIE_TOKENS).alias("parts"))
    dealt = pairs.join(sizes, "centre_node").withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")))
    dealt = settle(dealt.select("centre_node", "part", "node", "component", "centre_component"), "dealt")
    own = dealt.select("centre_node", "part", F.col("centre_component").alias("component")).distinct()
    rows = dealt.select("centre_node", "part", "component", "node", F.lit(False).alias("query"))
    rows = rows.unionByName(own.withColumns({"node": F.col("centre_node"), "query": F.lit(True)}))
    rows = rows.join(stored, "node")

    def walk(table: pa.Table) -> pa.Table:
        part = {c: table.column(c).to_pylist() for c in ("query", "component", "n", "stored")}
        at = part["query"].index(True)
        others = [k for k in range(table.num_rows) if k != at]
        # From the common end of the order, so that sets share paths.
        paths = [~np.frombuffer(x, np.uint64)[::-1] for x in part["stored"]]
        trie = Trie([paths[k] for k in others], [part["n"][k] for k in others])
        found = trie.similar(paths[at], part["n"][at], share)
        b = [part["component"][others[k]] for k in found.tolist()]
        return pa.table({"a": pa.array([part["component"][at]] * len(b), pa.int64()), "b": pa.array(b, pa.int64())})

    return rows.groupBy("centre_node", "part").applyInArrow(walk, LINKS).distinct()


class Trie:
    """Sets of numbers in a common ascending order, stored by shared beginnings."""

    def __init__(self, paths: list[np.ndarray], sizes: list[int]):
        names = [p.byteswap().tobytes() for p in paths]
        self.order = sorted(range(len(paths)), key=names.__getitem__)
        paths = [paths[k] for k in self.order]
        self.lengths = np.array([len(p) for p in paths], np.int64)
        self.sizes = np.array([sizes[k] for k in self.order], np.int64)
        self.tokens = np.concatenate([np.zeros(0, np.uint64), *paths])
        offsets = np.cumsum(self.lengths) - self.lengths
        # Nodes by parent, the depths between which they stand, and the sets below them.
        self.parent, self.top, self.bottom, self.first, self.last, self.set_node = [-1], [0], [0], [0], [0], []
        open_ = [0]
        for k, path in enumerate(paths):
            joint = 0
            if k:
                before = paths[k - 1]
                short = min(len(path), len(before))
                differ = np.flatnonzero(path[:short] != before[:short])
                joint = int(differ[0]) if len(differ) else short
            split = None
            while self.bottom[open_[-1]] > joint:
                node = open_.pop()
                self.last[node] = k
                if self.top[node] < joint:
                    split = node
            if split is not None:
                # The part of the node above the joint becomes its parent.
                self._node(self.parent[split], self.top[split], joint, self.first[split])
                self.parent[split], self.top[split] = len(self.parent) - 1, joint
                open_.append(len(self.parent) - 1)
            if len(path) > joint:
                self._node(open_[-1], joint, len(path), k)
                open_.append(len(self.parent) - 1)
            self.set_node.append(open_[-1])
        for node in open_:
            self.last[node] = len(paths)
        self.parent, self.top, self.bottom = (np.array(x) for x in (self.parent, self.top, self.bottom))
        self.first, self.last, self.set_node = (np.array(x, np.int64) for x in (self.first, self.last, self.set_node))
        # A node's tokens are those of the first set below it.
        self.begin = offsets[self.first] + self.top if len(paths) else self.top
        self.children = np.argsort(self.parent, kind="stable")
        self.child_bounds = np.searchsorted(self.parent[self.children], np.arange(len(self.parent) + 1))
        self.ending = np.argsort(self.set_node, kind="stable")
        self.ending_bounds = np.searchsorted(self.set_node[self.ending], np.arange(len(self.parent) + 1))
        spans = np.stack([self.first, np.maximum(self.last, self.first + 1)], axis=1).ravel()
        if len(paths):
            self.least = np.minimum.reduceat(np.r_[self.sizes, self.sizes[-1]], spans)[::2]
            self.longest = np.maximum.reduceat(np.r_[self.lengths, 0], spans)[::2]

    def _node(self, parent: int, top: int, bottom: int, first: int) -> None:
        self.parent.append(parent)
        self.top.append(top)
        self.bottom.append(bottom)
        self.first.append(first)
        self.last.append(0)

    def similar(self, query: np.ndarray, size: int, share: tuple[int, int]) -> np.ndarray:
        """Which sets link with a query set of ``size`` n-grams, of which ``query`` may be shared."""
        part, whole = share
        found = [np.zeros(0, np.int64)]
        if not len(self.order) or not len(query):
            return found[0]
        nodes, overlap = np.zeros(1, np.int64), np.zeros(1, np.int64)
        while len(nodes):
            at, node = _spread(self.ending_bounds, nodes)
            ended = self.ending[at]
            # whole * overlap >= part * (size + own size - overlap)
            linked = (whole + part) * overlap[node] >= part * (size + self.sizes[ended])
            found.append(ended[linked])
            at, node = _spread(self.child_bounds, nodes)
            below, overlap = self.children[at], overlap[node]
            if not len(below):
                break
            lengths = self.bottom[below] - self.top[below]
            ends = np.cumsum(lengths)
            run = np.repeat(self.begin[below] - (ends - lengths), lengths) + np.arange(ends[-1])
            tokens = self.tokens[run]
            place = np.searchsorted(query, tokens)
            hit = query[np.minimum(place, len(query) - 1)] == tokens
            overlap = overlap + np.add.reduceat(hit, ends - lengths, dtype=np.int64)
            passed = place[ends - 1] + hit[ends - 1]
            most = overlap + np.minimum(len(query) - passed, self.longest[below] - self.bottom[below])
            keep = (whole + part) * most >= part * (size + self.least[below])
            nodes, overlap = below[keep], overlap[keep]
        return np.array(self.order, np.int64)[np.concatenate(found)]


def _spread(bounds: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of all entries of the nodes in a list sorted by node, and whose each is."""
    counts = bounds[nodes + 1] - bounds[nodes]
    whose = np.repeat(np.arange(len(nodes)), counts)
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + (bounds[nodes] - (ends - counts))[whose], whose
