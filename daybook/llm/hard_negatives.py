"""Hard-negative mining by slot-decomposed selection.

Of an anchor's rows with its own label the first few are its positives. A positive's
score is the upper limit of its window, and a share of it the lower limit. Sorted, the
upper limits cut the scores into disjoint slots: slot j lies above the limit of positive
j + 1 and up to that of positive j. Windows overlap, slots do not, so each candidate
falls into one slot, and tasks need to keep only the first k of each slot. Merging slots
from the lowest up gives the first k below every upper limit, and the lower limit then
cuts the end of each list.

Anchors meet all rows in blocks: rows are dealt into slices, anchors into chunks, and a
task multiplies the matrices of one slice and one chunk. Slices and chunks are bounded in
rows and bytes, whatever the labels or vectors, so no label or vector can be hot.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.words import partitions, ready
from daybook.scratch import settle

# A component x counts as floor(SCALE * x).
SCALE = 256

# Bytes of vectors in a packed block, and blocks in a slice of rows or a chunk of anchors.
BLOCK_BYTES = 1 << 18
SLICE_BLOCKS = 16

# Scores held at a time in a task.
TILE = 1 << 21

BLOCKS = "ids binary, labels binary, known binary, width int, vectors binary, uppers binary"
FOUND = "anchor long, slot int, score long, other long, has_id boolean"
LAST = np.iinfo(np.int64).max


def hard_negatives(
    rows: DataFrame,
    is_anchor: str,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
    positives: int = 5,
    negatives: int = 5,
    margin: tuple[int, int] = (80, 100),
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``is_anchor`` is a condition on the rows. Scores are inner products of the vectors'
    components, each rounded down at 1 / 256. Of an anchor's other rows, higher scores
    come first and equal ones by smaller id. Its positives are the first ``positives``
    rows of its label; for each of them the first ``negatives`` rows of other labels are
    returned whose score is at most the positive's and, times ``margin[1]``, at least
    ``margin[0]`` times the positive's. ``rank`` counts from 1.

    Rows with a null label, a null vector or a null or non-finite component take no
    part. A row without an id is no anchor and comes behind equal scores with an id.
    Rows that repeat an id are rows of their own, but no positive has its anchor's id.
    Of vectors of unequal length the shorter counts as filled up with zeros. A score
    that may need over 55 bits ends the job with an error. Without anchors, or on an
    empty table, the result is empty; other columns are ignored, whatever their names.
    """
    spark = ready(rows.sparkSession)
    picked = rows.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(label_col).cast("long").alias("label"),
        F.col(vector_col).cast("array<double>").alias("vector"),
        F.coalesce(F.expr(is_anchor), F.lit(False)).alias("is_anchor"),
    )
    picked = picked.filter("label IS NOT NULL AND vector IS NOT NULL")
    blocks = _numbered(picked.drop("is_anchor").mapInArrow(_pack(), BLOCKS), "blocks")
    chosen = picked.filter("is_anchor AND id IS NOT NULL").drop("is_anchor")
    # A number of its own tells anchors that repeat an id apart.
    chosen = settle(chosen.withColumn("anchor", F.monotonically_increasing_id()), "anchors")
    grid = Grid(blocks, partitions(spark))

    first = Window.partitionBy("anchor").orderBy(F.desc("score"), F.asc_nulls_last("other"))
    own = grid.meet(chosen, "CAST(array() AS array<bigint>)", _own_label(positives))
    own = own.withColumn("place", F.row_number().over(first)).filter(F.col("place") <= positives)
    limits = own.groupBy("anchor").agg(
        F.sort_array(F.collect_list(F.struct("place", "score", "other"))).alias("own")
    )
    limits = settle(limits, "positives")

    anchors = chosen.join(limits, "anchor").withColumn("upper", F.transform("own", lambda p: p["score"]))
    best = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), F.asc_nulls_last("other"))
    kept = grid.meet(anchors, "upper", _other_labels(negatives, margin))
    kept = kept.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= negatives)
    # A list of equal scores is in the order of ids, with none last.
    order = F.struct(
        (-F.col("score")).alias("down"), F.col("other").isNull().alias("unnamed"), F.col("other").alias("other")
    )
    slots = kept.groupBy("anchor").agg(F.collect_list(F.struct("slot", order.alias("row"))).alias("kept"))
    answers = _suffix_merge(limits.join(slots, "anchor"), negatives, margin)
    ids = chosen.select("anchor", F.col("id").alias("anchor_id"))
    return answers.join(ids, "anchor").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


def _suffix_merge(found: DataFrame, negatives: int, margin: tuple[int, int]) -> DataFrame:
    """The answers of every window, from at most ``negatives`` rows of every slot."""
    low, high = margin
    row = "struct<down:bigint,unnamed:boolean,other:bigint>"
    merged = F.expr(
        f"""aggregate(
            sequence(size(own) - 1, 0, -1),
            array(CAST(array() AS array<{row}>)),
            (lists, j) -> concat(lists, array(slice(array_sort(concat(
                element_at(lists, -1), transform(filter(kept, x -> x.slot = j), x -> x.row))), 1, {negatives}))),
            lists -> slice(reverse(lists), 1, size(own)))"""
    )
    windows = found.select("anchor", F.explode(F.arrays_zip("own", merged.alias("lists"))).alias("w"))
    windows = windows.select("anchor", "w.own.other", "w.own.score", F.posexplode("w.lists").alias("at", "row"))
    windows = windows.filter(F.lit(high) * -F.col("row.down") >= F.lit(low) * F.col("score"))
    return windows.select(
        "anchor",
        F.col("other").alias("positive_id"),
        (F.col("at") + 1).cast("int").alias("rank"),
        F.col("row.other").alias("negative_id"),
        F.col("score").alias("positive_score"),
        (-F.col("row.down")).alias("negative_score"),
    )


def _numbered(blocks: DataFrame, label: str) -> DataFrame:
    """Blocks written once, each with a number of its own to be dealt out by."""
    return settle(blocks.withColumn("number", F.monotonically_increasing_id()), label)


class Grid:
    """All rows in slices, ready to meet chunks of anchors."""

    def __init__(self, blocks: DataFrame, n: int):
        count = blocks.count()
        # Enough slices to keep the session's partitions busy, and none above SLICE_BLOCKS blocks.
        self.slices = max(1, min(count, max(n, -(-count // SLICE_BLOCKS))))
        place = F.pmod(F.xxhash64("number"), F.lit(self.slices)).cast("int")
        self.blocks = blocks.withColumn("slice", place)

    def meet(self, anchors: DataFrame, uppers: str, choose: Callable) -> DataFrame:
        """What ``choose`` finds for each anchor in each slice."""
        chosen = anchors.select(
            F.col("anchor").alias("id"), "label", "vector", F.col("id").alias("known"), F.expr(uppers).alias("uppers")
        )
        packed = _numbered(chosen.mapInArrow(_pack(anchors=True), BLOCKS), "chunks")
        chunks = max(1, -(-packed.count() // SLICE_BLOCKS))
        place = F.pmod(F.xxhash64("number"), F.lit(chunks)).cast("int")
        packed = packed.withColumn("chunk", place).withColumn(
            "slice", F.explode(F.sequence(F.lit(0), F.lit(self.slices - 1)))
        )
        rows = self.blocks.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))

        def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
            found = [np.zeros((0, 5), np.int64)]
            if left.num_rows and right.num_rows:
                found += choose(Vectors(left), Vectors(right))
            anchor, slot, score, other, has_id = np.concatenate(found).T
            return pa.table(
                {
                    "anchor": anchor, "slot": pa.array(slot, pa.int32()), "score": score,
                    "other": other, "has_id": pa.array(has_id.astype(bool)),
                }
            )

        found = rows.groupBy("slice", "chunk").cogroup(packed.groupBy("slice", "chunk")).applyInArrow(run, FOUND)
        named = F.when(F.col("has_id"), F.col("other")).alias("other")
        return found.select("anchor", "slot", "score", named)


class Vectors:
    """The rows of several packed blocks."""

    def __init__(self, blocks: pa.Table):
        columns = {name: blocks.column(name).to_pylist() for name in blocks.column_names}
        self.ids = np.concatenate([np.frombuffer(x, np.int64) for x in columns["ids"]])
        self.labels = np.concatenate([np.frombuffer(x, np.int64) for x in columns["labels"]])
        # For rows: whether the id is known. For anchors: the id of the row.
        self.known = np.concatenate([np.frombuffer(x, np.int64) for x in columns["known"]])
        widths = columns["width"]
        self.values = np.zeros((len(self.ids), max(widths)), np.int64)
        limits = [np.frombuffer(x, np.int64) for x in columns["uppers"]]
        counts = [len(np.frombuffer(x, np.int64)) for x in columns["ids"]]
        tops = [len(u) // c if c else 0 for u, c in zip(limits, counts, strict=True)]
        self.uppers = np.full((len(self.ids), max(tops)), np.iinfo(np.int64).min)
        at = 0
        for raw, width, count, upper, top in zip(columns["vectors"], widths, counts, limits, tops, strict=True):
            if width:
                self.values[at : at + count, :width] = np.frombuffer(raw, np.int64).reshape(count, width)
            if top:
                self.uppers[at : at + count, :top] = upper.reshape(count, top)
            at += count
        self.most = int(np.abs(self.values.astype(float)).max()) if self.values.size else 0

    def against(self, anchors: Vectors) -> tuple[np.ndarray, np.ndarray]:
        """Both matrices, at the same width, of a type in which inner products are exact."""
        width = max(self.values.shape[1], anchors.values.shape[1])
        bound = max(width, 1) * max(self.most, 1) * max(anchors.most, 1)
        if bound >= 1 << 55:
            raise OverflowError("an inner product of rounded components may need over 55 bits")
        kind = np.float32 if bound < 1 << 24 else np.float64 if bound < 1 << 53 else np.int64
        return tuple(
            np.pad(m.values, ((0, 0), (0, width - m.values.shape[1]))).astype(kind) for m in (self, anchors)
        )


def _own_label(positives: int) -> Callable:
    """For each anchor the first rows of its label, by label so that no other pair is scored."""

    def choose(rows: Vectors, anchors: Vectors) -> Iterator[np.ndarray]:
        values, queries = rows.against(anchors)
        for label in np.unique(anchors.labels):
            of = np.flatnonzero(anchors.labels == label)
            members = np.flatnonzero(rows.labels == label)
            for mine in _tiles(of, len(members)):
                scores = (queries[mine] @ values[members].T).astype(np.int64)
                rest = (anchors.known[mine][:, None] != rows.ids[members]) | (rows.known[members] == 0)
                a, r = np.nonzero(rest)
                yield _first(rows, anchors, mine[a], members[r], scores[a, r], np.zeros(len(a), np.int64), positives)

    return choose


def _other_labels(negatives: int, margin: tuple[int, int]) -> Callable:
    """For each anchor the first rows of other labels in each of its slots."""
    low, high = margin

    def choose(rows: Vectors, anchors: Vectors) -> Iterator[np.ndarray]:
        values, queries = rows.against(anchors)
        none = np.iinfo(np.int64).min
        # The lowest limit that any window of the anchor has: that of its last positive not below zero.
        floors = np.where(anchors.uppers >= 0, -(-anchors.uppers * low // high), LAST).min(axis=1, initial=LAST)
        for mine in _tiles(np.flatnonzero(floors < LAST), len(rows.ids)):
            scores = (queries[mine] @ values.T).astype(np.int64)
            wanted = (scores >= floors[mine][:, None]) & (scores <= anchors.uppers[mine][:, :1])
            wanted &= anchors.labels[mine][:, None] != rows.labels
            a, r = np.nonzero(wanted)
            score = scores[a, r]
            limits = anchors.uppers[mine]
            slot = ((limits[a] >= score[:, None]) & (limits[a] > none)).sum(axis=1) - 1
            yield _first(rows, anchors, mine[a], r, score, slot, negatives)

    return choose


def _tiles(anchors: np.ndarray, width: int) -> Iterator[np.ndarray]:
    step = max(1, TILE // max(width, 1))
    for k in range(0, len(anchors) if width else 0, step):
        yield anchors[k : k + step]


def _first(
    rows: Vectors, anchors: Vectors, a: np.ndarray, r: np.ndarray, score: np.ndarray, slot: np.ndarray, k: int
) -> np.ndarray:
    """The first k of every anchor and slot, as rows of FOUND."""
    ids = np.where(rows.known[r] == 1, rows.ids[r], LAST)
    order = np.lexsort((ids, 1 - rows.known[r], -score, slot, a))
    a, r, score, slot = a[order], r[order], score[order], slot[order]
    fresh = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (slot[1:] != slot[:-1])][: len(a)])
    place = np.arange(len(a)) - np.repeat(fresh, np.diff(np.r_[fresh, len(a)]))
    kept = place < k
    a, r = a[kept], r[kept]
    return np.stack([anchors.ids[a], slot[kept], score[kept], rows.ids[r], rows.known[r]], axis=1)


def _pack(anchors: bool = False) -> Callable:
    """Packs the rows that take part into blocks of bounded size, rounded to integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(c.split()[0], {"int": pa.int32()}.get(c.split()[1], pa.binary())) for c in BLOCKS.split(", ")])
        for batch in batches:
            lengths = batch.column("vector").value_lengths().to_numpy(zero_copy_only=False)
            step = max(1, BLOCK_BYTES // (8 * max(1, int(lengths.max(initial=1)))))
            for k in range(0, batch.num_rows, step):
                part = batch.slice(k, step)
                made = _block(part, anchors)
                if made:
                    yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(made, schema, strict=True)], schema=schema)

    return run


def _block(part: pa.RecordBatch, anchors: bool) -> tuple | None:
    lists = part.column("vector")
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten()
    # Nulls come as NaN, so both kinds of rows that take no part show in one place.
    flat = flat.to_numpy(zero_copy_only=False).astype(float)
    row = np.repeat(np.arange(len(lengths)), lengths)
    whole = np.ones(len(lengths), bool)
    whole[row[~np.isfinite(flat)]] = False
    if not whole.any():
        return None
    column = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    width = int(lengths[whole].max())
    values = np.zeros((len(lengths), width), np.int64)
    use = whole[row]
    scaled = np.floor(SCALE * flat[use])
    if len(scaled) and np.abs(scaled).max() >= 2.0**63:
        raise OverflowError("a rounded component does not fit into 63 bits")
    values[row[use], column[use]] = scaled.astype(np.int64)
    ids = part.column("id")
    known = np.asarray(ids.is_valid()).astype(np.int64)
    uppers = np.zeros(0, np.int64)
    if anchors:
        known = part.column("known").to_numpy(zero_copy_only=False).astype(np.int64)
        lists = [x for x, w in zip(part.column("uppers").to_pylist(), whole, strict=True) if w]
        most = max(map(len, lists))
        uppers = np.array([x + [np.iinfo(np.int64).min] * (most - len(x)) for x in lists], np.int64)
    numbers = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    labels = part.column("label").to_numpy(zero_copy_only=False).astype(np.int64)
    return (
        numbers[whole].tobytes(), labels[whole].tobytes(), known[whole].tobytes(), width,
        values[whole].tobytes(), uppers.tobytes(),
    )
