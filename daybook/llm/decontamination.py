"""Benchmark decontamination by template canonicalisation.

Texts become templates: numbers, names and units behind numbers turn into typed
placeholders, so a question keeps its template when its values are changed. As names
are told by capitals, which a copy may not keep, every text is read a second time in
small letters and without names. Windows of templates are joined by hash. Windows that meet at the same offset belong to one
alignment, and an alignment counts only if its slots are consistent: the same value
in the item must always be the same value in the document. Of the others only long
passages with the same values count. An item's share is taken over the union of its
alignments in a document.

Every window of every document is hashed where the document is read. Only the window
hashes of the benchmark travel to the tasks, in blocks of bounded size, and only
windows that meet one of them are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.words import (
    LOWER,
    give_back,
    inside_one_text,
    mix,
    pieces,
    ready,
    text_bytes,
    window_hashes,
    word_bounds,
    word_hashes,
)
from daybook.scratch import settle

# Words of a template window, and the least of them that are no placeholders; with
# fewer, the reading in small letters takes the values themselves for the window.
WINDOW = 8
LEAST_LITERAL = 0.5

# Shortest window of placeholders that stands for an item with fewer words than a
# window; still shorter items are found by their values.
SHORTEST = 4

# A document is contaminated by a run of so many words, or this share of an item.
RUN = 13
SHARE = 0.8

# A run of so many words with the same values counts, whatever stands behind it: the
# shortest that does not take a question with one other value for a copy.
SAME_RUN = 18

# Window hashes of the benchmark that tasks hold at a time.
BLOCK_WINDOWS = 1 << 20

# Words that are units where they follow a number.
UNITS = (
    "km m cm mm kg g mg lb lbs oz ton tons mile miles yard yards inch inches foot feet meter meters "
    "metre metres liter liters litre litres ml hour hours minute minutes second seconds day days week "
    "weeks month months year years dollar dollars euro euros pound pounds cent cents percent degree "
    "degrees mph kmh"
).split()

WINDOWS = "hash long, pos int, width int, kind int, n_words int, bare boolean, slots array<bigint>"

# Readings of a text: with names as placeholders, and in small letters without names.
NAMED, FOLDED = 0, 1

# Seed of the hashes of values, apart from those of templates.
VERBATIM = 1000

_WORD = np.zeros(256, bool)
_WORD[0x30:0x3A] = _WORD[0x41:0x5B] = _WORD[0x61:0x7B] = _WORD[0x80:] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[0x30:0x3A] = True
_POINT = np.zeros(256, bool)
_POINT[[0x2C, 0x2E]] = True
_CAPITAL = np.zeros(256, bool)
_CAPITAL[0x41:0x5B] = True
_STOP = np.zeros(256, bool)
_STOP[[0x0A, 0x21, 0x22, 0x2E, 0x3A, 0x3B, 0x3F, 0x7C]] = True
NUMBER, NAME, UNIT = mix(np.array([101, 102, 103], np.uint64))


def _unit_hashes() -> np.ndarray:
    data = np.frombuffer(" ".join(UNITS).encode(), np.uint8)
    starts, ends, _ = word_bounds(data, np.array([0, len(data)]))
    return np.sort(word_hashes(data, starts, ends))


class Templates:
    """The template words of many texts in one reading.

    ``words`` holds hashes of literal words in small letters or placeholders, ``slot``
    marks placeholders, ``values`` are hashes of what stands in them, and ``bounds``
    the index of each text's first word. A word is a run of letters and digits with
    points or commas between digits. A number begins with a digit, a unit is a unit's
    word behind a number, and a name is a run of capitalised words inside a sentence,
    which only the reading ``NAMED`` has.
    """

    def __init__(self, kind: int, words: np.ndarray, values: np.ndarray, slot: np.ndarray, bounds: np.ndarray):
        self.kind, self.words, self.values, self.slot, self.bounds = kind, words, values, slot, bounds

    def windows(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(first word, hash) of the windows inside one text.

        Windows with too few literal words are left out of the reading with names; in
        the other their hash is that of their values, so only verbatim copies have it.
        """
        hashes = window_hashes(self.words, width, width)
        inside = inside_one_text(self.bounds, width)
        dense = self._filled(width) > width * (1 - LEAST_LITERAL)
        if width < SHORTEST:
            dense[:] = True
        if self.kind == NAMED:
            inside &= ~dense
        elif (inside & dense).any():
            hashes = np.where(dense, window_hashes(self.values, width, VERBATIM + width), hashes)
        at = np.flatnonzero(inside)
        return at, hashes[at]

    def bare(self, at: np.ndarray, width: int) -> np.ndarray:
        """Whether a window has no literal word at all."""
        return self._filled(width)[at] == width

    def _filled(self, width: int) -> np.ndarray:
        """Placeholders of every window."""
        slots = np.r_[0, np.cumsum(self.slot)]
        return (slots[width:] - slots[:-width])[: max(0, len(self.slot) - width + 1)]

    def slots(self, at: np.ndarray, width: int) -> pa.Array:
        """The values in the slots of each window."""
        where = np.flatnonzero(self.slot)
        a, b = np.searchsorted(where, at), np.searchsorted(where, at + width)
        sizes = b - a
        ends = np.cumsum(sizes)
        flat = np.repeat(a - (ends - sizes), sizes) + np.arange(int(sizes.sum()))
        values = self.values[where[flat]].view(np.int64) if len(flat) else np.zeros(0, np.int64)
        return pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), pa.array(values))


def _small(texts: pa.Array) -> pa.Array:
    """Texts in small letters, beyond ASCII too unless a text is no valid UTF-8."""
    try:
        return pc.utf8_lower(texts)
    except pa.ArrowInvalid:
        return texts


def readings(texts: pa.Array) -> list[Templates]:
    """Both readings of many texts."""
    data, offsets = text_bytes(texts)
    word = _WORD[data]
    if len(data) > 2:
        word[1:-1] |= _POINT[data[1:-1]] & _DIGIT[data[:-2]] & _DIGIT[data[2:]]
    starts, ends, bounds = word_bounds(data, offsets, word)
    # Small letters are word bytes where their capitals are, so the words stay the same.
    small, small_offsets = text_bytes(_small(texts))
    small = LOWER[small]
    small_word = _WORD[small]
    if len(small) > 2:
        small_word[1:-1] |= _POINT[small[1:-1]] & _DIGIT[small[:-2]] & _DIGIT[small[2:]]
    values = word_hashes(small, *word_bounds(small, small_offsets, small_word)[:2])
    opens = np.zeros(len(starts) + 1, bool)
    opens[bounds] = True
    opens = opens[:-1]
    stops = np.r_[0, np.cumsum(_STOP[data] & ~word)]
    if len(starts):
        opens[1:] |= stops[starts[1:]] > stops[ends[:-1]]
    number = _DIGIT[data[starts]]
    second = data[np.minimum(starts + 1, max(len(data) - 1, 0))] if len(starts) else data[:0]
    capital = _CAPITAL[data[starts]] | ((data[starts] == 0xC3) & (second < 0x9F))
    name = capital & ~opens & ~number
    unit = np.zeros(len(starts), bool)
    if len(starts):
        fresh = np.zeros(len(starts) + 1, bool)
        fresh[bounds] = True
        units = _unit_hashes()
        place = np.minimum(np.searchsorted(units, values), len(units) - 1)
        unit[1:] = (units[place[1:]] == values[1:]) & number[:-1] & ~fresh[1:-1]
    name &= ~unit
    plain = np.where(number, NUMBER, np.where(unit, UNIT, values))
    folded = Templates(FOLDED, plain, values, number | unit, bounds)
    words = np.where(name, NAME, plain)
    follows = np.zeros(len(starts), bool)
    follows[1:] = name[1:] & name[:-1]
    # A name of several words is one slot, its value that of all its words.
    first = np.flatnonzero(~follows)
    if len(first):
        values = mix(np.add.reduceat(values * np.uint64(3), first))
    slot = (number | name | unit)[first]
    return [Templates(NAMED, words[first], values, slot, np.searchsorted(first, bounds)), folded]


def _rows(templates: Templates, at: np.ndarray, hashes: np.ndarray, width: int, keys: list, names: list):
    """A record batch of windows, with the given columns of their texts in front."""
    text = np.searchsorted(templates.bounds, at, "right") - 1
    sizes = np.diff(templates.bounds)
    columns = [k.take(pa.array(text)) for k in keys]
    columns += [
        pa.array(hashes.view(np.int64)),
        pa.array(at - templates.bounds[text], pa.int32()),
        pa.array(np.full(len(at), width), pa.int32()),
        pa.array(np.full(len(at), templates.kind), pa.int32()),
        pa.array(sizes[text], pa.int32()),
        pa.array(templates.bare(at, width)),
        templates.slots(at, width),
    ]
    return pa.RecordBatch.from_arrays(columns, [*names, *(c.split()[0] for c in WINDOWS.split(", "))])


def index_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """All template windows of a benchmark's items, written as a table.

    An item with fewer words than a window is one window of all its words, from four
    words on. Shorter ones are found by their values, and null items, or items without
    words, cannot be found.
    """
    ready(items.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for templates in readings(batch.column("text")):
                sizes = np.diff(templates.bounds)
                for width in range(1 if templates.kind == FOLDED else SHORTEST, WINDOW + 1):
                    at, hashes = templates.windows(width)
                    own = sizes[np.searchsorted(templates.bounds, at, "right") - 1]
                    fit = (own == width) if width < WINDOW else np.ones(len(at), bool)
                    yield _rows(templates, at[fit], hashes[fit], width, [batch.column("item_id")], ["item_id"])

    rows = items.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).alias("text"))
    return settle(rows.mapInArrow(run, f"item_id long, {WINDOWS}"), "windows")


def _hits(docs: DataFrame, index: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Windows of documents whose hash some item has, with the slots' values."""
    spark = docs.sparkSession
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.xxhash64(F.col(text_col)).alias("text_hash"),
        F.col(text_col).alias("text"),
    )
    blocks = max(1, -(-index.count() // BLOCK_WINDOWS))
    found = None
    for block in range(blocks):
        part = index.filter(F.pmod("hash", F.lit(blocks)) == block).select("hash", "width", "kind").distinct()
        wanted = {}
        for r in part.groupBy("kind", "width").agg(F.collect_list("hash").alias("hashes")).collect():
            wanted[r["kind"], r["width"]] = np.sort(np.array(r["hashes"], np.int64).view(np.uint64))
        sent = spark.sparkContext.broadcast(wanted)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            filters = {key: _filter(hashes) for key, hashes in sent.value.items()}
            for batch in batches:
                for piece in pieces(batch, "text"):
                    both = {templates.kind: templates for templates in readings(piece.column("text"))}
                    keys = [piece.column("doc_id"), piece.column("text_hash")]
                    for (kind, width), hashes in sent.value.items():
                        templates = both[kind]
                        at, own = templates.windows(width)
                        maybe = filters[kind, width][(own & np.uint64(0xFFFFF)).astype(np.int64)]
                        at, own = at[maybe], own[maybe]
                        place = np.minimum(np.searchsorted(hashes, own), len(hashes) - 1)
                        real = hashes[place] == own
                        if real.any():
                            names = ["doc_id", "text_hash"]
                            yield _rows(templates, at[real], own[real], width, keys, names)
            give_back()

        made = rows.mapInArrow(run, f"doc_id long, text_hash long, {WINDOWS}")
        found = made if found is None else found.unionByName(made)
    return found


def _filter(hashes: np.ndarray) -> np.ndarray:
    """Which low 20 bits occur, so that few windows need a search."""
    table = np.zeros(1 << 20, bool)
    table[(hashes & np.uint64(0xFFFFF)).astype(np.int64)] = True
    return table


def _longest_run(positions: Column, width: Column) -> Column:
    """Words in the longest run of windows at neighbouring positions of a sorted array."""
    state = F.struct(F.lit(-2).alias("last"), F.lit(0).alias("run"), F.lit(0).alias("best"))

    def step(s: Column, p: Column) -> Column:
        run = F.when(p == s["last"] + 1, s["run"] + 1).otherwise(1)
        return F.struct(p.alias("last"), run.alias("run"), F.greatest(s["best"], run).alias("best"))

    return F.aggregate(positions, state, step, lambda s: s["best"]) + width - 1


def _covered(positions: Column, width: Column) -> Column:
    """Words in the union of windows at the positions of a sorted array."""
    state = F.struct(F.lit(-(1 << 20)).alias("last"), F.lit(0).alias("sum"))

    def step(s: Column, p: Column) -> Column:
        more = F.least(p - s["last"], width)
        return F.struct(p.alias("last"), (s["sum"] + more).alias("sum"))

    return F.aggregate(positions, state, step, lambda s: s["sum"])


def contaminations(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """(doc_id, text_hash, item_id, words, share, changed) of contaminated documents.

    One row for each item found in a document by a run of 13 template words or by 0.8
    of the item's words, in either reading. Where placeholders leave too few words, their
    values must stand as they are, and numbers alone count beside words only, or where
    they are the whole item; ``words`` is the longest run, ``share`` the part of the item
    found at all its places together, ``changed`` whether slots of the place with the
    longest run hold other values. ``text_hash`` is Spark's
    ``xxhash64`` of the text, which tells rows with equal or null ids apart.
    """
    ready(docs.sparkSession)
    index = index_windows(items, item_col, item_text_col)
    hits = _hits(docs, index, id_col, text_col)
    known = index.select(
        "hash",
        "width",
        "kind",
        "item_id",
        F.col("n_words").alias("item_words"),
        F.col("pos").alias("at"),
        F.col("slots").alias("item_slots"),
    )
    met = hits.join(known, ["hash", "width", "kind"])
    pairs = F.transform(
        F.arrays_zip(F.col("item_slots").alias("item"), F.col("slots").alias("doc")),
        lambda p: F.struct(p["item"].alias("item"), p["doc"].alias("doc")),
    )
    groups = met.withColumn("pairs", pairs).groupBy(
        "doc_id", "text_hash", "item_id", "item_words", "width", "kind", (F.col("pos") - F.col("at")).alias("offset")
    )
    same = F.forall("pairs", lambda p: p["item"] == p["doc"])
    aligned = groups.agg(
        F.array_sort(F.collect_set("at")).alias("at"),
        F.array_sort(F.collect_set(F.when(same, F.col("at")))).alias("same"),
        F.array_distinct(F.flatten(F.collect_set("pairs"))).alias("pairs"),
        F.bool_and("bare").alias("bare"),
    )
    # Numbers alone run alike in many texts, so without any word the item must be whole.
    whole = _covered(F.col("at"), F.col("width")) == F.col("item_words")
    aligned = aligned.filter(~F.col("bare") | whole)
    width = F.col("width")
    consistent = F.size("pairs") == F.size(F.array_distinct(F.transform("pairs", lambda p: p["item"])))
    as_it_is = _longest_run(F.col("same"), width) >= SAME_RUN
    aligned = aligned.withColumn("consistent", consistent).filter(F.col("consistent") | as_it_is)
    counted = F.when(F.col("consistent"), F.col("at")).otherwise(F.col("same"))
    aligned = aligned.withColumn("at", counted).withColumn("words", _longest_run(F.col("at"), width))
    alignment = F.struct("words", (_covered(F.col("at"), width) / F.col("item_words")).alias("part"), "changed")
    changed = F.col("consistent") & F.exists("pairs", lambda p: p["item"] != p["doc"])
    united = aligned.withColumn("changed", changed).groupBy(
        "doc_id", "text_hash", "item_id", "item_words", "width", "kind"
    )
    united = united.agg(
        F.max_by(alignment, F.struct("words", alignment["part"], ~F.col("changed"))).alias("best"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("at")))).alias("at"),
    )
    scored = united.select(
        "doc_id",
        "text_hash",
        "item_id",
        "best.words",
        (_covered(F.col("at"), width) / F.col("item_words")).alias("share"),
        "best.changed",
    )
    scored = scored.filter((F.col("words") >= RUN) | (F.col("share") >= SHARE))
    best = F.max_by(F.struct("words", "share", "changed"), F.struct("words", "share", ~F.col("changed")))
    found = scored.groupBy("doc_id", "text_hash", "item_id").agg(best.alias("best"))
    return found.select("doc_id", "text_hash", "item_id", "best.words", "best.share", "best.changed")


def judged(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, contaminated, items, words, share, changed) of every row.

    ``items`` lists the ids of the items found, ascending; ``words`` and ``share`` are
    the largest over them, ``changed`` whether some item was found with other values.
    A null or empty text, and any text when the benchmark is empty, is clean.
    """
    found = contaminations(docs, items, id_col, text_col)
    per_text = found.groupBy(F.col("doc_id").alias("of"), F.col("text_hash").alias("of_hash")).agg(
        F.array_sort(F.collect_set("item_id")).alias("items"),
        F.max("words").cast("long").alias("words"),
        F.max("share").alias("share"),
        F.max("changed").alias("changed"),
    )
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col)).alias("hash"))
    same = F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("hash") == F.col("of_hash"))
    return rows.join(per_text, same, "left").select(
        "doc_id",
        F.col("items").isNotNull().alias("contaminated"),
        F.coalesce("items", F.array().cast("array<bigint>")).alias("items"),
        F.coalesce("words", F.lit(0)).alias("words"),
        F.coalesce("share", F.lit(0.0)).alias("share"),
        F.coalesce("changed", F.lit(False)).alias("changed"),
    )


def decontaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of documents in which no item of the benchmark is found."""
    found = contaminations(docs, items).select(
        F.col("doc_id").alias("_of"), F.col("text_hash").alias("_hash")
    )
    found = settle(found.distinct(), "contaminated")
    same = docs["doc_id"].eqNullSafe(found["_of"]) & (F.xxhash64(docs["text"]) == found["_hash"])
    return docs.join(found, same, "left_anti")
