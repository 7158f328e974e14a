"""Runs of repeated words, by longest common extensions on suffix trees.

A run is a maximal stretch of words with a smallest period q, at least ``repeats`` times
as long as q. Every run holds a Lyndon root: the longest Lyndon word at some place, under
one of the two orders of the words. So each place gives two candidates, which end at the
next smaller and at the next larger suffix. A candidate is extended in both directions by
the longest common extension of two places: to the right on the Ukkonen tree of the
words, to the left on that of their reversal. The extension of two places is the depth of
their leaves' lowest common ancestor, which an Euler tour of the tree and a table of
range minima give in constant time.

Trees are built only where a run can be. A run of at least ``least`` words holds two equal
windows of some length at the distance of its period, so the words of a text whose windows
do not recur near by take no part.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.words import (
    inside_one_text,
    pieces,
    ranges,
    ready,
    text_bytes,
    window_hashes,
    word_bounds,
    word_hashes,
)

RUNS = "doc_id long, n_runs long, runs array<struct<start:bigint,length:bigint,period:bigint>>, kept string"

Rewrite = Callable[[int | None, int], np.ndarray | None]


def periodic_runs(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least: int = 24,
    repeats: int = 3,
    rewrite: Rewrite | None = None,
) -> DataFrame:
    """(doc_id, n_runs, runs, kept) of every row.

    ``runs`` are all stretches of consecutive words with smallest period q and a length
    of at least ``least`` and ``repeats`` times q (``repeats`` is 2 at least) that no
    neighbouring word extends, as (start, length, period) in words from 0, sorted. They
    may overlap. ``kept`` are the words, joined by one space, that no run contains behind
    its first q words. ``rewrite``, given a row's id and number of words, may name which
    of the text's words stand in its place; the words it names are then the text.

    A null text has no words, and neither runs nor kept words, like an empty one. Rows
    are judged one by one, so repeated rows and ids give equal results, and a null id is
    returned as it is. An empty table gives an empty result; other columns are ignored,
    whatever their names. Texts are read whole; the trees take some 600 bytes a word of
    the longest stretch in which windows recur near by, and of one text at a time.
    """
    if least < 1 or repeats < 2:
        raise ValueError("a run has a word at least and repeats its period twice at least")
    ready(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                yield _judged(piece, least, repeats, rewrite)

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return picked.mapInArrow(run, RUNS)


def _judged(piece: pa.RecordBatch, least: int, repeats: int, rewrite: Rewrite | None) -> pa.RecordBatch:
    data, offsets = text_bytes(piece.column("text"))
    starts, ends, bounds = word_bounds(data, offsets)
    places = np.arange(len(starts))
    if rewrite:
        for doc, doc_id in enumerate(piece.column("doc_id").to_pylist()):
            a, b = int(bounds[doc]), int(bounds[doc + 1])
            named = rewrite(doc_id, b - a)
            if named is not None:
                places[a:b] = a + named
    hashes = word_hashes(data, starts, ends)[places]
    found: dict[int, list[tuple[int, int, int]]] = {}
    for a, b in stretches(hashes, bounds, least, repeats):
        doc = int(np.searchsorted(bounds, a, "right")) - 1
        _, words = np.unique(hashes[a:b], return_inverse=True)
        runs = runs_of(words.tolist(), least, repeats)
        if runs:
            found.setdefault(doc, []).extend((int(a - bounds[doc]) + s, n, q) for s, n, q in runs)
    kept, listed = [], []
    for doc in range(piece.num_rows):
        a, b = int(bounds[doc]), int(bounds[doc + 1])
        words = data[offsets[doc] : offsets[doc + 1]].tobytes().split()
        runs = sorted(found.get(doc, []), key=lambda r: (r[0], r[2]))
        if rewrite and not np.array_equal(places[a:b], np.arange(a, b)):
            words = [words[k] for k in (places[a:b] - a).tolist()]
        if runs:
            gone = np.zeros(b - a + 1, np.int64)
            for start, length, period in runs:
                gone[start + period] += 1
                gone[start + length] -= 1
            words = [words[k] for k in np.flatnonzero(np.cumsum(gone[:-1]) == 0).tolist()]
        kept.append(b" ".join(words))
        listed.append([{"start": s, "length": n, "period": q} for s, n, q in runs])
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    arrays = [
        piece.column("doc_id"),
        pa.array([len(x) for x in listed], pa.int64()),
        pa.array(listed, pa.list_(run)),
        pa.array(kept, pa.string()),
    ]
    return pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_runs", "runs", "kept"])


def stretches(hashes: np.ndarray, bounds: np.ndarray, least: int, repeats: int) -> list[tuple[int, int]]:
    """(from, to) of words that hold every run, and each run whole in one of them.

    A run of n words with period q has windows of ``width`` words that recur q words on,
    for n - q is at least that wide, and the first and the recurring ones together cover
    it. So it lies in one stretch covered by windows that recur, and their distance is at
    most the ``repeats``-th part of that stretch. Windows that recur only farther away go,
    which may part the stretch, until none is left to go.
    """
    width = max(1, least - least // repeats)
    inside = np.flatnonzero(inside_one_text(bounds, width))
    if not len(inside):
        return []
    # Windows of different texts differ, whatever their words.
    text = np.searchsorted(bounds, inside, "right").astype(np.uint64)
    keys = window_hashes(hashes, width)[inside] ^ (text * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(keys, kind="stable")
    at, ranked = inside[order], keys[order]
    step = np.where(ranked[1:] == ranked[:-1], at[1:] - at[:-1], len(hashes))
    near = np.minimum(np.r_[step, len(hashes)], np.r_[len(hashes), step])
    recurring = near < len(hashes)
    at, near = at[recurring], near[recurring]
    order = np.argsort(at)
    at, near = at[order], near[order]
    while True:
        if not len(at):
            return []
        first, last = ranges(at, at + width)
        # Windows of two texts may touch, and are no stretch.
        cut = np.searchsorted(first, at, "right") - 1
        size = (last - first)[cut]
        keep = near * repeats <= size
        if keep.all():
            break
        at, near = at[keep], near[keep]
    inner = bounds[1:-1]
    parts = []
    for a, b in zip(first.tolist(), last.tolist(), strict=True):
        cuts = inner[(inner > a) & (inner < b)].tolist()
        parts += [(x, y) for x, y in zip([a, *cuts], [*cuts, b], strict=True) if y - x >= least]
    return parts


def runs_of(words: list[int], least: int, repeats: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of a list of numbers."""
    n = len(words)
    forward = Extensions(words)
    rank = forward.rank.tolist()
    starts = np.tile(np.arange(n), 2)
    # The longest Lyndon word at a place ends where the next smaller suffix begins; under
    # the other order of words, the next larger one. No suffix behind the end is larger.
    stops = np.r_[_next(rank, n, 1), _next(rank, n, -1)]
    periods = stops - starts
    # Extended to the right first: what stays short even with a whole period to its left
    # does not need the reversal.
    usable = periods * repeats <= n
    starts, periods = starts[usable], periods[usable]
    right = forward.of(starts, starts + periods)
    # At some root of a run, at its first place, the left extension is below a period.
    whole = (right + 2 * periods > least) & (right + 2 * periods > repeats * periods)
    starts, periods, right = starts[whole], periods[whole], right[whole]
    if not len(starts):
        return []
    backward = Extensions(words[::-1])
    left = backward.of(n - starts, n - starts - periods)
    lengths = left + periods + right
    keep = (lengths >= least) & (lengths >= repeats * periods)
    found = np.stack([starts - left, periods, lengths], axis=1)[keep]
    return [(int(s), int(length), int(p)) for s, p, length in np.unique(found, axis=0)]


def _next(rank: list[int], n: int, sign: int) -> np.ndarray:
    """For every place the next one whose suffix is smaller (1) or larger (-1), or n."""
    out = [n] * n
    open_: list[int] = []
    for place in range(n):
        own = rank[place] * sign
        while open_ and rank[open_[-1]] * sign > own:
            out[open_.pop()] = place
        open_.append(place)
    return np.array(out)


class Extensions:
    """Longest common extensions of the suffixes of a list of numbers."""

    def __init__(self, words: list[int]):
        self.n = len(words)
        links, first, last = suffix_tree(words)
        self._tour(links, first, last)

    def _tour(self, links: list[dict[int, int]], first: list[int], last: list[int]) -> None:
        """An Euler tour: leaves in the order of their suffixes, and how high it climbs between them.

        Of the nodes between two leaves only the highest decides a range minimum, so that
        one is kept: the lowest common ancestor of the two, by its depth in words.
        """
        n = self.n
        rank = np.zeros(n + 1, np.int64)
        climbs, count, highest = [0] * (n + 1), 0, 0
        # A node is opened, its children follow in order, and between two the tour is back at it.
        todo = [(0, 0)]
        while todo:
            node, depth = todo.pop()
            if node < 0:
                highest = min(highest, depth)
                continue
            below = links[node]
            if below is None:
                # A leaf at this depth is the suffix of that length, its end mark included.
                start = n + 1 - depth
                climbs[count] = highest
                rank[start] = count
                count += 1
                highest = depth
                continue
            back = False
            for symbol in sorted(below, reverse=True):
                child = below[symbol]
                if back:
                    todo.append((-1, depth))
                back = True
                end = last[child]
                todo.append((child, depth + (n + 1 if end < 0 else end) - first[child]))
        self.rank = rank[:n] - 1
        self.of_leaf = rank
        self.table = [np.array(climbs, np.int32)]
        width = 1
        while 2 * width <= len(climbs):
            row = self.table[-1]
            self.table.append(np.minimum(row[:-width], row[width:]))
            width *= 2

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words from place a on equal those from place b on; a and b differ."""
        x, y = self.of_leaf[a], self.of_leaf[b]
        low, high = np.minimum(x, y) + 1, np.maximum(x, y) + 1
        level = np.frexp((high - low).astype(float))[1] - 1
        out = np.empty(len(low), np.int64)
        for k in np.unique(level):
            here = level == k
            row = self.table[k]
            out[here] = np.minimum(row[low[here]], row[high[here] - (1 << k)])
        return out


def suffix_tree(words: list[int]) -> tuple[list, list[int], list[int]]:
    """Ukkonen's tree of a list of numbers from 0 on, with -1 behind them as end mark.

    Returns, by node, its children by first symbol (None for a leaf) and the (first, past
    last) words of the edge that leads to it, past last being -1 for a leaf. Node 0 is the root.
    """
    text = [*words, -1]
    links: list = [{}]
    first, last, suffix = [0], [0], [0]
    node, edge, length, open_ = 0, 0, 0, 0
    for at, symbol in enumerate(text):
        open_ += 1
        waiting = 0
        while open_:
            if not length:
                edge = at
            below = links[node]
            child = below.get(text[edge])
            if child is None:
                below[text[edge]] = len(links)
                links.append(None)
                first.append(at)
                last.append(-1)
                suffix.append(0)
                if waiting:
                    suffix[waiting] = node
                    waiting = 0
            else:
                begin, end = first[child], last[child]
                size = (at + 1 if end < 0 else end) - begin
                if length >= size:
                    edge += size
                    length -= size
                    node = child
                    continue
                if text[begin + length] == symbol:
                    length += 1
                    if waiting:
                        suffix[waiting] = node
                    break
                middle = len(links)
                below[text[edge]] = middle
                links.append({symbol: middle + 1, text[begin + length]: child})
                first.append(begin)
                last.append(begin + length)
                suffix.append(0)
                links.append(None)
                first.append(at)
                last.append(-1)
                suffix.append(0)
                first[child] = begin + length
                if waiting:
                    suffix[waiting] = middle
                waiting = middle
            open_ -= 1
            if node == 0 and length:
                length -= 1
                edge = at - open_ + 1
            elif node:
                node = suffix[node]
    return links, first, last
