"""Words, hashes and Arrow batches that the operators share.

Everything here works on the UTF-8 bytes of many texts at once, held in numpy
arrays inside a task. A word is a run of bytes that are not ASCII white space,
which for UTF-8 is the same as a run of such characters.
"""

from __future__ import annotations

import ctypes
import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Bytes of text handled at a time in a task; one longer text is handled alone.
PIECE_BYTES = 2 << 20

# Bytes of an Arrow batch between the JVM and Python; one longer row goes alone.
BATCH_BYTES = "16m"

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_STEP = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0xD6E8FEB86659FD93)
_BASE_INVERSE = np.uint64(pow(0xD6E8FEB86659FD93, -1, 1 << 64))
_powers: dict[int, np.ndarray] = {}
_shipped: set[str] = set()


def mix(values: np.ndarray) -> np.ndarray:
    """The finaliser of the splitmix64 generator: a bijection that spreads all bits."""
    z = values + _STEP
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


BYTE_VALUES = mix(np.arange(256, dtype=np.uint64))


def powers_of(base: np.uint64, count: int) -> np.ndarray:
    """base ** 0, base ** 1 and so on, modulo 2 ** 64; kept for the next call."""
    have = _powers.get(int(base))
    if have is None or len(have) < count:
        steps = np.full(max(count, 1 << 16), base, np.uint64)
        steps[0] = 1
        have = _powers[int(base)] = np.multiply.accumulate(steps)
    return have


def ready(spark: SparkSession) -> SparkSession:
    """Send this package to the executors, and bound Arrow batches by bytes, as rows may be texts."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parent.parent
        target = Path(tempfile.mkdtemp()) / f"{package.name}.zip"
        with zipfile.ZipFile(target, "w") as files:
            for path in package.rglob("*.py"):
                files.write(path, path.relative_to(package.parent))
        context.addPyFile(str(target))
        _shipped.add(context.applicationId)
    return spark


def give_back() -> None:
    """Return memory that a task no longer uses to the machine.

    Workers stay for later tasks of any kind, and would hold the largest need of all.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts in a row, offsets of each); a null counts as empty."""
    texts = texts.fill_null("") if texts.null_count else texts
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, ends, data = texts.buffers()
    offsets = np.frombuffer(ends, np.int64 if wide else np.int32)
    offsets = offsets[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(batch: pa.RecordBatch, column: str, most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with at most so many bytes of text, or one row."""
    _, offsets = text_bytes(batch.column(column))
    first = 0
    while first < batch.num_rows:
        last = int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1
        last = min(max(last, first + 1), batch.num_rows)
        yield batch.slice(first, last - first)
        first = last


def word_bounds(
    data: np.ndarray, offsets: np.ndarray, word: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end) of every word, and the index of each text's first word.

    ``word`` marks the bytes that belong to words; by default all but white space.
    """
    word = ~SPACE[data] if word is None else word
    edges = np.zeros(len(data) + 1, bool)
    edges[offsets] = True
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = word[:-1], word[1:]
    starts = np.flatnonzero(word & (~before | edges[:-1]))
    ends = np.flatnonzero(word & (~after | edges[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every word's bytes.

    Equal words have equal hashes wherever they stand: sums of byte values times
    rising powers, divided by the power at the word's start.
    """
    hashes = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        base = starts[first]
        last = int(np.searchsorted(ends, base + PIECE_BYTES, "right"))
        last = max(last, first + 1)
        part = data[base : ends[last - 1]]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(BYTE_VALUES[part] * powers_of(_BASE, len(part))[: len(part)], out=sums[1:])
        s, e = starts[first:last] - base, ends[first:last] - base
        hashes[first:last] = (sums[e] - sums[s]) * powers_of(_BASE_INVERSE, len(part))[s]
        first = last
    return mix(hashes)


def window_hashes(words: np.ndarray, width: int, seed: int = 1) -> np.ndarray:
    """A 64-bit hash of every ``width`` neighbouring word hashes."""
    count = max(0, len(words) - width + 1)
    factor = mix(np.array([seed], np.uint64))[0] | np.uint64(1)
    total = np.zeros(count, np.uint64)
    for k in range(width):
        total = total * factor + words[k : k + count]
    return mix(total)


def inside_one_text(bounds: np.ndarray, width: int) -> np.ndarray:
    """Whether each window of ``width`` words lies in one text."""
    count = max(0, int(bounds[-1]) - width + 1)
    inside = np.ones(count, bool)
    for k in range(1, width):
        cut = bounds[1:-1] - k
        inside[cut[(cut >= 0) & (cut < count)]] = False
    return inside


def ranges(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of ranges that are sorted by start."""
    if not len(starts):
        return starts, ends
    reach = np.maximum.accumulate(ends)
    fresh = np.flatnonzero(np.r_[True, starts[1:] > reach[:-1]])
    return starts[fresh], reach[np.r_[fresh[1:] - 1, len(starts) - 1]]


def text_volume(docs: DataFrame, text_col: str) -> int:
    """Bytes of text in a table, to size what is derived from it."""
    return docs.agg(F.sum(F.octet_length(F.col(text_col)).cast("long"))).first()[0] or 0


def partitions(spark: SparkSession) -> int:
    """The number of shuffle partitions of the session."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
