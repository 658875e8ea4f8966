"""Helpers of the training-data operators: checkpoint folder, vectorised words.

Word helpers work on one Arrow text column at a time, on its UTF-8 bytes, so a
word costs a few array operations and no Python object. A null text is empty.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text bytes handled at once inside a task; a longer document is one piece.
PIECE_BYTES = 1 << 20

_ODD = 0x9E3779B97F4A7C15 | 1


_passing: ContextVar[tuple[list, ...]] = ContextVar("_passing", default=())


@contextmanager
def passing(spark):
    """Tables that ``cut`` writes in this block are removed at its end; one cut with
    ``keep=True`` belongs to the block around it, or stays if there is none. What the
    block hands on must not read the removed ones."""
    written: list[str] = []
    token = _passing.set((*_passing.get(), written))
    try:
        yield
    finally:
        _passing.reset(token)
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for name in written:
            path = jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(conf).delete(path, True)


@contextmanager
def tidy(spark):
    """Jobs planned in this block remove their shuffle files when they have ended."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def cut(frame, keep: bool = False):
    """``frame`` written to the shared checkpoint folder and read back: its lineage
    ends there, lost executors don't matter, and plans know its true size.

    The folder is ``spark.checkpoint.dir``; only where that is unset, one beside
    the session's warehouse. The write's shuffle files go when it has ended, the
    table at the end of the ``passing`` block it is written in.
    """
    spark = frame.sparkSession
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir") + "/_checkpoints"
    path = f"{folder}/{uuid.uuid4()}"
    blocks = _passing.get()[:-1] if keep else _passing.get()
    if blocks:
        blocks[-1].append(path)
    with tidy(spark):
        frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of 64-bit hashes (a bijection)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_ODD))

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: [^\x20\x09-\x0D]+
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False

#: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

#: Masks of the first 0 to 8 bytes of a block.
_LOW_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)

_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n-1 of the hash base and of its inverse modulo 2**64."""
    if len(_powers[0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        for k, base in enumerate((_ODD, pow(_ODD, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each span [start, end) of the bytes: blocks of eight bytes, each mixed
    with its place in the span before they are added up, so no arrangement of bytes cancels out."""
    size = np.asarray(end - start, np.int64)
    blocks = np.maximum((size + 7) >> 3, 1)
    first = np.cumsum(blocks) - blocks
    total = int(blocks.sum())
    place = np.arange(total) - np.repeat(first, blocks)
    left = np.clip(np.repeat(size, blocks) - 8 * place, 0, 8)
    padded = np.concatenate([data, np.zeros(16, np.uint8)])
    eight = np.ndarray(len(data) + 9, "<u8", padded, strides=(1,))[np.repeat(start, blocks) + 8 * place] & _LOW_BYTES[left]
    with np.errstate(over="ignore"):
        key = mix((place.astype(np.uint64) + np.uint64(1)) * np.uint64(_ODD) + np.uint64(seed))
        parts = mix(mix(eight + np.uint64(seed)) + key)
        sums = np.add.reduceat(parts, first) if len(size) else np.zeros(0, np.uint64)
        return mix(sums ^ mix(size.astype(np.uint64) + np.uint64(seed)))


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts of an Arrow string column, and their n + 1 offsets."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def pieces(batches, column: str = "text", most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of Arrow batches in slices of about ``most`` text bytes, at least one row each."""
    for batch in batches:
        ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64))
        first = 0
        while first < batch.num_rows:
            base = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, base + most, "right")))
            yield batch.slice(first, last - first)
            first = last


@dataclass
class Words:
    """Words of several documents: byte spans, document of each, first word of each document (n + 1)."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    first: np.ndarray

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word; words of one length up to eight bytes never share it."""
        return span_hashes(self.data, self.start, self.end)

    def prefix_hashes(self, value: np.ndarray, lengths) -> list[np.ndarray]:
        """Hashes of each word's first bytes, for each of several lengths (None: the whole word),
        for features: polynomials, which words built for it can share; ``value`` gives each byte's part."""
        up, down = powers(len(self.data) + 1)
        total = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum(value[self.data] * up[:len(self.data)], out=total[1:])
        ends = [self.end if n is None else np.minimum(self.end, self.start + n) for n in lengths]
        return [mix((total[e] - total[self.start]) * down[self.start]) for e in ends]

    def sums(self, value: np.ndarray) -> np.ndarray:
        """Sum of the bytes' values in each word."""
        total = np.zeros(len(self.data) + 1, value.dtype)
        np.cumsum(value[self.data], out=total[1:])
        return total[self.end] - total[self.start]


def words_of(column, member: np.ndarray = NOT_SPACE, lower: bool = False) -> Words:
    """Words (maximal runs of ``member`` bytes) of every text; they never cross texts."""
    data, offsets = utf8(column)
    if lower:
        data = LOWER[data]
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = member[data]
    fresh = np.zeros(len(data) + 1, bool)
    fresh[offsets] = True
    before = np.zeros(len(data) + 1, bool)
    before[1:] = inside[:-1]
    start = np.flatnonzero(inside & (fresh | ~before))
    end = np.flatnonzero(before & (fresh | ~inside))
    first = np.searchsorted(start, offsets)
    return Words(data, start, end, np.repeat(np.arange(len(offsets) - 1), np.diff(first)), first)


def runs_of_words(hashes: np.ndarray, doc: np.ndarray, n: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the ``n`` words from each position, and whether they lie in one document."""
    count = max(0, len(hashes) - n + 1)
    out = np.full(count, mix(np.array([seed + n], np.uint64))[0])
    for k in range(n):
        out = (out ^ hashes[k:k + count]) * np.uint64(0xD6E8FEB86659FD93)
        out ^= out >> np.uint64(32)
    return mix(out), doc[:count] == doc[n - 1:n - 1 + count]


def covered(starts: np.ndarray, length: int, size: int) -> np.ndarray:
    """Which of ``size`` positions some run [start, start + length) covers."""
    step = np.zeros(size + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, np.minimum(starts + length, size), -1)
    return np.cumsum(step[:-1]) > 0
