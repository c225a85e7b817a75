"""Word boundaries and word hashes over Arrow string columns, without a Python loop per word.

Texts are handled as UTF-8 bytes. Work is cut into shards of whole texts, so memory
follows ``SHARD_BYTES`` or the longest single text, whichever is larger.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

SHARD_BYTES = 2 * 1024**2

_U64 = np.uint64


def byte_class(inside) -> np.ndarray:
    """A 256-entry table that is true for the bytes ``inside`` accepts."""
    return np.array([bool(inside(byte)) for byte in range(256)])


#: Digits, small ASCII letters and everything beyond ASCII.
ALPHANUMERIC = byte_class(lambda b: 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80)
#: Everything but blank and the control characters 9 to 13.
NOT_BLANK = byte_class(lambda b: not (b == 0x20 or 0x09 <= b <= 0x0D))
#: ASCII letters and everything beyond ASCII.
LETTERS = byte_class(lambda b: 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0x80)

LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], dtype=np.uint8)


def mix(values: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser: every input bit reaches every output bit."""
    x = values.astype(_U64, copy=True)
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53), (33, None)):
        x ^= x >> _U64(shift)
        if factor is not None:
            x *= _U64(factor)
    return x


def weights(count: int, seed: int) -> np.ndarray:
    """``count`` odd 64-bit multipliers; a longer run starts with the shorter ones."""
    steps = np.arange(1, count + 1, dtype=_U64) * _U64(0x9E3779B97F4A7C15)
    return mix(steps + _U64(seed)) | _U64(1)


@lru_cache(maxsize=4)
def _position_weights(count: int) -> np.ndarray:
    return weights(count, 11)


_BYTE_WEIGHTS = weights(256, 7)


#: Rows of texts that Spark and a Python worker exchange at a time, at most.
BATCH_ROWS = 1000
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def bounded_batches(spark: SparkSession) -> None:
    """Let the session exchange at most ``BATCH_ROWS`` rows at a time; its default is ten times that.

    Either side holds whole batches, several of them, so texts need a smaller one than numbers.
    A session that already has a smaller one keeps it.
    """
    if not 0 < int(spark.conf.get(_BATCH_SETTING)) <= BATCH_ROWS:
        spark.conf.set(_BATCH_SETTING, str(BATCH_ROWS))


def release_memory(last: bool = True) -> None:
    """Hand what is free back to the system: workers outlive their tasks, and share machines."""
    if last:
        gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # a C library without it
        pass


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets (one more than rows) of a string column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_null(column.type):
        column = column.cast(pa.string())
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if offsets is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)
    at = at[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def shards(offsets: np.ndarray, limit: int = SHARD_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes; a longer text stands alone."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        upto = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        upto = min(max(upto, row + 1), rows)
        yield row, upto
        row = upto


class Words:
    """The words of some texts: byte ranges, and how many each text has."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, inside: np.ndarray):
        self.data = data
        mask = inside[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        before = np.zeros(len(data), bool)
        before[1:] = mask[:-1]
        self.starts = np.flatnonzero(mask & (~before | edge[:-1]))
        after = np.zeros(len(data), bool)
        after[:-1] = mask[1:]
        self.ends = np.flatnonzero(mask & (~after | edge[1:])) + 1
        self._bind(offsets)

    @classmethod
    def at(cls, data: np.ndarray, offsets: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        """Words at given byte ranges, none of which reaches into the next text."""
        words = cls.__new__(cls)
        words.data, words.starts, words.ends = data, starts, ends
        words._bind(offsets)
        return words

    def _bind(self, offsets: np.ndarray) -> None:
        self.first = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.first)

    def __len__(self) -> int:
        return len(self.starts)

    @property
    def lengths(self) -> np.ndarray:
        return self.ends - self.starts

    def rows(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        return self.hashed()[0]

    def hashed(self) -> tuple[np.ndarray, np.ndarray]:
        """``hashes``, and the bytes of all words, one after the other."""
        if not len(self):
            return np.zeros(0, _U64), np.zeros(0, np.uint8)
        lengths = self.lengths
        at, place = spread(self.starts, lengths)
        text = self.data[at]
        terms = _BYTE_WEIGHTS[text]
        size = 1 << int(lengths.max()).bit_length()
        terms *= _position_weights(size)[place]
        sums = np.add.reduceat(terms, np.cumsum(lengths) - lengths)
        return mix(sums + lengths.astype(_U64)), text

    def all_same(self, text: np.ndarray, pool: np.ndarray, at: np.ndarray, length: np.ndarray):
        """``same`` of every word, whose bytes are ``text``."""
        if (self.lengths == length).all() and (text == pool[indices(at, length)]).all():
            return np.ones(len(self), bool)
        return self.same(np.arange(len(self)), pool, at, length)

    def same(self, which: np.ndarray, pool: np.ndarray, at: np.ndarray, length: np.ndarray):
        """Whether word ``which[i]`` equals ``pool[at[i] : at[i] + length[i]]``."""
        equal = self.lengths[which] == length
        inner = np.flatnonzero(equal)
        if len(inner):
            sizes = length[inner]
            mine = indices(self.starts[which[inner]], sizes)
            differ = self.data[mine] != pool[indices(at[inner], sizes)]
            equal[inner] = ~np.logical_or.reduceat(differ, np.cumsum(sizes) - sizes)
        return equal


def indices(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All indices of the ranges, one after the other."""
    ends = np.cumsum(lengths)
    at = np.repeat(starts - ends + lengths, lengths)
    at += np.arange(len(at), dtype=np.int64)
    return at


def spread(starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All indices of the ranges, one after the other, and the place of each in its range."""
    total = int(lengths.sum())
    firsts = np.cumsum(lengths) - lengths
    place = np.arange(total, dtype=np.int64) - np.repeat(firsts, lengths)
    return np.repeat(starts, lengths) + place, place
