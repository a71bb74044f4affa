"""Texts of an Arrow batch as one byte buffer, with its words found and hashed by numpy.

The operators of this folder that read whole texts in Python run inside ``mapInArrow``. They see a batch of documents as
one buffer of UTF-8 bytes with offsets, so that the work per word is a few array operations and not a Python loop.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import xxhash

#: Bytes that part words: space, and tab to carriage return.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: A-Z to a-z, all other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Text that is worked on at once; a longer document makes a slab of its own.
SLAB_BYTES = 4 << 20
#: Words beyond this many bytes are hashed one by one.
LONG_WORD = 256

_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_SHIFT = np.uint64(29)
_MASKS = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [(1 << 64) - 1], np.uint64)


def mixed(values: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over all bits; one value for each input."""
    values = (values ^ (values >> np.uint64(32))) * _MIX
    values = (values ^ (values >> _SHIFT)) * _MULTIPLY
    return values ^ (values >> np.uint64(32))


@dataclass
class Texts:
    """``data`` holds the texts one after the other, text i from ``offsets[i]`` to ``offsets[i + 1]``. Null is empty."""

    data: np.ndarray
    offsets: np.ndarray

    @classmethod
    def of(cls, column: pa.Array | pa.ChunkedArray, lower: bool = False) -> Texts:
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
        column = column.cast(pa.large_binary())
        if column.null_count:
            column = column.fill_null(b"")
        if not len(column):
            return cls(np.zeros(0, np.uint8), np.zeros(1, np.int64))
        _, offsets, data = column.buffers()
        offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
        held = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
        held = held[offsets[0] : offsets[-1]]
        return cls(LOWER[held] if lower else held, offsets - offsets[0])

    def __len__(self) -> int:
        return len(self.offsets) - 1

    @cached_property
    def sizes(self) -> np.ndarray:
        return np.diff(self.offsets)

    def bytes_of(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()

    @cached_property
    def words(self) -> Words:
        return Words.of(self.data, self.offsets, ~SPACE[self.data])


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte strings from ``starts`` to ``ends``."""
    lengths = ends - starts
    result = lengths.astype(np.uint64) * _MULTIPLY
    if not len(starts):
        return result
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(padded) - 7,), "<u8", padded, 0, (1,))
    open_ = np.flatnonzero((lengths > 0) & (lengths <= LONG_WORD))
    at = starts[open_]
    left = lengths[open_]
    while len(open_):
        part = eight[at] & _MASKS[np.minimum(left, 8)]
        result[open_] = mixed(result[open_] ^ part) + _MULTIPLY
        more = left > 8
        open_, at, left = open_[more], at[more] + 8, left[more] - 8
    for i in np.flatnonzero(lengths > LONG_WORD):
        result[i] = xxhash.xxh3_64_intdigest(data[starts[i] : ends[i]])
    return result


@dataclass
class Words:
    """Words of a batch: their bytes in ``data``, and for text i those from ``bounds[i]`` to ``bounds[i + 1]``."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray

    @classmethod
    def of(cls, data: np.ndarray, offsets: np.ndarray, inside: np.ndarray, breaks: np.ndarray | None = None) -> Words:
        """``inside`` marks the bytes of words; a text's end also ends a word, and ``breaks`` marks bytes that begin one."""
        cuts = offsets[offsets < len(data)]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        first[cuts] = inside[cuts]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        before = cuts[cuts > 0] - 1
        last[before] = inside[before]
        if breaks is not None:
            first |= breaks
            last[:-1] |= breaks[1:]
        starts = np.flatnonzero(first)
        return cls(data, starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets))

    @cached_property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    @cached_property
    def hashes(self) -> np.ndarray:
        return hashes(self.data, self.starts, self.ends)

    @cached_property
    def owner(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def windows(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all ``width`` consecutive words of a text, and the place of each one's first word."""
        n = len(self.hashes) - width + 1
        if n <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        total = np.zeros(n, np.uint64)
        for k in range(width):
            total = total * _MULTIPLY + self.hashes[k : k + n]
        whole = np.arange(n) + width <= np.repeat(self.bounds[1:], self.counts)[:n]
        return mixed(total[whole]), np.flatnonzero(whole)


def slabs(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLAB_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in pieces of about ``limit`` bytes of text, so that temporary arrays stay small."""
    for batch in batches:
        sizes = np.diff(Texts.of(batch.column(batch.schema.get_field_index(column))).offsets) + 64
        at = 0
        ends = np.cumsum(sizes)
        while at < len(sizes):
            upto = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + limit, side="right"))
            upto = max(upto, at + 1)
            yield batch.slice(at, upto - at)
            at = upto
