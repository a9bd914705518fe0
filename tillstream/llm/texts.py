"""Whole texts in Arrow batches: bounded slices, byte classes and word spans in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text that one numpy step works on; a longer text is a step of its own.
STEP_BYTES = 2 << 20

ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[65:91] += 32

_MIX = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(29)
_LANE_MASK = np.array([(1 << (8 * k)) - 1 for k in range(9)], dtype=np.uint64)


def byte_class(*spans: tuple[int, int]) -> np.ndarray:
    """Boolean table over the 256 byte values, true inside the given inclusive spans."""
    table = np.zeros(256, dtype=bool)
    for low, high in spans:
        table[low:high + 1] = True
    return table


# After A-Z are lower-cased: digits, a-z, and every byte of a non-ASCII character.
WORD_BYTES = byte_class((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))


def steps(batches: Iterator[pa.RecordBatch], column: str,
          limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches holding at most ``limit`` bytes of ``column`` each, or one row."""
    for batch in batches:
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch[column]), 0), dtype=np.int64)
        ends = np.cumsum(sizes)
        start = 0
        while start < len(sizes):
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts back to back, and where each begins and the last ends; null is empty."""
    binary = pc.fill_null(column.cast(pa.large_string()), "").cast(pa.large_binary())
    _, offsets, data = binary.buffers()
    bounds = np.frombuffer(offsets, np.int64)[binary.offset:binary.offset + len(binary) + 1]
    if data is None or len(binary) == 0:
        return np.empty(0, np.uint8), np.zeros(len(binary) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[bounds[0]:bounds[-1]], bounds - bounds[0]


def strings(column: pa.Array) -> list[str]:
    """Texts as Python strings; null is empty."""
    return pc.fill_null(column.cast(pa.large_string()), "").to_pylist()


def word_spans(lowered: np.ndarray, bounds: np.ndarray,
               member: np.ndarray = WORD_BYTES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of ``member`` bytes inside each text, and for each
    text the number of its first word (one more entry at the end)."""
    inside = member[lowered]
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    first = bounds[:-1][bounds[:-1] < bounds[1:]]
    opens[first] = inside[first]
    last = bounds[1:][bounds[:-1] < bounds[1:]] - 1
    closes[last] = inside[last]
    starts = np.flatnonzero(opens)
    return starts, np.flatnonzero(closes) + 1, np.searchsorted(starts, bounds)


def word_hashes(lowered: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of bytes, eight bytes at a time. Words of up to eight bytes of
    equal length never collide; other pairs do with a chance of 2**-64."""
    padded = np.concatenate([lowered, np.zeros(8, np.uint8)])
    lanes = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))
    left = ends - starts
    hashes = left.astype(np.uint64) * _MIX
    todo, at = np.arange(len(starts)), starts
    while len(todo):
        lane = lanes[at] & _LANE_MASK[np.minimum(left, 8)]
        mixed = (hashes[todo] ^ lane) * _MIX
        hashes[todo] = mixed ^ (mixed >> _SHIFT)
        more = left > 8
        todo, at, left = todo[more], at[more] + 8, left[more] - 8
    return hashes
