"""Words of an Arrow text column as flat numpy arrays (used inside tasks).

A word is a run of bytes of a given table: by default all but ASCII white space
(space, \\t, \\n, \\v, \\f, \\r), so multi-byte characters are never cut. Work goes in slices of a few MB of
text, whole documents each; a longer document is a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
SPACE_WORDS = np.ones(256, dtype=bool)  # bytes of a word
SPACE_WORDS[[9, 10, 11, 12, 13, 32]] = False
ALNUM_WORDS = np.zeros(256, dtype=bool)  # ASCII letters and digits, and every byte of other characters
ALNUM_WORDS[48:58] = ALNUM_WORDS[65:91] = ALNUM_WORDS[97:123] = ALNUM_WORDS[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts one after the other, and each text's bounds; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, pa.scalar("", column.type)).cast(pa.large_string())
    _, bounds, data = column.buffers()
    bounds = np.frombuffer(bounds, np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data, bounds


def slices(bounds: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of whole documents of at most ``limit`` bytes each."""
    low, n = 0, len(bounds) - 1
    while low < n:
        high = int(np.searchsorted(bounds, bounds[low] + limit, side="right")) - 1
        high = min(max(high, low + 1), n)
        yield low, high
        low = high


def words(data: np.ndarray, bounds: np.ndarray, is_word: np.ndarray = SPACE_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word of the given documents, and each document's first word (one more at the end)."""
    base, stop = int(bounds[0]), int(bounds[-1])
    inside = is_word[data[base:stop]]
    if not inside.any():
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(bounds), np.int64)
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    cuts = bounds[1:-1] - base  # a word never runs on into the next document
    cuts = cuts[(cuts > 0) & (cuts < len(inside))]
    begins[cuts] |= inside[cuts]
    ends[cuts - 1] |= inside[cuts - 1]
    starts, stops = np.flatnonzero(begins) + base, np.flatnonzero(ends) + 1 + base
    return starts, stops, np.searchsorted(starts, bounds).astype(np.int64)


def mix64(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every bit over the 64-bit word."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def word_hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray, lower: bool = True) -> np.ndarray:
    """64-bit hash of every word (polynomial in its bytes, then mixed); A-Z count as a-z if ``lower``."""
    if not len(starts):
        return np.empty(0, np.uint64)
    lengths = stops - starts
    at = np.cumsum(lengths) - lengths
    total = int(lengths.sum())
    place = np.arange(total, dtype=np.int64) - np.repeat(at, lengths)
    chars = data[place + np.repeat(starts, lengths)]
    chars = (_LOWER[chars] if lower else chars).astype(np.uint64) + np.uint64(1)
    with np.errstate(over="ignore"):
        power = np.full(int(lengths.max()), _MULTIPLIER, np.uint64)
        power[0] = 1
        np.multiply.accumulate(power, out=power)
        chars *= power[place]
        return mix64(np.add.reduceat(chars, at) + lengths.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenated ranges start .. start + length - 1."""
    total = int(lengths.sum())
    at = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(starts - at, lengths)
