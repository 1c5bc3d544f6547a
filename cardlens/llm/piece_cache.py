"""Codes of short byte strings, worked out once each and kept in a bounded cache (used inside tasks).

Texts repeat their words. A piece of at most 16 bytes is known by its first and last eight bytes and its
length, so pieces are compared as numbers, a whole slice of text at a time; longer ones
are kept as they are. No two different pieces are ever taken for one another: pieces that share a hash are compared,
and those that differ are looked up one by one.
"""

from __future__ import annotations

import itertools

import numpy as np

from .textarrays import mix64

CACHE_PIECES = 1_000_000
CACHE_LONG = 100_000
CACHE_LONG_BYTES = 16 << 20
CACHE_CODES = 24_000_000
_LOW_BYTES = np.array([(1 << 8 * k) - 1 for k in range(8)] + [(1 << 64) - 1], np.uint64)


def _cut(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> list:
    """The pieces as bytes."""
    low, high = int(starts.min()), int((starts + lengths).max())
    raw = data[low:high].tobytes()
    return [raw[a:b] for a, b in zip((starts - low).tolist(), (starts - low + lengths).tolist())]


def flatten(lists: list) -> tuple:
    """(integers of all lists one after the other, length of each)."""
    count = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(itertools.chain.from_iterable(lists), np.int64, int(count.sum())), count


class PieceCache:
    """``codes`` holds the integers of all known pieces one after the other; subclasses say what a piece's integers are."""

    def __init__(self):
        self._clear()

    def encode_new(self, pieces: list) -> tuple:
        """(integers of all pieces one after the other, number of integers of each piece); pieces are bytes, none is empty."""
        raise NotImplementedError

    def _clear(self):
        self.hashes = np.empty(0, np.uint64)  # ascending, of the short pieces; the next five go with them
        self.heads, self.tails = np.empty(0, np.uint64), np.empty(0, np.uint64)
        self.lengths, self.place, self.count = np.empty(0, np.uint8), np.empty(0, np.int64), np.empty(0, np.int32)
        self.codes = np.empty(0, np.uint32)
        self._clear_long()

    def _clear_long(self):
        self.long: dict = {}
        self.long_bytes = 0

    def _add(self, pieces: list):
        """(place, count) of new pieces, whose integers go to the end of ``codes``."""
        codes, count = self.encode_new(pieces)
        place = len(self.codes) + np.cumsum(count) - count
        self.codes = np.concatenate([self.codes, codes.astype(np.uint32)])
        return place, count

    def lookup(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray):
        """(place, count) in ``codes`` of every piece of ``data``; valid until the next call."""
        if len(self.hashes) > CACHE_PIECES or len(self.codes) > CACHE_CODES:
            self._clear()
        if len(self.long) > CACHE_LONG or self.long_bytes > CACHE_LONG_BYTES:
            self._clear_long()
        place, count = np.empty(len(starts), np.int64), np.empty(len(starts), np.int64)
        big, small = np.flatnonzero(lengths > 16), np.flatnonzero(lengths <= 16)
        if len(big):
            place[big], count[big] = self._lookup_long(_cut(data, starts[big], lengths[big]))
        if len(small):
            place[small], count[small] = self._lookup_short(data, starts[small], lengths[small])
        return place, count

    def _lookup_long(self, pieces: list):
        new = [p for p in dict.fromkeys(pieces) if p not in self.long]
        if new:
            self.long.update(zip(new, zip(*(x.tolist() for x in self._add(new)))))
        self.long_bytes += sum(map(len, new))
        got = np.array([self.long[p] for p in pieces], np.int64).reshape(-1, 2)
        return got[:, 0], got[:, 1]

    def _lookup_short(self, data, starts, lengths):
        padded = np.concatenate([data, np.zeros(8, np.uint8)])
        words = np.ndarray((len(data),), "<u8", padded, strides=(1,))
        heads = words[starts] & _LOW_BYTES[np.minimum(lengths, 8)]
        tails = np.where(lengths > 8, words[np.maximum(starts + lengths - 8, 0)], np.uint64(0))
        with np.errstate(over="ignore"):
            hashes = mix64(heads + mix64(tails + lengths.astype(np.uint64)))
        found, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        same = (heads == heads[first][which]) & (tails == tails[first][which]) & (lengths == lengths[first][which])
        at = np.searchsorted(self.hashes, found)
        known = at < len(self.hashes)
        known[known] = self.hashes[at[known]] == found[known]
        new = np.flatnonzero(~known)
        if len(new):
            i = first[new]
            place, count = self._add(_cut(data, starts[i], lengths[i]))
            for name, values in (("hashes", found[new]), ("heads", heads[i]), ("tails", tails[i]), ("lengths", lengths[i]),
                                 ("place", place), ("count", count)):
                setattr(self, name, np.insert(getattr(self, name), at[new], values))
            at = np.searchsorted(self.hashes, found)
        # a piece whose hash another piece holds goes by itself
        same &= ((self.heads[at] == heads[first]) & (self.tails[at] == tails[first]) & (self.lengths[at] == lengths[first]))[which]
        place, count = self.place[at][which], self.count[at][which].astype(np.int64)
        for k in np.flatnonzero(~same):
            one = self._lookup_long(_cut(data, starts[k:k + 1], lengths[k:k + 1]))
            place[k], count[k] = one[0][0], one[1][0]
        return place, count
