"""Token ids of many texts with a byte-level BPE of the ``tokenizers`` library (used inside tasks).

The library splits a text with a pattern before it merges bytes. Some of its cuts are sure from
two neighbouring bytes: before ASCII white space that follows anything but white space, and
between an ASCII letter or digit and ASCII punctuation. The pieces between such cuts are
encoded once each and kept in a bounded cache, which lives as long as the Python worker. A piece of Latin letters,
with or without a space in front, is one word of the pattern and goes straight to the library's
BPE model; the others go through its whole encoder. Texts that hold one of the vocabulary's
special strings, and all texts if the vocabulary is split in another way, go to the library whole.
"""

from __future__ import annotations

import json
import re

import numpy as np

from .piece_cache import PieceCache, flatten
from .textarrays import spans

LIBRARY_PIECES = 100_000  # strings given to the library at once
_SPACE, _ALNUM, _PUNCT = 1, 2, 4
_KIND = np.zeros(256, np.uint8)
_KIND[33:127] = _PUNCT
_KIND[48:58] = _KIND[65:91] = _KIND[97:123] = _ALNUM
_KIND[[9, 10, 11, 12, 13, 32]] = _SPACE
_WIDE = np.zeros(256, bool)  # last bytes that a white-space character of several bytes can have
_WIDE[[*range(0x80, 0x8B), 0x9F, 0xA0, 0xA8, 0xA9, 0xAF]] = True
_ONE_WORD = re.compile(rb" ?(?:[A-Za-z]|[\xC4-\xC8][\x80-\xBF]|\xC3[\x80-\x96\x98-\xB6\xB8-\xBF])+")
_SPLITTER = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}


def piece_starts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """First byte of every piece; each text that is not empty starts one."""
    low = int(bounds[0])
    part = data[low:int(bounds[-1])]
    kind = _KIND[part]
    before, here = kind[:-1], kind[1:]
    cut = (here == _SPACE) & ((before >= _ALNUM) | (part[:-1] >= 0x80))
    cut |= (here == _PUNCT) & (before == _ALNUM)
    at = np.flatnonzero(cut) + 1
    doubt = np.flatnonzero(_WIDE[part[at - 1]])
    if len(doubt):  # white space of several bytes before the cut is one run with what follows
        c, b = part[at[doubt] - 1], part[np.maximum(at[doubt] - 2, 0)]
        a = part[np.maximum(at[doubt] - 3, 0)]
        space = (b == 0xC2) & ((c == 0x85) | (c == 0xA0)) | (a == 0xE1) & (b == 0x9A) & (c == 0x80) \
            | (a == 0xE2) & (b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF)) \
            | (a == 0xE2) & (b == 0x81) & (c == 0x9F) | (a == 0xE3) & (b == 0x80) & (c == 0x80)
        at = np.delete(at, doubt[space])
    marks = np.zeros(len(part) + 1, bool)
    marks[at] = True
    marks[bounds[:-1][np.diff(bounds) > 0] - low] = True
    return np.flatnonzero(marks) + low


class TokenEncoder(PieceCache):
    """Ids as the library gives them for whole texts, without special tokens added."""

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_str(vocabulary)
        added = self.tokenizer.get_added_tokens_decoder()
        self.size = max([*self.tokenizer.get_vocab().values(), *added, 0]) + 1
        self.whole = [t.content.encode() for t in added.values()]
        form = json.loads(vocabulary)
        splitter = form.get("pre_tokenizer") or {}
        self.by_pieces = form.get("normalizer") is None and {k: splitter.get(k) for k in _SPLITTER} == _SPLITTER
        self.model = self.tokenizer.model
        shown = [b for b in range(256) if 33 <= b < 127 or 161 <= b < 173 or b >= 174]  # bytes that stand for themselves in the file
        hidden = [b for b in range(256) if b not in set(shown)]
        self.byte_chars = {**{b: chr(b) for b in shown}, **{b: chr(256 + k) for k, b in enumerate(hidden)}}

    def _library(self, texts: list) -> list:
        return [e.ids for i in range(0, len(texts), LIBRARY_PIECES)
                for e in self.tokenizer.encode_batch_fast(texts[i:i + LIBRARY_PIECES], add_special_tokens=False)]

    def encode_new(self, pieces: list) -> tuple:
        """Ids of each piece: of single words by the model alone, of all others by the whole encoder."""
        rest = [i for i, p in enumerate(pieces) if not _ONE_WORD.fullmatch(p)]
        out: list = [None] * len(pieces)
        for i, ids in zip(rest, self._library([pieces[i].decode() for i in rest])):
            out[i] = ids
        model, chars = self.model, self.byte_chars
        return flatten([[t.id for t in model.tokenize(p.decode("latin-1").translate(chars))] if ids is None else ids
                        for p, ids in zip(pieces, out)])

    def encode(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, number of ids of each text)."""
        raw = data[int(bounds[0]):int(bounds[-1])].tobytes()
        if not self.by_pieces or any(w in raw for w in self.whole):
            return flatten(self._library([data[a:b].tobytes().decode() for a, b in zip(bounds[:-1], bounds[1:])]))
        if not raw:
            return np.empty(0, np.uint32), np.zeros(len(bounds) - 1, np.int64)
        data, bounds = np.frombuffer(raw, np.uint8), bounds - int(bounds[0])
        starts = piece_starts(data, bounds)
        place, count = self.lookup(data, starts, np.diff(np.append(starts, len(data))))
        first = np.searchsorted(starts, bounds)
        total = np.concatenate([[0], np.cumsum(count)])
        return self.codes[spans(place, count)], total[first[1:]] - total[first[:-1]]
