"""The hashed column of a word, as the classifier numbers it."""

import functools

import numpy as np

from cardlens.llm.quality_classifier import WORD_BITS
from cardlens.llm.textarrays import word_hashes


@functools.lru_cache(None)
def word_column(word):
    hashed = word_hashes(np.frombuffer(word, np.uint8), np.array([0]), np.array([len(word)]))
    return int(hashed[0] >> np.uint64(64 - WORD_BITS))
