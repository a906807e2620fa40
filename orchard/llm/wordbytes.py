"""Words of texts as Arrow strings, cut out of runs of UTF-8 bytes."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa

from orchard.llm.common import word_spans

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32                              # A-Z alone


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    """Which of the 256 bytes lie in the ranges (both ends included)."""
    out = np.zeros(256, bool)
    for a, b in ranges:
        out[a:b + 1] = True
    return out


def words_of(data: np.ndarray, offsets: np.ndarray, word_bytes: np.ndarray) -> tuple:
    """(words, start, end, doc) of all runs of word bytes, A-Z lower-cased; words are Arrow strings."""
    is_word = word_bytes[data]
    start, end, doc = word_spans(is_word, offsets)
    at = np.zeros(len(start) + 1, np.int32)
    np.cumsum(end - start, out=at[1:])
    chars = LOWER[data[is_word]]
    return pa.StringArray.from_buffers(len(start), pa.py_buffer(at), pa.py_buffer(chars)), start, end, doc


def as_strings(values: Iterable[str]) -> pa.StringArray:
    return pa.array(list(values), pa.string())


def counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values and how often each is met."""
    return np.unique(keys, return_counts=True)
