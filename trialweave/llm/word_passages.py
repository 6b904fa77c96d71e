"""Passages of words for ``suffix_dedup``: strings are judged as words, whatever blanks stand between them.

A context is the sequence of its words' 64-bit hashes. Contexts of an anchor are joined, each closed by a symbol of its own, and sorted by their suffixes; neighbours whose common beginning
is at least a passage long are equal passages. What is removed from a text goes from a passage's first word to its last; the blanks around stay.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame

from .suffix_sort import suffix_array
from .word_strings import find_spots, symbols

#: More than 50 words.
PASSAGE, GRAM = 51, 8
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def common_prefixes(s: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """For each suffix but the first in order, how much it has in common with the one before it, counted up to ``most``."""
    padded = np.concatenate([s, -2 - np.arange(most)])
    now, before = order[1:], order[:-1]
    common = np.zeros(len(now), np.int64)
    open_ = np.arange(len(now))
    for k in range(most):
        open_ = open_[padded[now[open_] + k] == padded[before[open_] + k]]
        if not len(open_):
            break
        common[open_] = k + 1
    return common


def repeated_passages(contexts: list[bytes], anchors: list[int], length: int = PASSAGE) -> list[np.ndarray]:
    """For each context, which of its passages some other context has as well, or the same one elsewhere."""
    words = [np.frombuffer(c, np.uint64) for c in contexts]
    _, names = np.unique(np.concatenate(words), return_inverse=True)
    n = len(contexts)
    sizes = np.array([len(w) for w in words])
    begins = np.cumsum(sizes + 1) - sizes - 1
    s = np.empty(int(sizes.sum()) + n, np.int64)
    ends = begins + sizes
    s[ends] = np.arange(n)[::-1]  # the last end is the only smallest symbol
    inside = np.ones(len(s), bool)
    inside[ends] = False
    s[inside] = names + n
    order = suffix_array(s)
    hit = common_prefixes(s, order, length) >= length
    at = order[np.concatenate([hit, [False]]) | np.concatenate([[False], hit])]
    flags = [np.zeros(max(k - length + 1, 0), bool) for k in sizes.tolist()]
    owner = np.searchsorted(ends, at)
    for c, begin in zip(owner.tolist(), (at - begins[owner]).tolist()):
        flags[c][begin] = True
    return flags


def _spots(own: DataFrame, length: int) -> DataFrame:
    return find_spots(own, length, GRAM, places=True)


class Words:
    """Strings are judged as words."""

    length = PASSAGE
    find_spots = staticmethod(_spots)
    repeated = staticmethod(repeated_passages)
    width = 8

    @staticmethod
    def units(text: bytes) -> np.ndarray:
        return symbols(text)

    @staticmethod
    def cut(units: np.ndarray, a: int, b: int) -> bytes:
        return units[a:b].tobytes()

    @staticmethod
    def places(text: bytes, ranges: list[int], length: int) -> list[tuple[int, int]]:
        if not ranges:
            return []
        words = [m.span() for m in _WORD.finditer(text)]
        return [(words[a][0], words[b + length - 1][1]) for a, b in zip(ranges[::2], ranges[1::2])]
