"""Character n-grams of words as rolling hashes, many words at a time.

Words stand between blanks in one array of code points. A gram of ``m``
characters that ends at a place has the hash of the gram of ``m - 1``
characters before it times ``BASE`` plus its last character; grams do not
reach beyond the blank before their word. The gram without its first character
and the one without its last come from the same arrays.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

import numpy as np

BASE = np.uint64(0x9E3779B97F4A7C15)
LETTERS = re.compile(r"[^\W\d_]+")


def letter_runs(token: str) -> list[str]:
    return LETTERS.findall(token)


class Grams:
    """``hash[m]`` for m in 1..order, with ``reach``: the longest gram at each place; ``owner``: its word."""

    def __init__(self, words: Iterable[str], order: int):
        text = " " + " ".join(words) + " "
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        blank = codes == 32
        place = np.arange(len(codes))
        before = np.concatenate([[0], np.maximum.accumulate(np.where(blank, place, 0))[:-1]])
        self.reach = place - before + 1
        self.reach[0] = 0  # the first blank ends no word
        self.owner = np.concatenate([[0], np.cumsum(blank)[:-1] - 1])
        self.hash = [np.zeros(0, np.uint64), codes]
        for _ in range(2, order + 1):
            last = self.hash[-1]
            longer = codes.copy()
            longer[1:] += last[:-1] * BASE
            self.hash.append(longer)

    def at(self, m: int) -> np.ndarray:
        """Places where a gram of m characters ends."""
        return np.flatnonzero(self.reach >= m)


def find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each wanted value stands in the sorted keys, and whether it does."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted
