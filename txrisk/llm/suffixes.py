"""Suffix arrays over the words of many texts at once, by prefix doubling in numpy.

Texts of a block are laid end to end with a separator before, between and after them. A word is numbered together
with its text, so no match leaves a text. `ranks[k]` orders positions by their next 2^k words: equal numbers mean
equal words. Positions whose number is their own already aren't sorted again, so texts without long
repeats cost a few rounds over few positions.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa


class Suffixes:
    """The words of `texts` (UTF-8), and their suffixes in order.

    `starts[t]` is the place of text `t`'s first word and `sizes[t]` its number of words; the word before the first
    and the one after the last are separators, equal to nothing. Words are runs of bytes other than x20 and x09-x0D.
    """

    def __init__(self, texts: list[bytes]) -> None:
        split = [text.split() for text in texts]
        self.words = [word for words in split for word in words]
        self.sizes = np.fromiter(map(len, split), np.int64, len(split))
        self.starts = np.cumsum(self.sizes + 1) - self.sizes
        n = len(self.words) + len(split) + 1
        words = pa.array(self.words, pa.large_binary()).dictionary_encode()
        codes, many = words.indices.to_numpy(zero_copy_only=False), len(words.dictionary)
        keys = np.arange(-1, -n - 1, -1, np.int64)  # separators: each its own
        self.places = np.arange(len(codes)) + np.repeat(np.arange(1, len(split) + 1), self.sizes)
        keys[self.places] = np.repeat(np.arange(len(split)), self.sizes) * many + codes
        self.ranks = _doubled(keys)

    def order(self) -> np.ndarray:
        """Positions in the order of their suffixes."""
        order = np.empty(len(self.ranks[-1]), np.int64)
        order[self.ranks[-1]] = np.arange(len(order))
        return order

    def common(self, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(rank, position, length) where the suffix at a rank shares `least` words or more with the next in order."""
        level = least.bit_length() - 1
        order = self.order()
        if level >= len(self.ranks):
            none = np.zeros(0, np.int64)
            return none, none, none
        same = self.ranks[level][order]
        at = np.flatnonzero(same[:-1] == same[1:])
        i, j = order[at], order[at + 1]
        length = np.zeros(len(at), np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):
            length += (self.ranks[k][i + length] == self.ranks[k][j + length]).astype(np.int64) << k
        found = length >= least
        return at[found], i[found], length[found]


def _doubled(keys: np.ndarray) -> list[np.ndarray]:
    """Ranks by the first 1, 2, 4, … symbols, up to where all differ. A rank is its group's first place in order."""
    n = len(keys)
    order = np.argsort(keys)
    group = _group_starts(keys[order])
    rank = np.empty(n, np.int32)
    rank[order] = group
    ranks, open_ = [rank], order[_shared(group)]
    size = 1
    while len(open_):
        # Members of a group of two or more don't reach a separator within `size`, so `size` further there is a symbol.
        key = rank[open_].astype(np.int64) * n + rank[open_ + size]
        order = np.argsort(key)
        open_, key = open_[order], key[order]
        old = rank[open_]
        group = _group_starts(key)
        rank = rank.copy()
        rank[open_] = old + (group - _group_starts(old))
        ranks.append(rank)
        open_ = open_[_shared(group)]
        size *= 2
    return ranks


def _group_starts(values: np.ndarray) -> np.ndarray:
    """For each value in order, the place of the first that equals it."""
    if not len(values):
        return np.zeros(0, np.int64)
    new = np.append(True, values[1:] != values[:-1])
    return np.maximum.accumulate(np.where(new, np.arange(len(values)), 0))


def _shared(group: np.ndarray) -> np.ndarray:
    """Whether another value is in the same group."""
    next_same = np.append(group[1:] == group[:-1], False)
    return next_same | np.append(False, next_same[:-1])
