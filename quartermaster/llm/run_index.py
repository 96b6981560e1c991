"""A run-length index of a byte string: its Burrows-Wheeler transform kept as
runs, with suffix positions sampled at the ends of the runs.

The longest match of each suffix with its neighbour in suffix order changes
in a known way along the text: where the transform's character is the same
as the neighbour's, the match of the next text position is one shorter. So
matches need comparing only at the samples (as many as there are runs), and
streaming over the text gives the rest: the matching statistics of the text
against its other positions.
"""

from __future__ import annotations

import numpy as np

#: separator of strings in one index; no UTF-8 text holds it
SEPARATOR = 0xFF


def _words(text: np.ndarray) -> np.ndarray:
    """At each position its 8 bytes (zeros past the end), big-endian."""
    padded = np.concatenate((text, np.zeros(8, np.uint8)))
    w = np.zeros(len(text), np.uint64)
    for i in range(8):
        w = w << np.uint64(8) | padded[i:i + len(text)]
    return w


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Positions of all suffixes in order, by prefix doubling from 8 bytes
    on; only suffixes that are still tied are sorted again."""
    n = len(text)
    words = _words(text)
    order = np.argsort(words)
    same = words[order[1:]] == words[order[:-1]]
    rank = np.empty(n, np.int64)
    start = np.flatnonzero(np.concatenate(([True], ~same)))
    at = np.repeat(start, np.diff(np.append(start, n)))
    rank[order] = at  # a tied suffix has the first place of its ties
    h = 8
    while h < n:
        tied = np.flatnonzero(np.concatenate((same, [False])) | np.concatenate(([False], same)))
        if not len(tied):
            break
        own = order[tied]
        follow = own + h
        key = np.where(follow < n, rank[np.minimum(follow, n - 1)] + 1, 0)
        key += at[tied] * (n + 1)
        by = np.argsort(key)
        order[tied] = own[by]
        key = key[by]
        equal = key[1:] == key[:-1]
        # positions of ``tied`` are runs of places; a new rank starts wherever the key changes
        first = np.concatenate(([True], ~equal))
        at[tied] = tied[np.maximum.accumulate(np.where(first, np.arange(len(tied)), 0))]
        same[:] = False
        inner = tied[1:][equal]
        same[inner - 1] = True
        rank[order[tied]] = at[tied]
        h *= 2
    return order


class RunIndex:
    """The run-compressed transform of ``text`` with sampled run ends."""

    def __init__(self, text: np.ndarray):
        self.text = text
        order = suffix_order(text)
        bwt = np.where(order > 0, text[order - 1], 0).astype(np.int16)
        bwt[order == 0] = -1
        new = np.concatenate(([True], bwt[1:] != bwt[:-1])) if len(bwt) else np.empty(0, bool)
        self.heads = np.flatnonzero(new)  # first row of each run
        self.symbols = bwt[self.heads]
        ends = np.append(self.heads[1:], len(bwt))[:len(self.heads)] - 1
        # samples: suffix at each run's first and last row, and its neighbour in the next run
        self.first, self.last = order[self.heads], order[ends]
        self._words = _words(text)

    def _common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Longest common prefixes of suffixes, 8 bytes at a time."""
        n = len(self.text)
        length = np.zeros(len(a), np.int64)
        left = np.arange(len(a))
        while len(left):
            x, y = a[left] + length[left], b[left] + length[left]
            ok = (x < n) & (y < n)
            left, x, y = left[ok], x[ok], y[ok]
            differ = self._words[x] ^ self._words[y]
            whole = differ == 0
            length[left[whole]] += 8
            part = ~whole
            # leading equal bytes: the highest differing byte
            high = np.floor(np.log2(differ[part].astype(np.float64) + 0.5)).astype(np.int64) if part.any() else np.empty(0, np.int64)
            length[left[part]] += 7 - np.minimum(high, 63) // 8
            left = left[whole]
        return np.minimum(length, n - np.maximum(a, b))

    def matching_statistics(self) -> np.ndarray:
        """For each position the length of the longest string that starts
        there and also at another position."""
        n = len(self.text)
        best = np.zeros(n, np.int64)
        if not n:
            return best
        # neighbour above: differs in its symbol at the first row of each run but the first;
        # neighbour below: at the last row of each run but the last
        # (the first row has none above, the last none below: nothing matches)
        sides = ((self.first[1:], self.last[:-1], self.first[0]), (self.last[:-1], self.first[1:], self.last[-1]))
        for own, other, lone in sides:
            at = np.full(n, -1)  # where the match of a sampled position ends
            at[own] = self._common(own, other) + own
            at[lone] = lone
            known = at >= 0
            source = np.maximum.accumulate(np.where(known, np.arange(n), -1))
            reach = np.where(source >= 0, at[np.maximum(source, 0)], np.arange(n))
            best = np.maximum(best, reach - np.arange(n))
        return best
