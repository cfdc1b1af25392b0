"""A word-level FM-index in numpy: suffix array by prefix doubling, a wavelet
matrix over the Burrows-Wheeler transform, backward search and locating by
sampled suffix positions.  All patterns of a call are searched together."""

from __future__ import annotations

import numpy as np

SAMPLE = 32


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffix array of a text whose last symbol is its only 0.  Each round
    doubles the compared length and sorts only suffixes still tied."""
    n = len(text)
    order = np.argsort(text, kind="stable")
    first = np.concatenate([[True], text[order][1:] != text[order][:-1]])
    starts = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[order] = starts
    active = order[_tied(first)]
    h = 1
    while len(active):
        key = rank[active] * (n + 1) + rank[np.minimum(active + h, n - 1)]
        o = np.argsort(key, kind="stable")
        active, key = active[o], key[o]
        old = key // (n + 1)
        at = np.arange(len(active))
        new_old = np.concatenate([[True], old[1:] != old[:-1]])
        new_key = np.concatenate([[True], key[1:] != key[:-1]])
        old_at = np.maximum.accumulate(np.where(new_old, at, 0))
        key_at = np.maximum.accumulate(np.where(new_key, at, 0))
        rank[active] = old + key_at - old_at
        active = active[_tied(new_key)]
        h *= 2
    sa = np.empty(n, np.int64)
    sa[rank] = np.arange(n)
    return sa


def _tied(first: np.ndarray) -> np.ndarray:
    """Members of groups of two or more, given the group starts."""
    last = np.concatenate([first[1:], [True]])
    return ~(first & last)


class FMIndex:
    """Index of ``text`` (int64 symbols from 1; 0 is added as the end)."""

    def __init__(self, text: np.ndarray, sigma: int):
        t = np.concatenate([text.astype(np.int64), [0]])
        n = self.n = len(t)
        sa = suffix_array(t)
        seq = t[sa - 1]
        self.before = np.concatenate([[0], np.cumsum(np.bincount(t, minlength=sigma + 1))])
        self.sampled = sa % SAMPLE == 0
        self.sample_rank = np.concatenate([[0], np.cumsum(self.sampled)])
        self.samples = sa[self.sampled]
        self.levels = []
        for bit in range(max(1, int(sigma).bit_length()) - 1, -1, -1):
            one = (seq >> bit) & 1 == 1
            zeros = np.concatenate([[0], np.cumsum(~one)]).astype(np.int32)
            self.levels.append((bit, zeros, int(zeros[-1])))
            seq = np.concatenate([seq[~one], seq[one]])

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of symbol ``c`` in the first ``i`` places of the transform."""
        lo = np.zeros_like(i)
        for bit, zeros, total in self.levels:
            one = (c >> bit) & 1 == 1
            zi, zl = zeros[i], zeros[lo]
            i = np.where(one, total + i - zi, zi)
            lo = np.where(one, total + lo - zl, zl)
        return i - lo

    def symbol(self, i: np.ndarray) -> np.ndarray:
        """The transform's symbol at place ``i``."""
        c = np.zeros_like(i)
        for bit, zeros, total in self.levels:
            zi = zeros[i].astype(np.int64)
            one = zeros[i + 1] == zi
            c |= one.astype(np.int64) << bit
            i = np.where(one, total + i - zi, zi)
        return c

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges [lo, hi) of patterns of one length, a row each."""
        lo = np.zeros(len(patterns), np.int64)
        hi = np.full(len(patterns), self.n, np.int64)
        live = np.arange(len(patterns))
        for j in range(patterns.shape[1] - 1, -1, -1):
            c = patterns[live, j]
            lo[live] = self.before[c] + self.rank(c, lo[live])
            hi[live] = self.before[c] + self.rank(c, hi[live])
            live = live[lo[live] < hi[live]]
        hi = np.maximum(hi, lo)
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix-array rows: step back to a sampled row."""
        out = np.zeros(len(rows), np.int64)
        at, left, steps = rows.copy(), np.arange(len(rows)), 0
        while len(left):
            hit = self.sampled[at]
            out[left[hit]] = self.samples[self.sample_rank[at[hit]]] + steps
            at, left = at[~hit], left[~hit]
            c = self.symbol(at)
            at = self.before[c] + self.rank(c, at)
            steps += 1
        return out
