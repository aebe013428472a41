"""Suffix arrays of integer sequences, in numpy.

Suffixes are sorted by prefix doubling; only those that are not yet told apart are sorted again,
so the work follows the repeats. The ranks of every round are kept: two suffixes agree in their
first h symbols if their ranks of round h do, which gives common prefixes without a scan.
"""

from __future__ import annotations

import numpy as np


class Suffixes:
    """``order`` (suffix array), ``place`` (its inverse) and ranks by prefix length 1, 2, 4, ..."""

    def __init__(self, codes: np.ndarray):
        n = len(codes)
        order = np.argsort(codes, kind="stable")
        ordered = codes[order]
        new = np.ones(n, bool)
        new[1:] = ordered[1:] != ordered[:-1]
        at = np.arange(n, dtype=np.int32)
        # A rank is the first place of its group in the order; one past the end ranks lowest.
        rank = np.full(n + 1, -1, np.int32)
        rank[order] = np.maximum.accumulate(np.where(new, at, 0))
        self.ranks = [rank]
        h = 1
        alone = new & np.append(new[1:], True)
        open_ = np.flatnonzero(~alone)
        while len(open_):
            members = order[open_]
            key = rank[members].astype(np.int64) * (n + 1) + rank[np.minimum(members + h, n)] + 1
            by_key = np.argsort(key, kind="stable")
            members, key = members[by_key], key[by_key]
            order[open_] = members
            first = np.ones(len(key), bool)
            first[1:] = key[1:] != key[:-1]
            rank = rank.copy()
            rank[members] = np.maximum.accumulate(np.where(first, open_, 0))
            self.ranks.append(rank)
            alone = first & np.append(first[1:], True)
            open_ = open_[~alone]
            h *= 2
        self.order, self.place = order, rank[:n]

    def common(self) -> np.ndarray:
        """Length of the common prefix of each suffix in the order with the one before it; -1 first."""
        n = len(self.order)
        out = np.zeros(n, np.int32)
        if n:
            first = self.ranks[0]
            k = np.flatnonzero(first[self.order[1:]] == first[self.order[:-1]]) + 1
            a, b = self.order[k - 1].astype(np.int64), self.order[k].astype(np.int64)
            length = np.zeros(len(k), np.int32)
            for level in range(len(self.ranks) - 1, -1, -1):
                rank, h = self.ranks[level], 1 << level
                same = rank[a] == rank[b]
                length += same * h
                a, b = np.minimum(a + same * h, n), np.minimum(b + same * h, n)
            out[k] = length
            out[0] = -1
        return out


def sides(common: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For cuts ``at`` of the order: first place left, and one past the last place right of the cut,
    up to where the common prefix is shorter (on the left: or as long, so that every interval of
    equal prefixes is cut into pairs of sides, one after the other)."""
    n = len(common)
    levels = [common]
    while 2 << (len(levels) - 1) <= n:
        h = 1 << (len(levels) - 1)
        below = levels[-1]
        levels.append(np.minimum(below[: n - 2 * h + 1], below[h : n - h + 1]))
    mine = common[at]
    left, right = at.copy(), at + 1
    for level in range(len(levels) - 1, -1, -1):
        h, least = 1 << level, levels[level]
        here = np.maximum(left - h, 0)
        left -= np.where((left >= h) & (least[np.minimum(here, len(least) - 1)] > mine), h, 0)
        fits = right + h <= n
        right += np.where(fits & (least[np.minimum(right, len(least) - 1)] >= mine), h, 0)
    return left - 1, right
