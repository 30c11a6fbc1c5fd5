"""Sorted suffix runs: front coding, LCP-aware loser-tree merging, and what repeats inside a merged group.

A run is a sorted list of strings kept as (length of the prefix shared with the
string before, rest). Runs are merged by a tournament tree of losers in which every
contender knows how many leading bytes it shares with the last winner: two of them
with different counts are ordered without looking at a byte, and equal counts are
compared from that place on, so no known prefix is compared again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np


def common_prefix(a: bytes, b: bytes, start: int = 0) -> int:
    """Length of the common prefix, given that ``start`` bytes are known to agree."""
    lo, hi = start, min(len(a), len(b))
    if a[lo:hi] == b[lo:hi]:
        return hi
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo


def front_code(strings: list[bytes]) -> tuple[list[int], list[bytes]]:
    """(shared prefix lengths, rests) of sorted strings."""
    lcps, rests, prev = [], [], b""
    for s in strings:
        k = common_prefix(prev, s)
        lcps.append(k)
        rests.append(s[k:])
        prev = s
    return lcps, rests


def front_decode(lcps: list[int], rests: list[bytes]) -> Iterator[tuple[int, bytes]]:
    """(shared prefix length, string) of a run, one at a time."""
    prev = b""
    for k, rest in zip(lcps, rests):
        prev = prev[:k] + rest
        yield k, prev


def merge_runs(runs: list[tuple[list[int], list[bytes]]]) -> Iterator[tuple[int, bytes, int, int]]:
    """(shared prefix with the string before, string, run, place in run) over all runs in sorted order."""
    streams = [enumerate(front_decode(*r)) for r in runs]
    size = 1
    while size < max(1, len(runs)):
        size *= 2
    # a contender: [string, bytes shared with the last winner, run, place]; None: the run is at its end
    def pull(run: int):
        got = next(streams[run], None) if run < len(streams) else None
        return None if got is None else [got[1][1], got[1][0], run, got[0]]

    def play(a, b):
        """(winner, loser); both counts refer to the same earlier winner, and the loser's then to this one."""
        if a is None or b is None:
            return (b, a) if a is None else (a, b)
        if a[1] != b[1]:
            return (a, b) if a[1] > b[1] else (b, a)
        k = common_prefix(a[0], b[0], a[1])
        if (a[0][k:k + 1], a[2]) <= (b[0][k:k + 1], b[2]):
            b[1] = k
            return a, b
        a[1] = k
        return b, a

    losers: list = [None] * size

    def build(node: int):
        if node >= size:
            first = pull(node - size)
            if first is not None:
                first[1] = 0
            return first
        win, losers[node] = play(build(2 * node), build(2 * node + 1))
        return win

    winner = build(1)
    while winner is not None:
        yield winner[1], winner[0], winner[2], winner[3]
        node = (winner[2] + size) // 2
        challenger = pull(winner[2])  # what it shares with the string before it in its run, which has just won
        while node:
            challenger, losers[node] = play(challenger, losers[node])
            node //= 2
        winner = challenger


PAIRWISE = 16  # groups up to this size are compared pair by pair


def repeated_offsets(right: list[bytes], lcps: list[int], left: list[bytes], low: list[int], high: list[int],
                     length: int) -> list[list[tuple[int, int]]]:
    """For strings around a common anchor: the offsets j at which a window of ``length`` bytes repeats, as closed intervals.

    ``right[i]`` is the text from the anchor on (sorted; ``lcps[i]`` shared with the one before), ``left[i]`` the
    text before it read backwards. Window j of string i, ``low[i] <= j <= high[i]``, is the last j bytes before the anchor
    and the first ``length - j`` from it; it repeats if another string has the same window j.
    """
    m = len(right)
    if m <= PAIRWISE:
        out: list[list[tuple[int, int]]] = [[] for _ in range(m)]
        for a in range(m):
            shared = length
            for b in range(a + 1, m):
                shared = min(shared, lcps[b])
                lo = max(length - shared, low[a], low[b])
                hi = min(high[a], high[b])
                if lo <= hi:
                    hi = min(hi, common_prefix(left[a], left[b]))
                    if lo <= hi:
                        out[a].append((lo, hi))
                        out[b].append((lo, hi))
        return out
    lo, hi = np.array(low), np.array(high)
    js = np.arange(lo.min(), hi.max() + 1)
    order = sorted(range(m), key=left.__getitem__)
    left_lcp = np.array([0] + [common_prefix(left[x], left[y]) for x, y in zip(order, order[1:])])
    right_lcp = np.array([0, *lcps[1:]])
    rows: list[list[int]] = [[] for _ in range(m)]
    step = max(1, (1 << 21) // m)
    for at in range(0, len(js), step):
        j = js[at:at + step, None]
        right_class = np.cumsum(right_lcp < length - j, axis=1)
        left_class = np.empty_like(right_class)
        left_class[:, order] = np.cumsum(left_lcp < j, axis=1)
        own = (j >= lo) & (j <= hi)
        key = ((j - js[0]) * (m + 1) + right_class) * (m + 1) + left_class
        _, back, count = np.unique(key[own], return_inverse=True, return_counts=True)
        again = np.zeros(own.shape, dtype=bool)
        again[own] = count[back] > 1
        for r, c in zip(*np.nonzero(again.T)):
            rows[r].append(int(js[at + c]))
    out = []
    for r in rows:
        spans: list[list[int]] = []
        for j in r:
            if spans and spans[-1][1] == j - 1:
                spans[-1][1] = j
            else:
                spans.append([j, j])
        out.append([tuple(s) for s in spans])
    return out
