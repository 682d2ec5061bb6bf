"""Suffix array of many short sequences by linear grouping.

Suffixes are kept in groups, ordered as their common prefix so far (a Lyndon
prefix). Groups are processed in descending order. For every suffix of a group
its previous-smaller pointer leads to the nearest suffix on its left that
stands in a lower group; that suffix's prefix grows by the group's prefix, once
for each pointer that meets it, so those with more pointers go to a higher new
group right behind their old one. When all groups are done, each holds the
suffixes of one Lyndon prefix. The order inside the groups is then emitted from
the smallest suffix up: the suffix on its left, and those its pointers chain
to, take the next free place of their group. No suffix is ever renamed or
sorted again.

Sequences do not reach into each other: a sequence's end is smaller than any
symbol, and ends are ordered as the sequences are.
"""

from __future__ import annotations

import numpy as np


def suffix_array(symbols: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Starts of all suffixes in lexicographic order.

    ``symbols`` is the concatenation of the sequences, ``starts`` the place
    where each begins (ascending, the first is 0, none is empty).
    """
    n = len(symbols)
    if not n:
        return np.zeros(0, dtype=np.int64)
    order = np.argsort(symbols, kind="stable")
    ranked = symbols[order]
    head = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
    group_of = np.empty(n, dtype=np.int64)
    group_of[order] = np.repeat(head, np.diff(np.append(head, n)))
    suffixes: list[int] = order.tolist()
    group: list[int] = group_of.tolist()
    place_of = np.empty(n, dtype=np.int64)
    place_of[order] = np.arange(n)
    place: list[int] = place_of.tolist()
    end = dict(zip(head.tolist(), np.append(head[1:], n).tolist()))
    # -1: not known yet; a sequence's first suffix has none on its left
    left = np.arange(-1, n - 1)
    left[starts] = -2
    left: list[int] = left.tolist()  # left neighbour, -2 at a sequence's start
    smaller = [-1] * n

    top = n
    while top:
        start = group[suffixes[top - 1]]
        met: dict[int, int] = {}
        for s in suffixes[start:top]:
            p = left[s]
            while p >= 0 and group[p] >= start:
                q = smaller[p]
                p = left[p] if q == -1 else q
            smaller[s] = p
            if p >= 0:
                met[p] = met.get(p, 0) + 1
        if met:
            if len(met) == 1:
                levels = [list(met)]
            else:
                most = max(met.values())
                levels = [list(met)] if most == 1 else [
                    [p for p, k in met.items() if k == times] for times in range(most, 0, -1)]
            for level in levels:
                tails: dict[int, int] = {}
                for p in level:
                    g = group[p]
                    tail = tails.get(g)
                    if tail is None:
                        tail = end[g]
                    tail -= 1
                    tails[g] = tail
                    at = place[p]
                    if at != tail:
                        other = suffixes[tail]
                        suffixes[tail], suffixes[at] = p, other
                        place[p], place[other] = tail, at
                for g, tail in tails.items():
                    if tail != g:
                        stop = end[g]
                        end[tail], end[g] = stop, tail
                        for p in suffixes[tail:stop]:
                            group[p] = tail
        top = start

    free = {g: g for g in end}
    out = [-1] * n
    waiting = [True] * n
    lasts = (np.append(starts[1:], n) - 1).tolist()

    def settle(p: int) -> None:
        while p >= 0 and waiting[p]:
            g = group[p]
            out[free[g]] = p
            free[g] += 1
            waiting[p] = False
            p = smaller[p]

    for p in lasts:
        settle(p)
    for i in range(n):
        p = left[out[i]]
        if p >= 0 and waiting[p]:
            settle(p)
    return np.array(out, dtype=np.int64)
