"""Suffix array of an integer string by linear grouping (two phases, no recursion, no renaming).

Phase 1 keeps the suffixes in groups of equal known prefix, in rank order. Groups are taken in descending order;
each member finds its previous smaller suffix (the nearest to the left in a lower group), and the suffixes found are
split off the top of their groups by how many members have pointed to them. At the end a suffix's group
stands for its Lyndon prefix. Phase 2 walks the order from the smallest suffix, and places the suffix to the left of each
one it meets, and the chain of previous smaller pointers from there, at the front of what is free in their groups.
"""

from __future__ import annotations

import numpy as np


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Start positions of the suffixes of ``text`` in ascending order; ``text`` holds integers of any size."""
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    order = np.argsort(text, kind="stable")
    value = text[order]
    head = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]]))
    rank_np = np.zeros(n, np.int64)
    rank_np[order] = np.repeat(head, np.diff(np.append(head, n)))
    place = order.tolist()            # suffixes by group; a group is a slice that starts at its rank
    where = np.empty(n, np.int64)
    where[order] = np.arange(n)
    at, rank = where.tolist(), rank_np.tolist()
    top = [0] * (n + 1)               # by rank of a group: end of its slice
    for a, b in zip(head.tolist(), np.append(head[1:], n).tolist()):
        top[a] = b
    prev = [-1] * n
    end = n
    while end:
        start = rank[place[end - 1]]
        pointed: dict[int, int] = {}
        if end - start == 1:
            i = place[start]
            p = i - 1
            while p >= 0 and rank[p] >= start:
                p = prev[p]
            prev[i] = p
            if p >= 0:
                pointed[p] = 1
        else:
            for i in sorted(place[start:end]):
                p = i - 1
                while p >= 0 and rank[p] >= start:
                    p = prev[p]
                prev[i] = p
                if p >= 0:
                    pointed[p] = pointed.get(p, 0) + 1
        end = start
        if not pointed:
            continue
        if len(pointed) == 1:
            layers = [list(pointed)]
        else:
            by_count: dict[int, list[int]] = {}
            for p, c in pointed.items():
                by_count.setdefault(c, []).append(p)
            layers = [by_count[c] for c in sorted(by_count, reverse=True)]
        for layer in layers:
            size: dict[int, int] = {}
            for p in layer:
                g = rank[p]
                edge = top[g] - 1       # swap p to the top of its group and take it off
                q, k = place[edge], at[p]
                place[edge], place[k] = p, q
                at[p], at[q] = edge, k
                top[g] = edge
                size[g] = size.get(g, 0) + 1
            for g, s in size.items():
                low = top[g]
                if low == g:            # all of the group moved: it keeps its rank
                    top[g] = g + s
                else:
                    top[low] = low + s
                    for k in range(low, low + s):
                        rank[place[k]] = low
    out = [-1] * n
    free = list(range(n))             # by rank of a group: its next free slot
    done = [False] * n

    def put(s: int) -> None:
        while s >= 0 and not done[s]:
            g = rank[s]
            out[free[g]] = s
            free[g] += 1
            done[s] = True
            s = prev[s]

    put(n - 1)                        # left of the end of the text, the smallest suffix of all
    for k in range(n):
        put(out[k] - 1)
    return np.array(out, np.int64)
