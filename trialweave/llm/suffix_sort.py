"""Suffix sorting in linear time by grouping.

Suffixes are grouped by their first symbol, and groups are processed in descending order. The pointer of a suffix leads to
the nearest suffix before it in a smaller group. Suffixes that a group's members point to grow by that group's common beginning, which
turns every group into the suffixes of one Lyndon prefix; those pointed to more often grow more and come behind. Then the order
within the groups is emitted in one ascending sweep: whenever a suffix is placed, the ones that end with it as next smaller
suffix, found along the pointers, are the next of their groups. Nothing is renamed or sorted recursively.
"""

from __future__ import annotations

import numpy as np


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Order of the suffixes of whole numbers whose last symbol is the only smallest one."""
    n = len(symbols)
    if n == 0:
        return np.empty(0, np.int64)
    first = np.argsort(symbols, kind="stable")
    in_order = symbols[first]
    starts = np.flatnonzero(np.concatenate([[True], in_order[1:] != in_order[:-1]]))
    start_of = np.repeat(starts, np.diff(np.append(starts, n)))
    place = np.empty(n, np.int64)
    place[first] = np.arange(n)
    group = np.empty(n, np.int64)
    group[first] = start_of
    count = np.zeros(n, np.int64)
    count[starts] = np.diff(np.append(starts, n))
    order, place, group, count = first.tolist(), place.tolist(), group.tolist(), count.tolist()
    before = [-1] * n

    end = n - 1
    while end >= 0:
        low = group[order[end]]
        if low == end:
            members = (order[end],)
        else:
            members = sorted(order[low : end + 1])
        asked: dict[int, int] = {}
        for i in members:
            j = i - 1
            while j >= 0:
                g = group[j]
                if g < low:
                    break
                j = before[j]
                if g == low:
                    break
            before[i] = j
            if j >= 0:
                asked[j] = asked.get(j, 0) + 1
        if asked:
            if len(asked) == 1:
                rounds = (tuple(asked),)
            else:
                by_times: dict[int, list[int]] = {}
                for j, times in asked.items():
                    by_times.setdefault(times, []).append(j)
                rounds = [by_times[t] for t in sorted(by_times, reverse=True)]
            for grown in rounds:
                for j in grown:  # to the end of their group
                    g = group[j]
                    count[g] -= 1
                    last = g + count[g]
                    at = place[j]
                    if at != last:
                        other = order[last]
                        order[at], order[last] = other, j
                        place[other], place[j] = at, last
                new = [group[j] + count[group[j]] for j in grown]
                for j, g in zip(grown, new):
                    group[j] = g
                    count[g] += 1
        end = low - 1

    out = [0] * n
    out[0] = n - 1
    done = [False] * n
    done[n - 1] = True
    free = list(range(n))
    free[group[n - 1]] += 1
    for i in range(n):
        j = out[i] - 1
        while j >= 0 and not done[j]:
            g = group[j]
            out[free[g]] = j
            free[g] += 1
            done[j] = True
            j = before[j]
    return np.array(out, np.int64)
