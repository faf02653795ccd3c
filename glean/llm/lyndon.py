"""Linear suffix sorting by Lyndon prefixes.

Phase 1 groups suffixes by their Lyndon prefix (the longest prefix that is a Lyndon
word). It starts with groups of equal first symbols and takes the groups from the
highest down: a suffix of the group at hand is final, and its Lyndon prefix extends
that of its previous smaller suffix, found by a pointer over the suffixes already
taken; the extended ones leave their group for a new one right above it (those
extended more often still higher). Phase 2 writes the order: a suffix, once written,
places the suffixes whose next smaller one it is, along the same pointers, at the
next free place of their groups. No symbols are renamed and nothing recurs.
"""

from __future__ import annotations

import numpy as np


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Starts of the suffixes of ``text`` (integers; the last one is the unique smallest) in ascending order."""
    n = len(text)
    order = np.argsort(text, kind="stable")
    sorted_ = text[order]
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(sorted_)) + 1, [n]])
    members = [order[a:b].tolist() for a, b in zip(cuts[:-1], cuts[1:])]  # of each group; may hold some that have left
    n_first = len(members)
    group = np.empty(n, np.int64)
    group[order] = np.repeat(np.arange(n_first), np.diff(cuts))
    group = group.tolist()
    lower, upper = list(range(-1, n_first - 1)), [*range(1, n_first), -1]
    smaller = list(range(-1, n - 1))  # to be the previous smaller suffix
    final = bytearray(n)
    g = n_first - 1
    while g >= 0:
        own = [i for i in members[g] if group[i] == g]
        members[g] = own
        for i in own:
            final[i] = 1
        times: dict[int, int] = {}
        for i in own:
            p = smaller[i]
            while p >= 0 and final[p]:
                p = smaller[p]
            smaller[i] = p
            if p >= 0:
                times[p] = times.get(p, 0) + 1
        if times:
            moved: dict[tuple[int, int], list[int]] = {}
            for p, t in times.items():
                moved.setdefault((group[p], t), []).append(p)
            below = {}  # group: the last new group above it
            for h, t in sorted(moved):
                new, under = len(members), below.get(h, h)
                members.append(moved[h, t])
                over = upper[under]
                lower.append(under)
                upper.append(over)
                upper[under] = new
                if over >= 0:
                    lower[over] = new
                below[h] = new
                for p in members[new]:
                    group[p] = new
        g = lower[g]
    # places of the groups, from the lowest up
    place, at = [0] * len(members), 0
    g = 0
    while lower[g] >= 0:
        g = lower[g]
    while g >= 0:
        place[g] = at
        at += sum(1 for i in members[g] if group[i] == g)
        g = upper[g]
    out, placed = [0] * n, bytearray(n)
    out[0] = n - 1
    placed[n - 1] = 1
    for k in range(n):
        j = out[k] - 1
        while j >= 0 and not placed[j]:
            h = group[j]
            out[place[h]] = j
            place[h] += 1
            placed[j] = 1
            j = smaller[j]
    return np.array(out, np.int64)
