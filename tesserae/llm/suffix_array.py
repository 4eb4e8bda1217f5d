"""Linear suffix sorting by grouping.

Suffixes are grouped by the longest prefix that is a Lyndon word. Groups are handled from the greatest
to the least; each suffix of a group points to the nearest suffix before it that is still in a lesser
group, and the suffixes pointed to move, by the number of pointers they get, to new groups right after
their own. In the end the groups are in order, and a suffix is a Lyndon word followed by a lesser
suffix. So one pass from the least suffix upwards, which appends to each group the suffixes that
continue with the suffix just placed, puts every group in order.
"""

from __future__ import annotations

from collections.abc import Sequence


def suffix_array(text: Sequence[int]) -> list[int]:
    """Starts of the suffixes of ``text``, integers of 1 or more, in ascending order."""
    n = len(text)
    if not n:
        return []
    # position n holds a symbol less than all others; its group is number 0
    group = [0] * (n + 1)
    symbols = {s: k for k, s in enumerate(sorted(set(text)), 1)}
    members: list[list[int]] = [[n]] + [[] for _ in symbols]
    for i, s in enumerate(text):
        group[i] = g = symbols[s]
        members[g].append(i)
    size = [1] * len(members)  # symbols in the common Lyndon prefix
    before = list(range(-1, len(members) - 1))
    after = list(range(1, len(members) + 1))
    after[-1] = -1
    waiting = list(range(-1, n + 1))  # place i+1: nearest place at or before i in a group still to come
    waiting[0] = 0
    for i in range(n + 1):
        waiting[i + 1] = i + 1

    order: list[tuple[int, list[int]]] = []
    g = len(members) - 1
    while g > 0:
        own = members[g]
        if len(own) > 1 or (own and group[own[0]] != g):
            own = [i for i in own if group[i] == g]
        if not own:
            g = before[g]
            continue
        order.append((g, own))
        for i in own:
            waiting[i + 1] = i
        pointers: dict[int, int] = {}
        for i in own:
            root = i
            while waiting[root] != root:
                root = waiting[root]
            while waiting[i] != root:
                waiting[i], i = root, waiting[i]
            if root:
                pointers[root - 1] = pointers.get(root - 1, 0) + 1
        length = size[g]
        by_count: dict[int, list[int]] = {}
        for j, c in pointers.items():
            by_count.setdefault(c, []).append(j)
        for c in sorted(by_count, reverse=True):
            moved: dict[int, int] = {}
            for j in by_count[c]:
                old = group[j]
                new = moved.get(old)
                if new is None:
                    new = moved[old] = len(members)
                    members.append([])
                    size.append(size[old] + c * length)
                    follows = after[old]
                    before.append(old)
                    after.append(follows)
                    after[old] = new
                    if follows >= 0:
                        before[follows] = new
                members[new].append(j)
                group[j] = new
        g = before[g]

    place = [0] * len(members)
    at = 1
    for g, own in reversed(order):
        place[g] = at
        at += len(own)
    # suffixes that continue with suffix i once their Lyndon word is read
    first, then = [-1] * (n + 1), [-1] * (n + 1)
    for i in range(n):
        k = i + size[group[i]]
        then[i], first[k] = first[k], i
    out = [n] * (n + 1)
    for r in range(n + 1):
        i = first[out[r]]
        while i >= 0:
            g = group[i]
            out[place[g]] = i
            place[g] += 1
            i = then[i]
    return out[1:]
