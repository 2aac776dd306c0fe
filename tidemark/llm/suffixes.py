"""Suffix arrays by linear grouping, and longest common prefixes.

Suffixes are grouped by their Lyndon prefix, the longest prefix that is smaller than all its
proper suffixes. Groups start as the suffixes of one first symbol and are processed from the
highest down: a member's previous smaller suffix is the last one before it that lies in a lower
group, and those suffixes leave their groups for new ones right above, the higher the more members
point at them. When all groups are processed, each has its final place. A second pass goes through
the order as it comes about: each suffix in turn gives the next place in their groups to the suffix
before it and to that one's chain of previous smaller ones. No part is renamed or sorted again.
"""

from __future__ import annotations


def suffix_array(s: list[int]) -> list[int]:
    """The starts of all suffixes in order. The last symbol must be smaller than all others."""
    n = len(s)
    symbols = {c: g for g, c in enumerate(sorted(set(s)))}
    group = [symbols[c] for c in s]
    members: list[list[int]] = [[] for _ in symbols]
    for i, g in enumerate(group):
        members[g].append(i)
    above = list(range(1, len(members))) + [-1]
    below = [-1, *range(len(members) - 1)]
    before = [-1] * n  # the previous smaller suffix
    done = [False] * n
    order: list[int] = []  # groups as processed, from high to low
    size: dict[int, int] = {}
    now = len(members) - 1
    while now >= 0:
        own = [i for i in members[now] if group[i] == now]
        own.sort()
        pointed: dict[int, int] = {}
        for i in own:
            j = i - 1
            while j >= 0 and (done[j] or group[j] == now):
                j = before[j]
            before[i] = j
            if j >= 0:
                pointed[j] = pointed.get(j, 0) + 1
        for i in own:
            done[i] = True
        if own:
            order.append(now)
            size[now] = len(own)
        parts: dict[tuple[int, int], list[int]] = {}
        for j, times in pointed.items():
            parts.setdefault((-times, group[j]), []).append(j)
        for _, old in sorted(parts):  # those with most pointers first, so they end up highest
            moved = parts[_, old]
            new, up = len(members), above[old]
            members.append(moved)
            above.append(up)
            below.append(old)
            above[old] = new
            if up >= 0:
                below[up] = new
            for j in moved:
                group[j] = new
        now = below[now]
    place, free = 0, {}
    for g in reversed(order):
        free[g] = place
        place += size[g]
    out = [-1] * n
    placed = [False] * n
    out[0] = n - 1
    placed[n - 1] = True
    for k in range(n):
        j = out[k] - 1
        while j >= 0 and not placed[j]:
            g = group[j]
            out[free[g]] = j
            free[g] += 1
            placed[j] = True
            j = before[j]
    return out


def common_prefixes(s: list[int], order: list[int]) -> list[int]:
    """For each place in the order, how many symbols its suffix shares with the one before."""
    n = len(s)
    rank = [0] * n
    for k, i in enumerate(order):
        rank[i] = k
    out = [0] * n
    h = 0
    for i in range(n):
        k = rank[i]
        if k:
            j = order[k - 1]
            while s[i + h] == s[j + h]:
                h += 1
            out[k] = h
            if h:
                h -= 1
        else:
            h = 0
    return out
