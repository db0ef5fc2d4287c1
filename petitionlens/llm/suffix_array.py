"""Linear-time suffix sorting by grouping (after U. Baier, "Linear-time Suffix Sorting", 2016).

Phase 1 sorts the suffixes into groups of equal longest Lyndon prefix: groups
are handled in descending order, and a finished group refines the groups of its
members' previous-smaller positions.  Phase 2 takes the suffixes from the
smallest up and places, for each, the chain of previous-smaller positions whose
Lyndon prefix ends there.  Nothing is renamed and nothing recurses.
"""

from __future__ import annotations


def lyndon_groups(text: list[int]) -> tuple[list[int], list[int], list[list[int]]]:
    """Group number of each position, its previous smaller position (-1: none),
    and the members of the groups in descending order."""
    n = len(text)
    symbols = sorted(set(text))
    number = {c: i for i, c in enumerate(symbols)}
    group = [number[c] for c in text]
    members: list[list[int]] = [[] for _ in symbols]
    for i, g in enumerate(group):
        members[g].append(i)
    up = [*range(1, len(symbols)), -1]  # neighbours in the order of the groups
    down = list(range(-1, len(symbols) - 1))
    left = list(range(n))  # leads to the nearest position in no finished group
    prev = [-1] * n
    done: list[list[int]] = []
    g = len(symbols) - 1
    while g >= 0:
        own = [i for i in members[g] if group[i] == g]  # others have moved up since
        members[g] = own
        if own:
            done.append(own)
            for i in own:
                left[i] = i - 1
            count: dict[int, int] = {}
            for i in own:
                j = i - 1
                while j >= 0 and left[j] != j:
                    j = left[j]
                k = i - 1
                while k > j:
                    nxt = left[k]
                    left[k] = j
                    k = nxt
                prev[i] = j
                if j >= 0:
                    count[j] = count.get(j, 0) + 1
            if len(count) == 1:
                (j, c), = count.items()
                moved = {(group[j], c): [j]}
                order = list(moved)
            else:
                moved = {}
                for j, c in count.items():
                    key = (group[j], c)
                    if key in moved:
                        moved[key].append(j)
                    else:
                        moved[key] = [j]
                order = sorted(moved)
            top: dict[int, int] = {}
            for key in order:  # directly above what stays of the old group and its smaller counts
                old, new = key[0], len(members)
                under = top.get(old, old)
                over = up[under]
                members.append(moved[key])
                for j in moved[key]:
                    group[j] = new
                up.append(over)
                down.append(under)
                up[under] = new
                if over >= 0:
                    down[over] = new
                top[old] = new
        g = down[g]
    return group, prev, done


def suffix_array(text: list[int]) -> list[int]:
    """Start positions of the suffixes in ascending order.

    The last symbol must be smaller than all others.
    """
    n = len(text)
    if n < 2:
        return list(range(n))
    group, prev, done = lyndon_groups(text)
    start: dict[int, int] = {}
    at = 0
    for own in reversed(done):
        start[group[own[0]]] = at
        at += len(own)
    order = [0] * n
    placed = bytearray(n)
    order[0] = n - 1
    placed[n - 1] = 1
    for r in range(n):
        i = order[r] - 1
        while i >= 0 and not placed[i]:
            g = group[i]
            at = start[g]
            start[g] = at + 1
            order[at] = i
            placed[i] = 1
            i = prev[i]
    return order
