"""Suffix arrays by linear grouping.

Suffixes are grouped by their longest Lyndon prefix. Groups start as those of
the first symbol and are taken from the largest down: every suffix of a group
points to the nearest suffix before it that belongs to a smaller group, and the
suffixes pointed to move to a new group right behind their old one, because
their Lyndon prefix now goes on with the group's (further behind, the more of
the group point to them). Once all groups are final, a pass from the smallest
suffix up puts every suffix whose Lyndon prefix ends there into the next free
place of its group. Nothing is renamed or solved recursively.
"""

from __future__ import annotations


def suffix_array(symbols: list[int]) -> list[int]:
    """The starts of all suffixes in order; the last symbol must be smaller than all others."""
    n = len(symbols)
    if n < 2:
        return list(range(n))
    order = sorted(range(n), key=symbols.__getitem__)
    place = [0] * n  # where a suffix stands in order
    first = [0] * n  # where its group begins
    size = [0] * n  # by beginning of a group: how many it has
    begin = 0
    for spot, suffix in enumerate(order):
        if spot and symbols[suffix] != symbols[order[spot - 1]]:
            begin = spot
        place[suffix] = spot
        first[suffix] = begin
        size[begin] += 1
    smaller = [-1] * n  # the nearest suffix before it in a smaller group

    end = n
    while end > 0:
        begin = first[order[end - 1]]
        members = order[begin:end]
        if len(members) > 1:
            members.sort()
        pointed: dict[int, int] = {}
        for suffix in members:
            before = suffix - 1
            while before >= 0 and first[before] >= begin:
                before = smaller[before]
            smaller[suffix] = before
            if before >= 0:
                pointed[before] = pointed.get(before, 0) + 1
        if pointed:
            by_times: dict[int, list[int]] = {}
            for suffix, times in pointed.items():
                by_times.setdefault(times, []).append(suffix)
            for times in sorted(by_times, reverse=True):
                moved: dict[int, int] = {}
                for suffix in by_times[times]:
                    old = first[suffix]
                    back = moved.get(old, 0)
                    last = old + size[old] - 1 - back
                    other, at = order[last], place[suffix]
                    order[at], order[last] = other, suffix
                    place[other], place[suffix] = at, last
                    moved[old] = back + 1
                for old, count in moved.items():
                    new = old + size[old] - count
                    if new == old:
                        continue  # the whole group moved, and stays where it is
                    size[old] -= count
                    size[new] = count
                    for spot in range(new, new + count):
                        first[order[spot]] = new
        end = begin

    out = [-1] * n
    free = first.copy()  # by beginning of a group: its next free place
    for begin in set(first):
        free[begin] = begin
    placed = bytearray(n)
    out[0] = n - 1
    placed[n - 1] = 1
    free[0] = 1
    for spot in range(n):
        suffix = out[spot] - 1
        while suffix >= 0 and not placed[suffix]:
            begin = first[suffix]
            out[free[begin]] = suffix
            free[begin] += 1
            placed[suffix] = 1
            suffix = smaller[suffix]
    return out
