"""Suffix arrays in linear time by grouping (no renaming, no recursion)."""

from __future__ import annotations

import numpy as np


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Positions of the suffixes of an array of small non-negative integers, in order.

    First phase: suffixes are in groups by their first symbol, and groups are taken from
    the highest down. For each suffix of a group, the nearest one before it in a lower
    group is its previous smaller one. Those that are previous to the same number of
    suffixes of the group leave their own group for a new one right above it, larger
    numbers above smaller. At the end a group holds the suffixes that share their longest
    Lyndon prefix. Second phase: in ascending order, each suffix puts those that it is the
    next smaller one of into the next free place of their groups.
    """
    n = len(symbols)
    if not n:
        return np.empty(0, np.int64)
    order = np.argsort(symbols, kind="stable")
    first = np.zeros(n, np.int64)
    changed = np.flatnonzero(np.diff(symbols[order])) + 1
    first[changed] = changed
    start_at = np.maximum.accumulate(first)
    size_at = np.zeros(n, np.int64)
    starts = np.concatenate([[0], changed])
    size_at[starts] = np.diff(np.append(starts, n))
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    group = start_at[place].tolist()  # by suffix: where its group starts in the order
    array, place, size = order.tolist(), place.tolist(), size_at.tolist()
    previous = [-1] * n

    top = n - 1
    while top >= 0:
        i = array[top]
        low = group[i]
        if low == top:  # a group of one, as most are in the end
            j = i - 1
            while j >= 0 and group[j] >= low:
                j = previous[j]
            previous[i] = j
            top -= 1
            if j >= 0:
                g = group[j]
                left = size[g] - 1
                if left:
                    size[g] = left
                    high = g + left
                    at, other = place[j], array[high]
                    array[at], array[high] = other, j
                    place[other], place[j] = at, high
                    group[j] = high
                    size[high] = 1
            continue
        members = array[low : top + 1]
        members.sort()
        times: dict[int, int] = {}
        for i in members:
            j = i - 1
            while j >= 0 and group[j] >= low:
                j = previous[j]
            previous[i] = j
            if j >= 0:
                times[j] = times.get(j, 0) + 1
        if len(times) == 1:
            ((j, _),) = times.items()
            _lift([j], group, array, place, size)
        elif times:
            moved: dict[tuple[int, int], list[int]] = {}
            for j, count in times.items():
                key = (-count, group[j])
                if key in moved:
                    moved[key].append(j)
                else:
                    moved[key] = [j]
            # A higher count is moved first and so ends up above the lower ones.
            for key in sorted(moved) if len(moved) > 1 else moved:
                _lift(moved[key], group, array, place, size)
        top = low - 1

    # The empty suffix comes first and is the next smaller one of what ends the text.
    free = group  # by the first suffix placed: next free place, kept at the group's start
    room = list(range(n))
    done = [False] * n
    out = [0] * n
    for at in range(-1, n):
        j = out[at] - 1 if at >= 0 else n - 1
        while j >= 0 and not done[j]:
            g = free[j]
            out[room[g]] = j
            room[g] += 1
            done[j] = True
            j = previous[j]
    return np.array(out, np.int64)


def _lift(
    moved: list[int], group: list[int], array: list[int], place: list[int], size: list[int]
) -> None:
    """Put suffixes of one group into a new group right above what is left of it."""
    low = group[moved[0]]
    left = size[low] - len(moved)
    if not left:
        return
    size[low] = left
    high = low + left
    size[high] = len(moved)
    # Swap them to the end of the group's places.
    end = high + len(moved) - 1
    for j in moved:
        at, other = place[j], array[end]
        array[at], array[end] = other, j
        place[other], place[j] = at, end
        group[j] = high
        end -= 1
