"""Suffix arrays by linear grouping.

Suffixes are first grouped by their first symbol. Groups are processed from the largest
down: every suffix of a group finds its previous smaller suffix, and those predecessors,
whose Lyndon prefix grows by the group's, move up to a new group of their own. At the end
a group holds the suffixes with one Lyndon prefix. The order within groups then follows
in one sweep over the array, with no recursion and no renaming.
"""

from __future__ import annotations

import numpy as np


def suffix_array(text: np.ndarray) -> list[int]:
    """The suffixes of ``text`` (integers) in order; a shorter one precedes its extensions."""
    n = len(text) + 1
    symbols = np.append(np.asarray(text, np.int64) - (min(text, default=0) - 1), 0)
    order = np.argsort(symbols, kind="stable")
    firsts = np.flatnonzero(np.diff(symbols[order], prepend=-1))
    sizes = np.diff(np.append(firsts, n))
    group_at = np.repeat(firsts, sizes)
    array = order.tolist()
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    group = group_at[place].tolist()  # the first index of a suffix's group
    place = place.tolist()
    size = np.zeros(n, np.int64)
    size[firsts] = sizes
    previous = _group_by_lyndon_prefix(array, place, group, size.tolist())
    return _order_within_groups(n, group, previous)[1:]


def _group_by_lyndon_prefix(array: list[int], place: list[int], group: list[int], size: list[int]) -> list[int]:
    """Refines the groups in place; returns each suffix's previous smaller suffix, or -1.

    ``size`` is the number of suffixes of the group that starts at an index.
    """
    previous = [-1] * len(array)
    end = len(array)
    while end > 0:
        start = group[array[end - 1]]
        if end - start == 1:
            s = array[start]
            p = s - 1
            while p >= 0 and group[p] > start:
                p = previous[p]
            previous[s] = p
            if p >= 0 and size[group[p]] > 1:
                g = group[p]
                top = g + size[g] - 1
                at, other = place[p], array[top]
                array[at], place[other] = other, at
                array[top], place[p] = p, top
                size[g], size[top], group[p] = top - g, 1, top
            end = start
            continue
        reached: dict[int, int] = {}
        for s in sorted(array[start:end]):
            p = s - 1
            while p >= 0 and group[p] > start:
                p = previous[p]
            if p >= 0 and group[p] == start:  # the same prefix once more
                p = previous[p]
            previous[s] = p
            if p >= 0:
                reached[p] = reached.get(p, 0) + 1
        repeats = set(reached.values())
        if len(repeats) == 1:
            _move_up(reached, array, place, group, size)
        else:
            for k in sorted(repeats, reverse=True):
                _move_up([p for p, times in reached.items() if times == k], array, place, group, size)
        end = start
    return previous


def _move_up(moved, array: list[int], place: list[int], group: list[int], size: list[int]) -> None:
    """Split ``moved`` off the upper ends of their groups."""
    for p in moved:
        g = group[p]
        top = g + size[g] - 1
        size[g] = top - g
        at, other = place[p], array[top]
        array[at], place[other] = other, at
        array[top], place[p] = p, top
    starts = {g: g + size[g] for g in [group[p] for p in moved]}
    for g in starts.values():
        size[g] = 0
    for p in moved:
        g = starts[group[p]]
        group[p] = g
        size[g] += 1


def _order_within_groups(n: int, group: list[int], previous: list[int]) -> list[int]:
    """A suffix takes its group's next place when what follows its Lyndon prefix is placed."""
    out = [n - 1] * n
    free = list(range(n))
    waiting = [True] * n
    waiting[n - 1] = False
    for i in range(n):
        s = out[i] - 1
        while s >= 0 and waiting[s]:
            g = group[s]
            at = free[g]
            out[at] = s
            free[g] = at + 1
            waiting[s] = False
            s = previous[s]
    return out


def neighbours_share(text: np.ndarray, array: list[int], reach: np.ndarray, least: int) -> np.ndarray:
    """Whether each suffix shares ``least`` with the one before it in ``array``.

    ``reach[i]`` is where symbol i begins; whole symbols are counted by their extent. The
    last symbol of a text must be unlike all others.
    """
    order = np.asarray(array, np.int64)
    out = np.zeros(len(order), bool)
    open_ = np.arange(1, len(order))
    k = 0
    while len(open_):
        a, b = order[open_] + k, order[open_ - 1] + k
        inside = np.maximum(a, b) < len(text)
        open_, a, b = open_[inside], a[inside], b[inside]
        open_ = open_[text[a] == text[b]]
        k += 1
        at = order[open_]
        far = reach[np.minimum(at + k, len(reach) - 1)] - reach[at] >= least
        out[open_[far]] = True
        open_ = open_[~far]
    return out
