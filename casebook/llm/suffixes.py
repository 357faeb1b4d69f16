"""Suffix arrays of many short segments in numpy, their common prefixes, and merging by binary search."""

from __future__ import annotations

import numpy as np


#: Bytes in the first key of a suffix: each takes nine bits, so that the end of a segment differs from a zero.
KEY_BYTES = 7


def leading_words(text: np.ndarray, ends: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The KEY_BYTES bytes from each place as one number, in their order; a segment's end is before all bytes."""
    padded = np.concatenate([text, np.zeros(KEY_BYTES, np.uint8)])
    words = np.zeros(len(at), np.uint64)
    for j in range(KEY_BYTES):
        letters = padded[at + j].astype(np.uint64) + np.uint64(1)
        letters[at + j >= ends] = 0
        words = words << np.uint64(9) | letters
    return words


def suffix_array(text: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Places of ``text`` in the order of what follows them to the ends of their segments.

    Larsson and Sadakane's refinement: places are grouped by their first bytes, and groups of
    several are split by the groups that stand h bytes further on, for doubling h. A group's number is
    the place of its last member in the order, so that numbers stay right as groups split. Suffixes
    equal to their ends are in the order of their segments. ``ends`` holds the end of each place's segment.
    """
    n = len(text)
    keys = leading_words(text, ends, np.arange(n))
    order = np.argsort(keys, kind="stable")
    rank = np.empty(n, np.int64)
    ordered = keys[order]
    last = np.flatnonzero(np.append(ordered[1:] != ordered[:-1], True))
    sizes = np.diff(last, prepend=-1)
    rank[order] = np.repeat(last, sizes)
    open_places = np.flatnonzero(np.repeat(sizes, sizes) > 1)
    h = KEY_BYTES
    while len(open_places):
        own = order[open_places]
        further = own + h
        # groups further on come after all ends, and these by segment
        second = np.where(further < ends[own], rank[np.minimum(further, n - 1)] + n + 1, ends[own])
        both = rank[own] << 32 | second
        resorted = np.argsort(both, kind="stable")
        own, both = own[resorted], both[resorted]
        order[open_places] = own
        last = np.flatnonzero(np.append(both[1:] != both[:-1], True))
        sizes = np.diff(last, prepend=-1)
        rank[own] = np.repeat(open_places[last], sizes)
        open_places = open_places[np.repeat(sizes, sizes) > 1]
        h *= 2
    return order


def common_prefixes(text: np.ndarray, order: np.ndarray, starts: np.ndarray, sizes: np.ndarray, depth: int) -> np.ndarray:
    """Common prefix, up to ``depth`` and the segments' ends, of each suffix with the one before it in ``order``.

    Kasai's walk along the text, in all segments at once: a suffix's prefix is at most one shorter
    than that of the suffix one byte before it.
    """
    previous = np.full(len(text), -1, np.int64)
    previous[order[1:]] = order[:-1]
    ends = np.repeat(starts + sizes, sizes)
    lengths = np.zeros(len(text), np.int64)
    by_size = np.argsort(-sizes, kind="stable")
    starts, sizes = starts[by_size], sizes[by_size]
    carried = np.zeros(len(starts), np.int64)
    for t in range(int(sizes.max(initial=0))):
        alive = int(np.searchsorted(-sizes, -t))
        here = starts[:alive] + t
        there = previous[here]
        length = np.maximum(carried[:alive] - 1, 0)
        length[there < 0] = 0
        most = np.minimum(np.minimum(ends[here] - here, ends[there] - there), depth)
        most[there < 0] = 0
        growing = np.flatnonzero(length < most)
        while len(growing):
            at = length[growing]
            growing = growing[text[here[growing] + at] == text[there[growing] + at]]
            length[growing] += 1
            growing = growing[length[growing] < most[growing]]
        lengths[here] = length
        carried[:alive] = length
    return lengths[order]


def keys_of(text: np.ndarray, places: np.ndarray, depth: int) -> list[np.ndarray]:
    """The ``depth`` bytes from each place as words whose order is that of the bytes."""
    ends = places + depth
    padded = np.concatenate([text, np.zeros(depth + KEY_BYTES, np.uint8)])
    return [leading_words(padded, ends, places + j) for j in range(0, depth, KEY_BYTES)]


def binary_search(sorted_keys: list[np.ndarray], keys: list[np.ndarray]) -> np.ndarray:
    """Where each key stands among the sorted ones, or -1."""
    n = len(sorted_keys[0])
    low, high = np.zeros(len(keys[0]), np.int64), np.full(len(keys[0]), n)
    while (open_keys := np.flatnonzero(low < high)).size:
        middle = (low[open_keys] + high[open_keys]) // 2
        less = np.zeros(len(open_keys), bool)
        equal = np.ones(len(open_keys), bool)
        for column, wanted in zip(sorted_keys, keys, strict=True):
            a, b = column[middle], wanted[open_keys]
            less |= equal & (a < b)
            equal &= a == b
        low[open_keys] = np.where(less, middle + 1, low[open_keys])
        high[open_keys] = np.where(less, high[open_keys], middle)
    found = low < n
    for column, wanted in zip(sorted_keys, keys, strict=True):
        found &= column[np.minimum(low, n - 1)] == wanted if n else False
    return np.where(found, low, -1)
