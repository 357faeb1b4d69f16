"""Lists of different lengths held in one array, found by number."""

from __future__ import annotations

import numpy as np


class Numbers(dict):
    """Numbers of keys, given in the order in which they are first asked for; ``fresh`` are the new ones."""

    def __init__(self):
        self.fresh: list = []

    def __missing__(self, key) -> int:
        number = self[key] = len(self)
        self.fresh.append(key)
        return number

    def taken(self) -> list:
        """The keys that came since the last call."""
        new, self.fresh = self.fresh, []
        return new


class Ragged:
    """Lists appended in blocks; ``gathered`` puts any of them in a row."""

    def __init__(self, dtype):
        self.flat, self.used = np.zeros(1 << 12, dtype), 0
        self.bounds, self.count = np.zeros(1 << 10, np.int64), 0

    def append(self, values: np.ndarray, lengths: np.ndarray) -> None:
        while len(self.flat) < self.used + len(values):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while len(self.bounds) < self.count + len(lengths) + 1:
            self.bounds = np.concatenate([self.bounds, np.zeros_like(self.bounds)])
        self.flat[self.used : self.used + len(values)] = values
        self.bounds[self.count + 1 : self.count + len(lengths) + 1] = self.used + np.cumsum(lengths)
        self.used += len(values)
        self.count += len(lengths)

    def gathered(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The lists with these numbers in a row, and where each begins and ends."""
        starts = self.bounds[numbers]
        lengths = self.bounds[numbers + 1] - starts
        upto = np.concatenate([[0], np.cumsum(lengths)])
        return self.flat[np.repeat(starts - upto[:-1], lengths) + np.arange(upto[-1])], upto


def ragged(lists: list, dtype) -> Ragged:
    """All of ``lists`` (bytes, where ``dtype`` is uint8)."""
    held = Ragged(dtype)
    lengths = np.fromiter(map(len, lists), np.int64, len(lists))
    if dtype == np.uint8:
        held.append(np.frombuffer(b"".join(lists), np.uint8), lengths)
    else:
        held.append(np.concatenate([*map(np.asarray, lists), np.zeros(0, dtype)]).astype(dtype), lengths)
    return held
