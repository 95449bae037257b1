"""Number lists of words, remembered by a Python worker from task to task."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

# Words of one generation. Together two generations hold the words of about 100 MB of running text.
GENERATION = 150_000


class Column:
    """A growing array: its buffer doubles, so that adding costs no copy of what is there."""

    def __init__(self, dtype: type):
        self.buffer, self.size = np.zeros(1024, dtype), 0

    def add(self, values: np.ndarray) -> None:
        while self.size + len(values) > len(self.buffer):
            self.buffer = np.concatenate([self.buffer, np.zeros_like(self.buffer)])
        self.buffer[self.size : self.size + len(values)] = values
        self.size += len(values)


class Generation:
    def __init__(self) -> None:
        self.known: dict[object, int] = {}
        self.flat, self.begin, self.size = Column(np.int32), Column(np.int64), Column(np.int64)

    def add(self, words: list, flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Add distinct new words; their numbers."""
        numbers = np.arange(len(self.known), len(self.known) + len(words))
        self.begin.add(self.flat.size + np.cumsum(sizes) - sizes)
        self.size.add(sizes)
        self.flat.add(flat)
        self.known.update(zip(words, numbers.tolist(), strict=True))
        return numbers

    def find(self, words: list) -> np.ndarray:
        """The number of each word, -1 if it is unknown."""
        return np.array([self.known.get(w, -1) for w in words], np.int64)

    def lists(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return gathered(self.flat.buffer, self.begin.buffer[at], self.size.buffer[at]), self.size.buffer[at]


def gathered(flat: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The runs of `flat` that start at `begin` and have `size` entries, one after the other."""
    ends = np.cumsum(size)
    return flat[np.repeat(begin - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)]


class WordMemory:
    """`make` gives the lists of new words, as one array and the sizes; they are made again only after two generations without use.

    A full generation becomes the older one, and the one before it is dropped. What is found in the older one is taken over, so
    that frequent words stay.
    """

    def __init__(self, make: Callable[[list], tuple[np.ndarray, np.ndarray]], most: int = GENERATION):
        self.make, self.most = make, most
        self.young, self.old = Generation(), Generation()

    def lists(self, words: list) -> tuple[np.ndarray, np.ndarray]:
        """(entries of all words in order, entries per word)."""
        if len(self.young.known) + len(words) > self.most and self.young.known:
            self.young, self.old = Generation(), self.young
        at = self.young.find(words)
        missing = np.flatnonzero(at < 0)
        if len(missing):
            asked = [words[k] for k in missing.tolist()]
            older = self.old.find(asked)
            kept = older >= 0
            at[missing[kept]] = self.young.add([w for w, k in zip(asked, kept.tolist(), strict=True) if k], *self.old.lists(older[kept]))
            fresh = [w for w, k in zip(asked, kept.tolist(), strict=True) if not k]
            if fresh:
                at[missing[~kept]] = self.young.add(fresh, *self.make(fresh))
        return self.young.lists(at)
