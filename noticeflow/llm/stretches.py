"""Encoding texts stretch by stretch, with a bounded memory of stretches.

A tokenizer that never joins certain neighbouring bytes can encode what lies
between them independently. Such borders are given as a table over byte
pairs. A run of texts is cut there in one numpy pass, equal stretches are
brought together by their hashes, and only stretches not met before are
given to the tokenizer; ids are then gathered back in one pass.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from . import textnp as T


class StretchCache:
    """Ids of stretches by 64-bit hash, as sorted numpy arrays. ``encode``
    turns a list of stretches (str) into a list of id sequences. Beyond
    ``limit`` entries the memory starts anew; results do not depend on it."""

    def __init__(self, encode: Callable[[list[str]], list], dtype: np.dtype, limit: int = 1_000_000):
        self.encode, self.dtype, self.limit = encode, dtype, limit
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.at, self.size = np.zeros((2, 0), np.int64)
        self.store = np.zeros(0, self.dtype)

    def ids(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, counts): the ids of all stretches end to end and the number
        of each; stretch k runs from starts[k] to starts[k + 1] or the end."""
        if not len(starts):
            return np.zeros(0, self.dtype), np.zeros(0, np.int64)
        ends = np.append(starts[1:], len(data))
        found, index, inverse = np.unique(_hashes(data, starts, ends), return_index=True, return_inverse=True)
        if len(self.keys) + len(found) > self.limit:
            self._clear()
        at = np.searchsorted(self.keys, found)
        known = np.zeros(len(found), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == found[inside]
        if not known.all():
            new = index[~known]
            raw = data.tobytes()
            encoded = self.encode([raw[a:b].decode() for a, b in zip(starts[new].tolist(), ends[new].tolist())])
            sizes = np.array([len(x) for x in encoded], np.int64)
            begin = len(self.store) + np.cumsum(sizes) - sizes
            flat = [i for x in encoded for i in x]
            self.store = np.concatenate([self.store, np.array(flat, self.dtype)])
            self.keys = np.insert(self.keys, at[~known], found[~known])
            self.at = np.insert(self.at, at[~known], begin)
            self.size = np.insert(self.size, at[~known], sizes)
            at = np.searchsorted(self.keys, found)
        counts = self.size[at][inverse]
        return self.store[ragged(self.at[at][inverse], counts)], counts


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... counts[0] of them, then starts[1] ..."""
    before = np.cumsum(counts) - counts
    return np.arange(int(counts.sum())) + np.repeat(starts - before, counts)


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each stretch; stretches cover the data."""
    none = np.zeros(256, bool)  # no byte lies between stretches
    return T.word_hashes(data, starts, ends, between=none)


def cut(data: np.ndarray, offsets: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, first): where stretches start in a run of texts, and the
    index of each text's first stretch. ``borders[a, b]`` is true where a
    stretch ends between the bytes a and b; a text's end always ends one."""
    begin = np.zeros(len(data), bool)
    if len(data):
        begin[1:] = borders[data[:-1], data[1:]]
        begin[offsets[:-1][np.diff(offsets) > 0]] = True
    starts = np.flatnonzero(begin)
    return starts, np.searchsorted(starts, offsets)


def sums(counts: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Offsets of each text's ids, from the counts of its stretches."""
    return np.concatenate(([0], np.cumsum(counts)))[first]
