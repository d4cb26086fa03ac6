"""Distinct words of many texts, and a table of the ids of words seen before.

Words are cut from Arrow's text buffers and told apart by Arrow, so that Python handles only the
distinct ones of a chunk. A table that reaches its bound keeps the words that were met again since
they were learned; most words of a corpus are met once.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from rowsluice.llm import common as c


def distinct(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """The word's number of each piece, the words and their bytes' numbers; pieces follow each other up to the end of the data."""
    ends = np.append(starts, len(data)).astype(np.int64)
    pieces = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data))])
    found = pieces.dictionary_encode()
    sizes = pc.binary_length(found.dictionary).to_numpy(zero_copy_only=False)
    return found.indices.to_numpy(zero_copy_only=False), found.dictionary.to_numpy(zero_copy_only=False).tolist(), sizes


def text_buffers(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    return c.buffers(pa.array(texts, pa.large_string()))


def side_by_side(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of ranges, one after another."""
    total = np.cumsum(sizes)
    return np.repeat(starts - (total - sizes), sizes) + np.arange(total[-1] if len(total) else 0)


class Known:
    """Id sequences by word."""

    def __init__(self, dtype: type):
        self.dtype = dtype
        self._clear()

    def _clear(self) -> None:
        self.numbers: dict[bytes, int] = {}
        self.n = self.used = self.chars = 0
        self.place, self.met = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, bool)
        self.ids = np.zeros(1 << 14, self.dtype)

    def trim(self, bound: int) -> None:
        """Keep only words met again, if there are more characters than the bound; none, if these are many too."""
        if self.chars <= bound:
            return
        words, numbers = list(self.numbers), np.fromiter(self.numbers.values(), np.int64, len(self.numbers))
        again = np.flatnonzero(self.met[numbers])
        words, numbers = [words[i] for i in again.tolist()], numbers[again]
        ids, sizes = self.get(numbers)
        self._clear()
        if sum(map(len, words)) + 16 * len(words) <= bound // 2:
            self.add(words, ids, sizes)

    def find(self, words: list[bytes]) -> np.ndarray:
        """The number of each word, -1 for unknown ones."""
        numbers = np.fromiter(map(self.numbers.get, words, repeat(-1)), np.int64, len(words))
        self.met[numbers[numbers >= 0]] = True
        return numbers

    def add(self, words: list[bytes], ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Append new words; their numbers."""
        while self.n + len(words) + 1 > len(self.place):
            self.place = np.concatenate((self.place, np.zeros_like(self.place)))
            self.met = np.concatenate((self.met, np.zeros_like(self.met)))
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate((self.ids, np.zeros_like(self.ids)))
        self.ids[self.used : self.used + len(ids)] = ids
        self.place[self.n + 1 : self.n + 1 + len(words)] = self.used + np.cumsum(sizes)
        first = self.n
        self.numbers.update(zip(words, range(first, first + len(words))))
        self.n += len(words)
        self.used += len(ids)
        self.chars += sum(map(len, words)) + 16 * len(words)
        return np.arange(first, self.n)

    def get(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The sequences of these numbers side by side, and the length of each."""
        starts = self.place[numbers]
        sizes = self.place[numbers + 1] - starts
        return self.ids[side_by_side(starts, sizes)], sizes
