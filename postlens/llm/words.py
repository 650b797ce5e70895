"""Vectorised word hashes of whole texts, for use inside Arrow tasks.

A word is a maximal run of bytes other than space and \\x09-\\x0D, so the UTF-8
form of a text has the same words as the text. All functions work straight on
Arrow's string buffers, a bounded number of bytes at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 19

_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_ODD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (two xor-multiply rounds)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class Hasher:
    """Hashes of words and of runs of words; another ``seed``, other hashes."""

    def __init__(self, seed: int = 0, lower: bool = True):
        self.lower = lower
        self.byte = mix(np.arange(1, 257, dtype=np.uint64) * _ODD + np.uint64(seed))
        self.base = 0x2545F4914F6CDD1D
        self.inverse = pow(self.base, -1, 1 << 64)
        self.up = self.down = np.zeros(0, np.uint64)

    def _grow(self, n: int) -> None:
        if n > len(self.up):
            n = max(n, CHUNK_BYTES + 1)
            self.up, self.down = _powers(self.base, n), _powers(self.inverse, n)

    def words(self, data: np.ndarray, first: np.ndarray):
        """data: bytes of texts one behind the other; first: where each text starts, and the end.
        Gives each word's hash, start and end, and for each text its first word's number (and their count)."""
        if self.lower:
            data = _LOWER[data]
        blank = _BLANK[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[first] = True
        before, after = edge[:-1].copy(), edge[1:]
        before[1:] |= blank[:-1]
        after[:-1] |= blank[1:]
        start = np.flatnonzero(~blank & before)
        end = np.flatnonzero(~blank & after) + 1
        self._grow(len(data) + 1)
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.byte[data] * self.up[: len(data)], out=total[1:])
        return mix((total[end] - total[start]) * self.down[start]), start, end, np.searchsorted(start, first)

    def runs(self, word: np.ndarray, n: int) -> np.ndarray:
        """The hash of the n words from each position on."""
        if len(word) < n:
            return np.zeros(0, np.uint64)
        out = np.zeros(len(word) - n + 1, np.uint64)
        for k in range(n):
            out = out * _ODD + word[k : k + len(out)]
        return mix(out ^ np.uint64(n))

    def whole(self, word: np.ndarray, at: np.ndarray, salt: int) -> np.ndarray:
        """The hash of each text's whole word sequence; at: the texts' first words, and the count."""
        size = np.diff(at)
        place = np.arange(len(word)) - np.repeat(at[:-1], size)
        self._grow(int(place.max(initial=0)) + 1)
        total = np.zeros(len(word) + 1, np.uint64)
        np.cumsum(mix(word + np.uint64(salt)) * self.up[place], out=total[1:])
        return mix(total[at[1:]] - total[at[:-1]] + size.astype(np.uint64) * _ODD)


@dataclass
class Texts:
    """Some texts' words: ``rows`` says which rows of the batch they are."""

    rows: np.ndarray
    word: np.ndarray
    start: np.ndarray
    end: np.ndarray
    at: np.ndarray
    data: np.ndarray

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.rows)), np.diff(self.at))


def chunks(column: pa.Array, hasher: Hasher) -> Iterator[Texts]:
    """The words of a string column (null: none), about CHUNK_BYTES at a time."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + CHUNK_BYTES, side="right")) - 1)
        part = data[offsets[i] : offsets[j]]
        first = offsets[i : j + 1] - offsets[i]
        word, start, end, at = hasher.words(part, first)
        yield Texts(np.arange(i, j), word, start, end, at, part)
        i = j
