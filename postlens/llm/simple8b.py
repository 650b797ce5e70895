"""Simple-8b coding of id sequences, vectorised with numpy.

A 64-bit word holds a selector in its top four bits and below it ``COUNT[s]``
values of ``60 // COUNT[s]`` bits, the first in the lowest bits. A word packs
the largest count that fits. Selector 15 is the escape: the next word is one raw
64-bit value, for values of more than 60 bits. Selector 0 is not used.

Sequences are coded in blocks of ``BLOCK`` values; each block begins a new word,
and the blocks' first words are kept beside the data, so that a decoder starts
at any block, or decodes all words of one selector at once.
"""

from __future__ import annotations

import numpy as np

BLOCK = 512
ESCAPE = 15
#: Values to a word for selectors 1 to 14 (fixed values of the format).
COUNT = np.array([0, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1, 1])
BITS = np.array([0, *(60 // COUNT[1:15]), 64])


def _bit_length(x: np.ndarray) -> np.ndarray:
    """Bits that each value needs, one at least: a double's exponent, of the upper half where that is not 0."""
    high, low = x >> np.uint64(32), x & np.uint64(0xFFFFFFFF)
    if not high.any():
        return np.maximum(1, (low.astype(np.float64).view(np.int64) >> 52) - 1022)
    part = np.where(high > 0, high, low).astype(np.float64)
    return np.where(high > 0, 32, 0) + np.maximum(1, (part.view(np.int64) >> 52) - 1022)


def encode(values: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code sequences that lie one behind the other in ``values`` (uint64).

    Returns all words, the word count of each block, and the block count of each sequence.
    """
    length = np.asarray(length, np.int64)
    blocks = -(-length // BLOCK)
    total = int(blocks.sum())
    if not total:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), blocks
    first = np.repeat(np.cumsum(length) - length, blocks)
    number = np.arange(total) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    begin = first + number * BLOCK
    size = np.minimum(BLOCK, np.repeat(length, blocks) - number * BLOCK)
    width = int(size.max())
    # one row a block; places behind a block's end count as too wide for any selector
    place = np.arange(width)
    inside = place < size[:, None]
    table = np.zeros((total, width), np.uint64)
    table[inside] = values[np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))]
    need = np.full((total, width + 60), 255, np.uint8)
    need[:, :width][inside] = _bit_length(table[inside])
    most = need[:, :width].copy()
    choice = np.where(most <= 60, 14, ESCAPE).astype(np.uint8)
    for n in range(2, 61):
        np.maximum(most, need[:, n - 1 : n - 1 + width], out=most)
        fits = most <= 60 // n
        if not fits.any():
            break
        if n in COUNT:
            choice[fits] = int(np.flatnonzero(COUNT == n)[0])
    at, live, steps = np.zeros(total, np.int64), np.arange(total), []
    words_of, flat_choice = np.zeros(total, np.int64), choice.reshape(-1)
    while len(live):
        chosen = flat_choice[live * width + at[live]]
        steps.append((live, at[live], chosen, words_of[live]))
        at[live] += COUNT[chosen]
        words_of[live] += 1 + (chosen == ESCAPE)
        live = live[at[live] < size[live]]
    row, col, chosen, to = (np.concatenate(x) for x in zip(*steps))
    to = to + (np.cumsum(words_of) - words_of)[row]
    words = np.zeros(int(words_of.sum()), np.uint64)
    flat, start = table.reshape(-1), row * width + col
    for s in range(1, 15):
        here = np.flatnonzero(chosen == s)
        if len(here):
            packed = np.full(len(here), np.uint64(s) << np.uint64(60), np.uint64)
            for k in range(COUNT[s]):
                packed |= flat[start[here] + k] << np.uint64(k * BITS[s])
            words[to[here]] = packed
    here = np.flatnonzero(chosen == ESCAPE)
    words[to[here]] = np.uint64(ESCAPE) << np.uint64(60)
    words[to[here] + 1] = flat[start[here]]
    return words, words_of, blocks


def block_sizes(length: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """How many values each block holds, given the sequences' lengths and block counts."""
    out = np.full(int(blocks.sum()), BLOCK, np.int64)
    some = blocks > 0
    out[np.cumsum(blocks)[some] - 1] = length[some] - (blocks[some] - 1) * BLOCK
    return out


def _selectors(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each word's selector (-1: a raw value), and how many values it holds."""
    chosen = (words >> np.uint64(60)).astype(np.int64)
    last = -1
    for p in np.flatnonzero(chosen == ESCAPE):  # an escape hides the word behind it
        if p > last:
            last = p + 1
            if last == len(chosen):
                raise ValueError("damaged block: it ends with an escape")
            chosen[last] = -1
    if (chosen == 0).any():
        raise ValueError("damaged block: selector 0")
    return chosen, np.where(chosen == -1, 1, np.where(chosen == ESCAPE, 0, COUNT[np.maximum(chosen, 0)]))


def _values(words: np.ndarray, chosen: np.ndarray, to: np.ndarray, out: np.ndarray) -> None:
    """The values of all words, those of one selector at once; each word's from ``to`` on."""
    for s in range(1, 15):
        here = np.flatnonzero(chosen == s)
        if len(here):
            mask = np.uint64((1 << int(BITS[s])) - 1)
            for k in range(COUNT[s]):
                out[to[here] + k] = (words[here] >> np.uint64(k * BITS[s])) & mask
    raw = np.flatnonzero(chosen == -1)
    out[to[raw]] = words[raw]


def decode_blocks(words: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All values of blocks that begin at the words ``starts`` and hold ``sizes`` values, held against both."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    chosen, count = _selectors(words)
    held = np.add.reduceat(count, starts)
    if (held != sizes).any() or (chosen[starts] == -1).any():
        raise ValueError("damaged block: other values than counted")
    out = np.zeros(int(held.sum()), np.uint64)
    _values(words, chosen, np.cumsum(count) - count, out)
    return out


def decode_span(words: np.ndarray, starts: np.ndarray, length: int, low: int, high: int) -> np.ndarray:
    """Values number ``low`` to ``high`` (exclusive) of one sequence, from the blocks that hold them alone."""
    low, high = max(0, low), min(length, high)
    if low >= high:
        return np.zeros(0, np.uint64)
    a, b = low // BLOCK, -(-high // BLOCK)
    end = starts[b] if b < len(starts) else len(words)
    sizes = block_sizes(np.array([length]), np.array([len(starts)]))[a:b]
    return decode_blocks(words[starts[a] : end], starts[a:b] - starts[a], sizes)[low - a * BLOCK : high - a * BLOCK]


def decode(words: np.ndarray) -> np.ndarray:
    """All values of whole blocks that lie one behind the other, without their offsets."""
    if not len(words):
        return np.zeros(0, np.uint64)
    chosen, count = _selectors(words)
    out = np.zeros(int(count.sum()), np.uint64)
    _values(words, chosen, np.cumsum(count) - count, out)
    return out
