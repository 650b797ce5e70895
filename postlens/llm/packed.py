"""Compact shuffle records: many (key, document) entries in one binary value.

A task holds entries until it has enough for a "flush", deals them over ranges
of the key ("buckets", a power of two) and sends one blob for each bucket. An
entry is the part of its key that the bucket doesn't say, and the number of its
document in the flush: seven or eight bytes, however many buckets there are.
Sorted keys, stored byte plane by byte plane, also compress. Answers go back to
the flush, whose list of documents travels once.
"""

from __future__ import annotations

import numpy as np


def buckets_for(least: int) -> int:
    """The power of two from ``least`` on, up to 2**22.

    Callers ask for as many as keep a bucket, which is in memory as a whole, to a bounded number of entries. With
    more buckets than a flush has entries a blob is one entry, and the format saves nothing any more.
    """
    return 1 << min(22, max(2, (least - 1).bit_length()))


def _planes(x: np.ndarray, width: int) -> bytes:
    return x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def _from_planes(data: bytes, count: int, width: int, at: int) -> np.ndarray:
    wide = np.zeros((count, 8), np.uint8)
    wide[:, :width] = np.frombuffer(data, np.uint8, count * width, at).reshape(width, count).T
    return wide.view("<u8").reshape(-1)


def pack_keys(key: np.ndarray, entry: np.ndarray, who: np.ndarray | None, buckets: int, bits: int) -> list[tuple[int, bytes]]:
    """A blob for each bucket. key: ``bits`` wide; entry: document numbers; who: eight bytes more an entry, or None."""
    split = np.uint64(bits - (buckets.bit_length() - 1))
    width = -(-int(split) // 8)
    order = np.lexsort((entry, key))
    key, entry = key[order], entry[order]
    bucket = (key >> split).astype(np.int64)
    cut = np.flatnonzero(np.diff(bucket, prepend=-1)) if len(key) else []
    low = key & ((np.uint64(1) << split) - np.uint64(1))
    who = None if who is None else who[order]
    out = []
    for a, b in zip(cut, [*cut[1:], len(key)]):
        blob = np.array([b - a, width, who is not None], "<i8").tobytes() + _planes(low[a:b], width) + _planes(entry[a:b].astype(np.uint64), 3)
        out.append((int(bucket[a]), blob + (_planes(who[a:b].view(np.uint64), 8) if who is not None else b"")))
    return out


def unpack_keys(blobs: list[bytes], bucket: int, buckets: int, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Whole keys, document numbers, the ``who`` (0 without), and the number of each entry's blob."""
    top = np.uint64(bucket) << np.uint64(bits - (buckets.bit_length() - 1))
    keys, entries, whos, size = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], []
    for blob in blobs:
        count, width, has = (int(x) for x in np.frombuffer(blob, "<i8", 3))
        keys.append(_from_planes(blob, count, width, 24) | top)
        entries.append(_from_planes(blob, count, 3, 24 + width * count).astype(np.int64))
        whos.append(_from_planes(blob, count, 8, 24 + (width + 3) * count).view(np.int64) if has else np.zeros(count, np.int64))
        size.append(count)
    return np.concatenate(keys), np.concatenate(entries), np.concatenate(whos), np.repeat(np.arange(len(blobs)), np.array(size, np.int64))


def pack_answer(key: np.ndarray, entry: np.ndarray) -> bytes:
    """Entries for their flush, in any order of keys."""
    order = np.lexsort((key, entry))
    return np.int64(len(key)).tobytes() + _planes(key[order], 8) + _planes(entry[order].astype(np.uint64), 3)


def unpack_answers(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Keys and document numbers, by document and key."""
    keys, entries = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for blob in blobs:
        count = int(np.frombuffer(blob, "<i8", 1)[0])
        keys.append(_from_planes(blob, count, 8, 8))
        entries.append(_from_planes(blob, count, 3, 8 + 8 * count).astype(np.int64))
    key, entry = np.concatenate(keys), np.concatenate(entries)
    order = np.lexsort((key, entry))
    return key[order], entry[order]
