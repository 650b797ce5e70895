"""Product codes for vectors, their codebooks refined by Yinyang Lloyd rounds.

Vectors are cut into equal consecutive parts, each with a codebook of its own that
starts as that part of the vectors of least id. The entries of a codebook are
clustered into groups of about ten. For each part of each vector the table of a
round keeps the nearest entry and, for each group, a lower bound on the distance to
the group's other entries. When entries have moved, a group's bound falls by the
largest drift in it; only groups whose bound does not stay above the exact distance to
the part's own entry are scanned, and no part whose bounds all hold is looked at again.
Distances that decide are sums of squares of integers, so equal ones are seen as
equal and go to the lower entry; bounds are kept rounded down.

A round is one pass over the rows that writes the next table (codes and bounds beside
the vectors) and one that sums parts by entry, in each task before the shuffle. To
the driver come codebooks alone: ``entries`` rows for each length of vector.

Edge cases: vectors that are null or hold a null or a non-finite component take no part.
Vectors of different lengths have codebooks and ``codebooks_sha256`` of their own (up to
256 lengths, else an error); a length that ``parts`` does not divide is filled up with
zeros, an empty vector has code 0 throughout and no error. Rows that repeat an id are rows of
their own, ordered by their vectors where the start needs an order; null ids come after
all others. With fewer than ``entries`` vectors the codebook has as many entries. Null labels are
one label. Components are held within 2**62 either way, errors within a long. An empty
table gives an empty result. Only ``vec_id``, ``embedding`` and ``label`` are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import store
from .vectors import CLAMP, EXACT, integer_rows, matrix, sizes

#: Entries of a codebook that share a lower bound, about.
GROUP = 10
#: Rows worked on at a time in a task.
ROWS = 8192
#: What bounds give way to rounding.
SLACK = 1e-9
LONG = (1 << 63) - 1


@dataclass
class Book:
    """The codebooks of vectors of one length: entries[part, entry, place]; group[part, entry]; drift[part, group]."""

    entries: np.ndarray
    group: np.ndarray
    drift: np.ndarray
    exact: bool

    def groups(self) -> int:
        return self.drift.shape[1]


def squares(x: np.ndarray, entries: np.ndarray, exact: bool) -> np.ndarray:
    """Squared distances of each row of ``x`` and each row of ``entries``: doubles where those are exact, else Python's integers."""
    if exact:
        return (x * x).sum(1)[:, None] - 2 * (x @ entries.T) + (entries * entries).sum(1)[None, :]
    return ((x.astype(object)[:, None, :] - entries.astype(object)[None, :, :]) ** 2).sum(2)


def own_squares(x: np.ndarray, near: np.ndarray, exact: bool) -> np.ndarray:
    """The squared distance of each row and the row beside it."""
    return ((x - near) ** 2).sum(1) if exact else ((x.astype(object) - near.astype(object)) ** 2).sum(1)


def groups_of(entries: np.ndarray, count: int, rounds: int = 5) -> np.ndarray:
    """A group for each entry, by a few rounds of k-means from entries far apart."""
    x = entries.astype(np.float64)
    centre = [x[0]]
    while len(centre) < count:
        centre.append(x[np.min([((x - c) ** 2).sum(1) for c in centre], 0).argmax()])
    centres = np.array(centre)
    for _ in range(rounds):
        near = ((x[:, None] - centres[None]) ** 2).sum(2).argmin(1)
        for g in range(count):
            if (near == g).any():
                centres[g] = x[near == g].mean(0)
    return near


def _down(x: np.ndarray) -> np.ndarray:
    """Distances from squared ones, rounded down to single precision."""
    far = np.sqrt(x.astype(np.float64)) * (1 - SLACK)
    return np.nextafter(far.astype(np.float32), np.float32(-np.inf))


def assign(x: np.ndarray, entries: np.ndarray, group: np.ndarray, drift: np.ndarray, exact: bool, code: np.ndarray | None = None, low: np.ndarray | None = None):
    """Nearest entry, squared distance to it and lower bounds by group of one part of all rows; distances computed.

    code, low: those of the round before; without them all entries are looked at.
    """
    n, count = len(x), len(drift)
    if code is None:
        code, low, own = np.zeros(n, np.int64), np.full((n, count), -1.0, np.float32), None
    else:
        code = code.astype(np.int64)
        low = np.nextafter((low - drift[None, :] * (1 + SLACK)).astype(np.float32), np.float32(-np.inf))
        own = own_squares(x, entries[code], exact)
    looked = n
    best = own_squares(x, entries[code], exact) if own is None else own
    upper = np.sqrt(best.astype(np.float64)) * (1 + SLACK)
    fails = low <= upper[:, None]  # an equal distance may be a lower entry's
    best, new, own = best.copy(), code.copy(), best
    scanned = []
    for g in np.flatnonzero(fails.any(0)):
        rows, members = np.flatnonzero(fails[:, g]), np.flatnonzero(group == g)
        if not len(members):
            continue
        far = squares(x[rows], entries[members], exact)
        looked += far.size
        first = far.argmin(1)
        least = far[np.arange(len(rows)), first]
        name = members[first]
        better = (least < best[rows]) | ((least == best[rows]) & (name < new[rows]))
        best[rows[better]], new[rows[better]] = least[better], name[better]
        scanned.append((g, rows, members, far, first, least))
    moved = np.flatnonzero(new != code)  # the entry left behind counts for its group again
    low[moved, group[code[moved]]] = np.minimum(low[moved, group[code[moved]]], _down(own[moved]))
    for g, rows, members, far, first, least in scanned:
        mine = members[first] == new[rows]
        second = least.copy()
        if mine.any():
            others = far[mine].copy()
            others[np.arange(len(others)), first[mine]] = np.inf if exact else 1 << 200
            second[mine] = others.min(1)
        low[rows, g] = _down(second)
    return new, best, low, looked


def _parts(vectors: np.ndarray, parts: int, exact: bool) -> np.ndarray:
    """part, row, place; filled up with zeros."""
    n, size = vectors.shape
    each = -(-size // parts)
    out = np.zeros((n, parts * each), np.int64)
    out[:, :size] = vectors
    out = out.reshape(n, parts, each).transpose(1, 0, 2)
    return out.astype(np.float64) if exact else out


def _assigned(books: dict[int, Book], parts: int, first: bool, last: bool):
    def one(batch: pa.RecordBatch, size: int) -> pa.RecordBatch:
        book, n = books[size], batch.num_rows
        x = _parts(matrix(batch), parts, book.exact)
        width = book.groups()
        old = None if first else np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(n, parts)
        bounds = None if first else np.frombuffer(b"".join(batch.column("low").to_pylist()), "<f4").reshape(n, parts, width)
        code, low = np.zeros((n, parts), np.uint8), np.zeros((n, parts, width), "<f4")
        error = np.zeros(n) if book.exact else np.zeros(n, object)
        looked = 0
        for p in range(parts):
            args = () if first else (old[:, p], bounds[:, p])
            code[:, p], best, low[:, p], seen = assign(x[p], book.entries[p].astype(x.dtype), book.group[p], book.drift[p], book.exact, *args)
            error, looked = error + best, looked + seen
        work = batch.column("looked").to_numpy(zero_copy_only=False).copy() if not first else np.zeros(n, np.int64)
        work += looked // n
        codes = pa.array([c.tobytes() for c in code], pa.binary())
        if last:
            capped = [min(int(e), LONG) for e in error]
            return pa.record_batch([batch.column("vec_id"), batch.column("label"), pa.array([c.tobytes().hex() for c in code]), pa.array(capped, pa.int64()), batch.column("size"), pa.array(work)], names=["vec_id", "label", "code", "error", "size", "looked"])
        return pa.record_batch([*(batch.column(c) for c in ("vec_id", "label", "size", "vector")), codes, pa.array([b.tobytes() for b in low], pa.binary()), pa.array(work)], names=["vec_id", "label", "size", "vector", "code", "low", "looked"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                piece = batch.slice(at, ROWS)
                length = piece.column("size").to_numpy()
                for size in np.unique(length):
                    yield one(piece if (length == size).all() else piece.filter(pa.array(length == size)), int(size))

    return run


def _sums(books: dict[int, Book], parts: int):
    """Of a task's rows: how many parts each entry has and their sums, a row an entry and place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            length = batch.column("size").to_numpy()
            for size in np.unique(length).tolist():
                book = books[size]
                mine = batch.filter(pa.array(length == size))
                x = _parts(matrix(mine), parts, False)
                code = np.frombuffer(b"".join(mine.column("code").to_pylist()), np.uint8).reshape(-1, parts)
                k, each = book.entries.shape[1:]
                seen, sums = total.setdefault(size, (np.zeros((parts, k), np.int64), np.zeros((parts, k, each), object)))
                for p in range(parts):
                    seen[p] += np.bincount(code[:, p], minlength=k)
                    if book.exact:
                        for d in range(each):  # sums of a batch stay below 2**53, as squares do
                            sums[p, :, d] += np.bincount(code[:, p], x[p, :, d], k).astype(np.int64).astype(object)
                    else:
                        np.add.at(sums[p], code[:, p].astype(np.int64), x[p].astype(object))
        for size, (seen, sums) in total.items():
            part, entry = np.nonzero(seen)
            each = sums.shape[2]
            place = np.tile(np.arange(each), len(part))
            part, entry = np.repeat(part, each), np.repeat(entry, each)
            amount = pa.array([int(s) for s in sums[part, entry, place]], pa.decimal128(38, 0))
            yield pa.record_batch([pa.array(np.full(len(part), size), pa.int32()), pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(place, pa.int32()), pa.array(seen[part, entry]), amount], names=["size", "part", "entry", "place", "n", "total"])

    return run


SUMS = "size int, part int, entry int, place int, n long, total decimal(38,0)"


def _fresh(entries: np.ndarray, most: float) -> Book:
    parts, k, each = entries.shape
    count = max(1, k // GROUP)
    group = np.array([groups_of(e, count) if each else np.zeros(k, int) for e in entries])
    return Book(entries, group, np.zeros((parts, count)), 4.0 * most * most * max(1, each) < EXACT)


def _moved(book: Book, rows: list) -> Book:
    """The book with its entries at the floor of their parts' means; unused ones stay."""
    entries = book.entries.copy()
    for r in rows:
        entries[r.part, r.entry, r.place] = int(r.total) // int(r.n)
    far = np.sqrt(((entries.astype(np.float64) - book.entries.astype(np.float64)) ** 2).sum(2)) * (1 + SLACK)
    drift = np.array([[far[p][book.group[p] == g].max(initial=0.0) for g in range(book.groups())] for p in range(len(entries))])
    return Book(entries, book.group, drift, book.exact)


def encode(vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, scale: float = 256.0) -> DataFrame:
    """``vec_id, label, code, error, label_error, codebooks_sha256, looked``.

    code: two hex digits a part; error: squared distances to the final entries, summed over parts;
    label_error: that, summed over the label; looked: distances computed for the row, over all rounds, as the
    mean of the batch that it was in.
    """
    if not 0 < entries <= 256:
        raise ValueError("codes are bytes: 1 to 256 entries")
    spark = vectors.sparkSession
    rows = integer_rows(vectors.select("vec_id", "label", "embedding"), scale)
    state = store.table(rows, "vectors")
    books: dict[int, Book] = {}
    for size, n, most in sizes(state):
        least = state.where(F.col("size") == size).orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).select("vec_id", "vector").toArrow()
        start = np.ascontiguousarray(_parts(matrix(least), parts, False))
        books[size] = _fresh(start, min(most, CLAMP))
    names = dict(state.dtypes)
    head = f"vec_id {names['vec_id']}, label {names['label']}"
    for turn in range(rounds):
        done = store.table(state.mapInArrow(_assigned(books, parts, turn == 0, False), f"{head}, size int, vector binary, code binary, low binary, looked long"), "codes")
        store.drop(spark, state)
        state = done
        found = state.select("size", "vector", "code").mapInArrow(_sums(books, parts), SUMS).groupBy("size", "part", "entry", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect()
        books = {size: _moved(book, [r for r in found if r.size == size]) for size, book in books.items()}
    out = store.table(state.mapInArrow(_assigned(books, parts, rounds == 0, True), f"{head}, code string, error long, size int, looked long"), "coded")
    store.drop(spark, state)
    digest = {size: hashlib.sha256(",".join(map(str, b.entries.reshape(-1).tolist())).encode()).hexdigest() for size, b in books.items()}
    name = F.lit(None).cast("string")
    for size, text in digest.items():
        name = F.when(F.col("size") == size, text).otherwise(name)
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LONG)).cast("long").alias("label_error")
    by_label = store.again(out).groupBy(F.col("label").alias("_label")).agg(total)
    both = out.join(by_label, F.col("label").eqNullSafe(F.col("_label")))
    return both.select("vec_id", "label", "code", "error", "label_error", name.alias("codebooks_sha256"), "looked")
