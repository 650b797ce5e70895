"""Hard negatives for contrastive training: blocked dense products of anchors and all rows.

Anchors are cut into blocks of bounded bytes. A block is broadcast, and every task multiplies
its candidates with it, some thousand rows a time, in doubles (exact while below
2**53). The first pass keeps, for each anchor, the best rows of its own label; the
lists of tasks merge by keeping the best of both. From the merged lists come each
positive's window of scores, and a second pass over the candidates keeps the best rows of
other labels in each window. A task holds k rows an anchor or window, never the matrix of
all scores, and lets go of scores below its k-th best at once, so what leaves it is small.

Passes follow the number of anchors: it is a stated set of queries against all rows, and
each block costs one read of the candidates' columns for each of the two passes.

Edge cases: rows with a null label, a null vector, or a null or non-finite component
take no part. Vectors are held only against those of the same length (up to 256 lengths, else an error). Rows that
repeat an id are rows of their own: each is an anchor, and each a candidate for the other. Rows with a
null id are candidates, after all others of their score, and never anchors. Equal scores go to the smaller id, then to the row
read first. Fewer rows than asked for: all of them; an anchor without another row of its
label has no result, nor has one whose windows are empty, as those of negative scores are. Components are held within
2**62 either way and scores within a long. An empty table gives an empty result. Only ``vec_id``, ``embedding``, ``label`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import store
from .vectors import EXACT, integer_rows, matrix, sizes

#: Bytes of a block of anchors, which each task of a pass holds.
BLOCK_BYTES = 8 << 20
#: Scores that a task has in memory at a time.
SCORES = 1 << 21
NO_ID = (1 << 63) - 1
LEAST = -(1 << 63)


@dataclass
class Block:
    """Anchors' vectors, labels and row numbers, and for each of them windows of scores, least and greatest (empty ones: least above greatest)."""

    vectors: np.ndarray
    label: np.ndarray
    row: np.ndarray
    low: np.ndarray
    high: np.ndarray


class Best:
    """The k best of what each of ``n`` lists was shown: higher score, smaller id, smaller row first."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.score = np.full((n, k), LEAST, np.int64)
        self.id = np.full((n, k), NO_ID, np.int64)
        self.row = np.full((n, k), -1, np.int64)

    def floor(self) -> np.ndarray:
        """The score that a newcomer to each list must reach."""
        return self.score[:, -1]

    def add(self, which: np.ndarray, score: np.ndarray, id_: np.ndarray, row: np.ndarray) -> None:
        last, last_id = self.score[which, -1], self.id[which, -1]
        keep = (score > last) | ((score == last) & (id_ <= last_id)) | (self.row[which, -1] < 0)
        which, score, id_, row = which[keep], score[keep], id_[keep], row[keep]
        if not len(which):
            return
        old = np.unique(which)
        at = self.row[old] >= 0
        which = np.concatenate([np.repeat(old, at.sum(1)), which])
        score, id_, row = (np.concatenate([mine[old][at], new]) for mine, new in ((self.score, score), (self.id, id_), (self.row, row)))
        order = np.lexsort((row, id_, ~score, which))
        which, score, id_, row = which[order], score[order], id_[order], row[order]
        nth = np.arange(len(which)) - np.searchsorted(which, which)
        top = nth < self.k
        self.row[old] = -1
        place = which[top], nth[top]
        self.score[place], self.id[place], self.row[place] = score[top], id_[top], row[top]
        short = self.row[old] < 0
        self.score[old] = np.where(short, LEAST, self.score[old])
        self.id[old] = np.where(short, NO_ID, self.id[old])

    def rows(self) -> tuple[np.ndarray, ...]:
        which, nth = np.nonzero(self.row >= 0)
        return which, self.score[which, nth], self.id[which, nth], self.row[which, nth]


def products(a: np.ndarray, b: np.ndarray, exact: bool) -> np.ndarray:
    """Inner products of rows of integers: doubles that hold integers, or longs (kept within their range)."""
    if exact:
        return a.astype(np.float64) @ b.astype(np.float64).T
    return np.clip(a.astype(object) @ b.astype(object).T, LEAST, NO_ID).astype(np.int64)


def _pieces(rows: int, anchors: int) -> Iterator[slice]:
    """A batch in growing pieces: the first ones raise the floors that later ones are held against."""
    at, size = 0, 64
    most = max(64, SCORES // max(1, anchors))
    while at < rows:
        yield slice(at, min(rows, at + size))
        at, size = at + size, min(most, size * 4)


def _pass(shared: Broadcast, size: int, k: int, exact: bool, windows: int):
    """windows 0: each anchor's best rows of its label; else its best of other labels in each of so many windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: Block = shared.value
        n = len(block.row)
        kind = np.float64 if exact else np.int64
        lists = [Best(n, k) for _ in range(max(1, windows))]
        for batch in batches:
            mine = batch.filter(pa.array(batch.column("size").to_numpy() == size))
            if not mine.num_rows:
                continue
            vectors, label, row = matrix(mine), mine.column("label").to_numpy(), mine.column("row").to_numpy()
            ids = mine.column("vec_id").fill_null(NO_ID).to_numpy()
            for piece in _pieces(len(row), n):
                score = products(block.vectors, vectors[piece], exact)
                same = block.label[:, None] == label[piece][None, :]
                for w, best in enumerate(lists):
                    if windows:
                        least = np.maximum(best.floor(), block.low[:, w]).astype(kind)
                        fits = ~same & (score >= least[:, None]) & (score <= block.high[:, w].astype(kind)[:, None])
                    else:
                        fits = same & (score >= best.floor().astype(kind)[:, None])
                    which, at = np.nonzero(fits)
                    if not windows:
                        other = block.row[which] != row[piece][at]
                        which, at = which[other], at[other]
                    best.add(which, score[which, at].astype(np.int64), ids[piece][at], row[piece][at])
        for w, best in enumerate(lists):
            which, score, id_, row = best.rows()
            if len(which):
                names = {"anchor": block.row[which], "window": np.full(len(which), w), "vec_id": id_, "row": row, "score": score}
                yield pa.record_batch([pa.array(c.astype(np.int64)) for c in names.values()], names=list(names))

    return run


HITS = "anchor long, window long, vec_id long, row long, score long"


def _first(hits: DataFrame, k: int) -> DataFrame:
    """``hits`` of all tasks merged: the k best of each list, with ``rank``."""
    order = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "vec_id", "row")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def window(score: int, low: int, high: int) -> tuple[int, int]:
    """The scores s with ``low * score <= 100 * s <= high * score``; the least above the greatest where there is none."""
    return max(-(-low * score // 100), LEAST), min(high * score // 100, NO_ID)


def mine(vectors: DataFrame, label: Column | None = None, every: int = 50, scale: float = 256.0, positives: int = 5, k: int = 3, low: int = 50, high: int = 95) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score, positive_rank``.

    Anchors are the rows whose id ``every`` divides. label: takes the place of the column ``label``.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), (F.col("label") if label is None else label).cast("long").alias("label"), "embedding").where("label IS NOT NULL")
    rows = store.table(integer_rows(rows, scale).withColumn("row", F.monotonically_increasing_id()), "vectors")
    found = []
    for size, _, most in sizes(rows):
        exact = most * most * max(1, size) < EXACT
        each = max(1, BLOCK_BYTES // (8 * max(1, size)))
        own = rows.where((F.col("size") == size) & (F.col("vec_id") % every == 0))
        # dealt by hash, then put together up to the bound: blocks without a sort of all anchors
        spread = max(1, -(-own.count() // each))
        blocks = store.table(own.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(2 * spread))), "anchors")
        for part in _grouped({r.block: r["count"] for r in blocks.groupBy("block").count().collect()}, each):
            got = blocks.where(F.col("block").isin(part)).select("vec_id", "label", "row", "vector").toArrow()
            for at in range(0, got.num_rows, each):  # a part beyond the bound goes in several
                found.append(_block(spark, rows, got.slice(at, each), size, exact, positives, k, low, high))
        store.drop(spark, blocks)
    if not found:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long, positive_rank int")
    return spark.read.parquet(*found)


def _grouped(counts: dict[int, int], most: int) -> Iterator[list[int]]:
    """Parts put together up to ``most`` rows."""
    held: list[int] = []
    size = 0
    for part, n in sorted(counts.items()):
        if held and size + n > most:
            yield held
            held, size = [], 0
        held.append(part)
        size += n
    if held:
        yield held


def _block(spark, rows: DataFrame, anchors: pa.Table, size: int, exact: bool, positives: int, k: int, low: int, high: int) -> str:
    """Both passes for one block of anchors; where the result lies."""
    block = Block(matrix(anchors), anchors.column("label").to_numpy(), anchors.column("row").to_numpy(), *np.zeros((2, anchors.num_rows, 0), np.int64))
    columns = ["vec_id", "label", "row", "size", "vector"]
    shared = spark.sparkContext.broadcast(block)
    of_label = store.table(_first(rows.select(*columns).mapInArrow(_pass(shared, size, positives, exact, 0), HITS), positives), "positives")
    place = {row: i for i, row in enumerate(block.row.tolist())}
    block.low, block.high = np.full((2, len(place), positives), 0, np.int64)
    block.high[:] = -1
    scores = of_label.select("anchor", "rank", "score").toArrow()  # ``positives`` numbers an anchor of the block
    for row, rank, score in zip(*(scores.column(c).to_pylist() for c in ("anchor", "rank", "score"))):
        block.low[place[row], rank - 1], block.high[place[row], rank - 1] = window(score, low, high)
    again = spark.sparkContext.broadcast(block)
    negatives = _first(rows.select(*columns).mapInArrow(_pass(again, size, k, exact, positives), HITS), k)
    known = lambda c: F.when(F.col(c) < F.lit(NO_ID), F.col(c))
    good = of_label.select("anchor", (F.col("rank") - 1).cast("long").alias("window"), known("vec_id").alias("positive_id"), F.col("score").alias("positive_score"), F.col("rank").alias("positive_rank"))
    bad = negatives.select("anchor", "window", F.col("rank").cast("int").alias("rank"), known("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    names = spark.createDataFrame(pa.table({"anchor": anchors.column("row"), "anchor_id": anchors.column("vec_id")}))
    out = good.join(bad, ["anchor", "window"]).join(names, "anchor")
    path = store.write(out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score", F.col("positive_rank").cast("int").alias("positive_rank")), "negatives")
    shared.destroy()
    again.destroy()
    store.drop(spark, of_label)
    return path
