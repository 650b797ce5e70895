"""Exact top-k by inner product: ball trees, branch and bound.

Candidates are dealt into shards by a coarse clustering (pivots fitted on a bounded
sample; every vector goes to its nearest), large clusters are split, and each
shard's ball tree is built once and written. Queries go in blocks of one cluster, or
of neighbouring numbers where clusters have few.
A block searches a few shards a round, those of the highest upper bound first; the
k-th scores known then are the lower bounds that the next round starts from. Which
shards a block still needs is told from the roots' balls alone, so a tree is sent
only where some query's bound ``q . centre + |q| * radius`` reaches its k-th score,
and the search ends when none does. In a tree, the nodes that may still hold a hit
are opened level by level, a query's leaves by falling upper bound.

Components are ``floor(scale * x)`` and scores exact integers: products run in
doubles while they stay below 2**53, else in Python's integers; a component beyond
2**62 and a score beyond the range of a long are clamped to it.

Edge cases: vectors that are null or hold a null or a non-finite component take
no part; vectors are held only against those of the same number of components;
with fewer than k candidates a query returns all; equal scores go to the smaller
id; rows that repeat an id are rows of their own, a query excluding only its own
row; null ids are candidates after all others and never queries; an empty table gives an
empty result. Only ``vec_id`` and ``embedding`` are read.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import store

SHARD_ROWS = 8192
BLOCK_QUERIES = 1024
#: Vectors that pivots are fitted on, by hash of their row number, and pivots at most.
SAMPLE, PIVOTS = 4096, 1024
#: Shards whose bounds are looked at in one piece.
ROOTS_AT_ONCE = 4096
#: Shards that a block searches in its first round; so many times more each round.
FIRST_SHARDS, GROWTH = 1, 4
LEAF = 64
EXACT = 1 << 53
HITS = "query long, query_id long, vec_id long, row long, score long"


@dataclass
class Tree:
    """Nodes in the order of their making; a leaf has child -1. A node's vectors are rows low to high."""

    vectors: np.ndarray
    ids: np.ndarray
    rows: np.ndarray
    low: np.ndarray
    high: np.ndarray
    child: np.ndarray
    centre: np.ndarray
    radius: np.ndarray


def build(vectors: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> Tree:
    order = np.arange(len(vectors))
    low, high, child, centre, radius = [0], [len(order)], [], [], []
    node = 0
    while node < len(low):
        a, b = low[node], high[node]
        mine = vectors[order[a:b]].astype(np.float64)
        middle = mine.mean(0)
        centre.append(middle)
        away = np.sqrt(((mine - middle) ** 2).sum(1))
        radius.append(away.max() * (1 + 1e-9))
        if b - a <= LEAF or not away.max():
            child.append(-1)
        else:  # along the line from the farthest vector to the one farthest from that
            one = mine[away.argmax()]
            other = mine[((mine - one) ** 2).sum(1).argmax()]
            order[a:b] = order[a:b][np.argsort(mine @ (other - one), kind="stable")]
            half = (a + b) // 2
            child.append(len(low))
            low += [a, half]
            high += [half, b]
        node += 1
    return Tree(vectors[order], ids[order], rows[order], *(np.array(x) for x in (low, high, child, centre, radius)))


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows, as longs (clamped)."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if most < EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    exact = a.astype(object) @ b.astype(object).T
    return np.clip(exact, -(1 << 63), (1 << 63) - 1).astype(np.int64)


def search(tree: Tree, queries: np.ndarray, own: np.ndarray, floor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hits of all queries that may be among their k best: query number, tree row, score.

    own: the query's own row number; floor: a score that k candidates elsewhere reach already.
    """
    n = len(queries)
    length = np.sqrt((queries.astype(np.float64) ** 2).sum(1))
    score = np.full((n, k), np.iinfo(np.int64).min)
    who = np.full((n, k), -1)

    def bound(q: np.ndarray, node: np.ndarray) -> np.ndarray:
        exact = np.einsum("ij,ij->i", queries[q].astype(np.float64), tree.centre[node])
        reach = length[q] * tree.radius[node]
        return exact + reach + 1 + 1e-9 * (np.abs(exact) + reach)

    q, node = np.arange(n), np.zeros(n, np.int64)
    leaves = []
    while len(q):
        upper = bound(q, node)
        open_ = upper >= floor[q]
        q, node, upper = q[open_], node[open_], upper[open_]
        leaf = tree.child[node] < 0
        leaves.append((q[leaf], node[leaf], upper[leaf]))
        q, node = np.repeat(q[~leaf], 2), (tree.child[node[~leaf]][:, None] + np.arange(2)).reshape(-1)
    q, node, upper = (np.concatenate(x) for x in zip(*leaves))
    order = np.lexsort((-upper, q))
    q, node, upper = q[order], node[order], upper[order]
    at, last = np.searchsorted(q, np.arange(n)), np.searchsorted(q, np.arange(n), side="right")
    live = np.flatnonzero(at < last)
    while len(live):
        best = np.maximum(score[live, -1], floor[live])
        live = live[upper[at[live]] >= best]
        turn = node[at[live]]
        for one in np.unique(turn):
            mine, span = live[turn == one], slice(tree.low[one], tree.high[one])
            new = _products(queries[mine], tree.vectors[span])
            new_who = np.broadcast_to(np.arange(span.start, span.stop), new.shape)
            self_ = tree.rows[span][None, :] == own[mine][:, None]
            all_score = np.concatenate([score[mine], np.where(self_, np.iinfo(np.int64).min, new)], 1)
            all_who = np.concatenate([who[mine], np.where(self_, -1, new_who)], 1)
            name = np.where(all_who < 0, np.iinfo(np.int64).max, tree.ids[np.maximum(all_who, 0)])
            pick = np.lexsort((all_who, name, ~all_score), axis=1)[:, :k]  # ~ turns the order round without overflow
            score[mine], who[mine] = np.take_along_axis(all_score, pick, 1), np.take_along_axis(all_who, pick, 1)
        at[live] += 1
        live = live[at[live] < last[live]]
    q, place = np.nonzero(who >= 0)
    return q, who[q, place], score[q, place]


def _integers(scale: float):
    def integers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("embedding")
            values = lists.values.cast(pa.float64(), safe=False).fill_null(np.nan).to_numpy(zero_copy_only=False)
            at = lists.offsets.to_numpy().astype(np.int64)
            bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
            good = lists.is_valid().to_numpy(zero_copy_only=False) & (bad[at[1:]] == bad[at[:-1]])
            size = np.diff(at)[good]
            end = np.cumsum(size)
            whole = values[np.repeat(at[:-1][good] - (end - size), size) + np.arange(int(size.sum()))]
            data = np.clip(np.floor(whole * scale), -(2.0**62), 2.0**62).astype("<i8")
            vectors = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(np.concatenate([[0], 8 * end]).astype(np.int64)), pa.py_buffer(data)])
            yield pa.record_batch([batch.column("vec_id").filter(pa.array(good)), pa.array(size, pa.int32()), vectors.cast(pa.binary())], names=["vec_id", "size", "vector"])

    return integers


def _matrix(table: pa.Table | pa.RecordBatch) -> np.ndarray:
    return np.frombuffer(b"".join(table.column("vector").to_pylist()), "<i8").reshape(table.num_rows, -1)


def pivots_of(sample: np.ndarray, count: int, rounds: int = 4) -> np.ndarray:
    """Centres by a few rounds of k-means from vectors that lie far apart."""
    x = sample.astype(np.float64)
    chosen, away = [0], ((x - x[0]) ** 2).sum(1)
    while len(chosen) < count and away.max() > 0:
        chosen.append(int(away.argmax()))
        away = np.minimum(away, ((x - x[chosen[-1]]) ** 2).sum(1))
    centre = x[chosen]
    for _ in range(rounds):
        near = nearest(x, centre)
        seen = np.bincount(near, minlength=len(centre))
        sums = np.zeros_like(centre)
        np.add.at(sums, near, x)
        centre[seen > 0] = sums[seen > 0] / seen[seen > 0, None]
    return centre


def nearest(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return ((centre**2).sum(1) - 2 * (x @ centre.T)).argmin(1)


def _cluster(pivots: dict[int, np.ndarray]):
    """Adds the nearest pivot; 0 for vectors of a size that the sample did not have."""

    def cluster(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, found = batch.column("size").to_numpy(), np.zeros(batch.num_rows, np.int32)
            for n in np.unique(size):
                if n in pivots:
                    mine = np.flatnonzero(size == n)
                    found[mine] = nearest(_matrix(batch.take(pa.array(mine))).astype(np.float64), pivots[n])
            yield batch.append_column("cluster", pa.array(found))

    return cluster


def _tree(group: pa.Table) -> pa.Table:
    ids = group.column("vec_id").fill_null(np.iinfo(np.int64).max - 1).to_numpy()
    tree = build(_matrix(group), ids, group.column("row").to_numpy())
    names = pa.schema([("size", pa.int32()), ("shard", pa.int64()), ("centre", pa.binary()), ("radius", pa.float64()), ("tree", pa.binary())])
    return pa.table({"size": group.column("size")[:1], "shard": group.column("shard")[:1], "centre": [tree.centre[0].astype("<f8").tobytes()], "radius": [float(tree.radius[0])], "tree": [pickle.dumps(tree)]}).cast(names)


def upper(queries: np.ndarray, centre: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """Upper bounds of the scores of each query (a row) in each ball (a column), rounding included."""
    q = queries.astype(np.float64)
    exact, reach = q @ centre.T, np.sqrt((q**2).sum(1))[:, None] * radius
    return exact + reach + 1 + 1e-9 * (np.abs(exact) + reach)


def _wanted(key, queries: pa.Table, roots: pa.Table) -> pa.Table:
    """The shards that some query of a block may have hits in, with the highest bound."""
    names = {"size": pa.int32(), "block": pa.int64(), "shard": pa.int64(), "bound": pa.float64()}
    if not queries.num_rows or not roots.num_rows:
        return pa.table({k: pa.array([], t) for k, t in names.items()})
    centre = np.frombuffer(b"".join(roots.column("centre").to_pylist()), "<f8").reshape(roots.num_rows, -1)
    most = upper(_matrix(queries), centre, roots.column("radius").to_numpy())
    floor = queries.column("floor").fill_null(np.iinfo(np.int64).min).to_numpy()
    open_ = (most >= floor[:, None]).any(0)
    n = int(open_.sum())
    return pa.table([pa.array(np.full(n, key[0].as_py()), pa.int32()), pa.array(np.full(n, key[1].as_py()), pa.int64()), pa.array(roots.column("shard").to_numpy()[open_]), pa.array(np.where(most >= floor[:, None], most, -np.inf).max(0)[open_])], names=list(names))


def _searcher(k: int):
    def find(key, trees: pa.Table, queries: pa.Table) -> pa.Table:
        """One shard's tree and one block of queries."""
        names = ["query", "query_id", "vec_id", "row", "score"]
        if not trees.num_rows or not queries.num_rows:
            return pa.table({x: pa.array([], pa.int64()) for x in names})
        tree = pickle.loads(trees.column("tree")[0].as_py())
        own, ids = queries.column("row").to_numpy(), queries.column("vec_id").to_numpy()
        floor = queries.column("floor").fill_null(np.iinfo(np.int64).min).to_numpy()
        q, at, score = search(tree, _matrix(queries), own, floor, k)
        return pa.table(dict(zip(names, (own[q], ids[q], tree.ids[at], tree.rows[at], score))))

    return find


def top_k(vectors: DataFrame, k: int = 10, every: int = 100, scale: float = 1024.0) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best of all other rows for each row whose id ``every`` divides."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).mapInArrow(_integers(scale), "vec_id long, size int, vector binary")
    rows = store.table(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")
    total = rows.count()
    sample = rows.orderBy(F.xxhash64("row"), "row").limit(SAMPLE).select("size", "vector").toArrow()
    pivots, sizes = {}, sample.column("size").to_numpy()
    for n in np.unique(sizes):
        if n:
            mine = _matrix(sample.filter(pa.array(sizes == n)))
            pivots[int(n)] = pivots_of(mine, int(min(PIVOTS, len(mine), max(1, total // SHARD_ROWS))))
    placed = store.table(rows.mapInArrow(_cluster(pivots), "vec_id long, size int, vector binary, row long, cluster int"), "placed")
    query = (F.col("vec_id") % every == 0).cast("int")
    counts = placed.groupBy("size", "cluster").agg(F.count("*").alias("n"), F.coalesce(F.sum(query), F.lit(0)).alias("asked"))
    running = Window.partitionBy("size").orderBy("cluster").rowsBetween(Window.unboundedPreceding, -1)  # a row a cluster
    counts = counts.withColumn("before", F.coalesce(F.sum("asked").over(running), F.lit(0)))
    spread = lambda n, each, salt: F.pmod(F.xxhash64("row", F.lit(salt)), F.greatest(F.lit(1), F.ceil(n / each))).cast("long") + F.shiftleft(F.col("cluster").cast("long"), 32)
    dealt = placed.join(counts, ["size", "cluster"])
    trees = dealt.withColumn("shard", spread(F.col("n"), SHARD_ROWS, 1)).select("size", "shard", "vec_id", "row", "vector")
    trees = store.table(trees.groupBy("size", "shard").applyInArrow(_tree, "size int, shard long, centre binary, radius double, tree binary"), "trees")
    # full blocks: clusters of few queries share one, as a block's search costs a good part alike for few and for many
    place = F.col("before") + F.pmod(F.xxhash64("row", F.lit(2)), F.greatest(F.lit(1), F.col("asked")))
    queries = store.table(dealt.where(query == 1).withColumn("block", F.floor(place / BLOCK_QUERIES).cast("long")).select("size", "block", "vec_id", "row", "vector"), "queries")
    pieces = max(1, -(-trees.count() // ROOTS_AT_ONCE))
    roots = trees.select("size", "shard", "centre", "radius", F.pmod(F.xxhash64("shard"), F.lit(pieces)).alias("piece"))
    blocks = store.again(queries).select("size", "block").distinct()
    roots = roots.join(blocks, "size")  # bounds of all shards for each block: the stated queries against all rows
    done, hits, take = None, None, FIRST_SHARDS
    while True:
        asked = queries.withColumn("floor", F.lit(None).cast("long"))
        if hits is not None:  # a floor holds only where k candidates reach it
            best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "row")
            hits = store.table(hits.withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= k).drop("_n"), "hits")
            floors = hits.groupBy(F.col("query").alias("row")).agg(F.when(F.count("*") >= k, F.min("score")).alias("floor"))
            asked = queries.join(floors, "row", "left")
        keys = ["size", "block", "piece"]
        open_ = asked.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(pieces - 1).cast("long"))))
        wanted = open_.groupBy(*keys).cogroup(roots.groupBy(*keys)).applyInArrow(_wanted, "size int, block long, shard long, bound double")
        if done is not None:
            wanted = wanted.join(done, ["size", "block", "shard"], "left_anti")
        nth = F.row_number().over(Window.partitionBy("size", "block").orderBy(F.desc("bound"), "shard"))
        turn = store.table(wanted.withColumn("nth", nth).where(F.col("nth") <= take).select("size", "block", "shard"), "turn")
        if not turn.limit(1).count():
            break
        keys = ["size", "shard", "block"]
        each = trees.select("size", "shard", "tree").join(store.again(turn), ["size", "shard"])
        found = each.groupBy(*keys).cogroup(asked.join(turn, ["size", "block"]).groupBy(*keys)).applyInArrow(_searcher(k), HITS)
        found = store.table(found, "hits")
        hits = found if hits is None else hits.union(found)
        done = turn if done is None else done.union(turn)
        take *= GROWTH
    if hits is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "row")
    ranked = hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), F.when(F.col("vec_id") < F.lit((1 << 63) - 2), F.col("vec_id")).alias("vec_id"), "score")
