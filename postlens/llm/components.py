"""Connected components by alternating large-star and small-star steps.

Each step is two shuffles of the edges; a component of n nodes needs about
log(n) steps. Nothing but one count and one checksum reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import store


def _star(both: DataFrame, small: bool) -> DataFrame:
    """both: ``u, v`` as neighbours of u. Links v (and u) to the least node around u."""
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    joined = both.join(least, "u")
    return joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")) if not small else joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))


def connected_components(edges: DataFrame) -> DataFrame:
    """edges: ``a, b`` longs. Returns ``node, component`` (the component's least node) for all nodes with an edge."""
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now, last = store.table(now, "edges"), None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both, small=False).where("u <> v").distinct()
        # each node keeps its smaller neighbours only; they and it move to the least of them
        new = store.table(_star(large, small=True).where("u <> v").distinct(), "edges")
        state = tuple(new.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
        store.drop(now.sparkSession, now)
        now = new
        if state == last:
            break
        last = state
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
