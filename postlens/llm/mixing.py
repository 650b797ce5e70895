"""Mixing sources to target weights by hash-threshold histograms.

DataFrame functions only. Every document gets a 60-bit hash of its id and
text; a source takes the documents whose hash is below its threshold, and as a
larger budget only raises the threshold, budgets are nested. The threshold is
found without sorting documents: sum sizes by source and top hash bits, find
the bucket in which the running sum crosses the budget, and look again, at
finer bits, into that one bucket of each source alone.

Edge cases: a null text has size 0 and is hashed like an empty one; null
sources are one source, ordered last; documents of size 0 take 0 words;
repeated rows share a hash and are taken or left together; an empty table gives
an empty result. Only ``doc_id, text, source`` are read, and further columns of
any name pass through ``mixed_rows`` untouched.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import store

WORDS = r"[^\x20\x09-\x0D]+"
#: Hash bits that each refinement looks at; together 60.
STEPS = (12, 12, 12, 12, 12)
#: Tables of one row a source are broadcast up to so many sources, and merged beyond.
BROADCAST_SOURCES = 100_000


def document_hash(doc_id: str = "doc_id", text: str = "text") -> list[Column]:
    """The 60 leading bits of the MD5 of id and text, as one number for each step."""
    digest = F.md5(F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit(":"), F.coalesce(F.col(text), F.lit(""))))
    return [F.conv(F.substring(digest, 1 + 3 * k, 3), 16, 10).cast("int") for k in range(len(STEPS))]


def source_targets(sizes: DataFrame, weights: tuple[float, ...], cap: float) -> DataFrame:
    """``source, source_size, target`` from the sums by source.

    Weights repeat over the sources in code-point order, null last. All sources
    share the total by weight, none above ``cap`` times its own size; what is
    cut off is shared again by weight. With sources by rising cap-to-weight
    ratio those that end at their cap are a prefix, which running sums give
    without iteration. One row a source goes through one task here: the list of
    sources, not the documents, must fit it.
    """
    in_order = Window.orderBy(F.col("source").isNull(), "source")
    table = sizes.withColumn("_n", F.row_number().over(in_order) - 1)
    table = table.withColumn("_w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_n") % len(weights) + 1).cast("int")))
    table = table.withColumn("_cap", F.col("source_size") * F.lit(float(cap))).withColumn("_ratio", F.col("_cap") / F.col("_w"))
    rising = Window.orderBy("_ratio", "_n")
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    everything = rising.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    table = (
        table.withColumn("_capped", F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
        .withColumn("_rest_w", F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(before), F.lit(0.0)))
        .withColumn("_total", F.sum("source_size").over(everything).cast("double"))
        .withColumn("_level", (F.col("_total") - F.col("_capped")) / F.col("_rest_w"))
        .withColumn("_open", F.col("_ratio") > F.col("_level"))
        .withColumn("_final", F.first(F.when(F.col("_open"), F.col("_level")), ignorenulls=True).over(everything))
    )
    return table.select("source", "source_size", F.least(F.coalesce(F.col("_final") * F.col("_w"), F.col("_cap")), F.col("_cap")).alias("target"))


def _near(table: DataFrame, sources: int) -> DataFrame:
    """A table of one row for each of ``sources`` sources, as the small side of a join if it is one."""
    return F.broadcast(table) if sources <= BROADCAST_SOURCES else table.hint("shuffle_merge")


def _thresholds(docs: DataFrame, targets: DataFrame, sources: int) -> DataFrame:
    """For each source how many whole repeats it takes, and the hash prefix (inclusive) of those taken once more."""
    state = targets.select(
        "source",
        F.floor(F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)).cast("int").alias("_whole"),
        "source_size",
        "target",
    ).withColumn("_left", F.col("target") - F.col("_whole") * F.col("source_size"))
    known: list[str] = []
    for k in range(len(STEPS)):
        at = state.select("source", *known) if k else None
        rows = docs if at is None else docs.join(_near(at, sources), docs["source"].eqNullSafe(at["source"]) & reduce(lambda a, b: a & b, [docs[f"_h{i}"] == at[f"_t{i}"] for i in range(k)]), "left_semi")
        sums = rows.groupBy("source", f"_h{k}").agg(F.sum("size").alias("_sum"))
        running = Window.partitionBy("source").orderBy(f"_h{k}")
        sums = sums.withColumn("_upto", F.sum("_sum").over(running)).withColumn("_below", F.col("_upto") - F.col("_sum"))
        left = state.select(F.col("source").alias("_s"), "_left")
        crossing = sums.join(_near(left, sources), F.col("source").eqNullSafe(F.col("_s"))).where(F.col("_upto") > F.col("_left"))
        found = crossing.groupBy("_s").agg(F.min(F.struct(F.col(f"_h{k}").alias("h"), F.col("_below").alias("b"), F.col("_sum").alias("n"))).alias("_x"))
        last = k == len(STEPS) - 1
        state = state.join(_near(found, sources), F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
        # no crossing: every document of the bucket fits; at the finest bits the boundary document goes in if that comes nearer
        bound = F.col("_x.h") - F.when(F.col("_x.n") - (F.col("_left") - F.col("_x.b")) < F.col("_left") - F.col("_x.b"), 0).otherwise(1) if last else F.col("_x.h")
        state = state.withColumn(f"_t{k}", F.coalesce(bound, F.lit(1 << STEPS[k]))).withColumn("_left", F.col("_left") - F.coalesce(F.col("_x.b"), F.lit(0))).drop("_x")
        known.append(f"_t{k}")
        state = store.table(state, "mix-thresholds")
    return state


def _size() -> Column:
    return F.coalesce(F.regexp_count("text", F.lit(WORDS)), F.lit(0)).cast("long")


def _hashes() -> list[Column]:
    return [h.alias(f"_h{k}") for k, h in enumerate(document_hash())]


def _marks(sized: DataFrame, weights: tuple[float, ...], cap: float) -> DataFrame:
    """A row for each source, as a side to join: target, whole repeats and hash threshold."""
    targets = store.table(source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, cap), "mix-targets")
    sources = targets.count()
    marks = _thresholds(sized, targets, sources).select(F.col("source").alias("_s"), "source_size", "target", "_whole", *[f"_t{k}" for k in range(len(STEPS))])
    return _near(marks, sources)


def _repeats(cap: float) -> Column:
    below, equal = F.lit(False), F.lit(True)
    for k in range(len(STEPS)):
        below = below | (equal & (F.col(f"_h{k}") < F.col(f"_t{k}")))
        equal = equal & (F.col(f"_h{k}") == F.col(f"_t{k}"))
    return (F.col("_whole") + F.when((below | equal) & (F.col("_whole") < F.lit(cap)), 1).otherwise(0)).cast("int")


def mix_sources(docs: DataFrame, weights: tuple[float, ...] = (1.0, 2.0, 3.0), cap: float = 3.0) -> DataFrame:
    """How often the mix takes each document.

    Returns ``doc_id, size, source_size, target, repeats, taken``: words in the
    text, in all texts of its source, the source's target, the times the mix
    repeats the document (0 to ``cap``), and ``repeats * size``.
    """
    sized = store.table(docs.select("doc_id", "source", _size().alias("size"), *_hashes()), "mix-sizes")
    marks = _marks(sized, weights, cap)
    rows = sized.join(marks, F.col("source").eqNullSafe(F.col("_s"))).withColumn("repeats", _repeats(cap))
    return rows.select("doc_id", "size", "source_size", "target", "repeats", (F.col("repeats") * F.col("size")).cast("long").alias("taken"))


def mixed_rows(docs: DataFrame, weights: tuple[float, ...] = (1.0, 2.0, 3.0), cap: float = 3.0) -> DataFrame:
    """The rows of ``docs``, all columns, each as often as the mix takes it. Texts are not shuffled."""
    sized = store.table(docs.select("source", _size().alias("size"), *_hashes()), "mix-sizes")
    marks = _marks(sized, weights, cap)
    row = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_row"), F.col("source").alias("_source"), *_hashes())  # no column meets a working one
    keyed = row.join(marks, F.col("_source").eqNullSafe(F.col("_s")))
    return keyed.withColumn("_n", F.explode(F.array_repeat(F.lit(1), _repeats(cap)))).select("_row.*")
