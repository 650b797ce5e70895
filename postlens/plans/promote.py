"""Promote or verify: results made again are published where there are none, and compared where there are.

A day's rows are written to a staging folder first. A partition that the target lacks is moved there whole; one that it
has is never touched: its digest must be that of the staged rows, else the partition is refused and named.
The digest is of the multiset of rows, whatever their order, files and row groups: their number, and sum and xor of two hashes a row.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .cut import delete, exists, move, partition_values, shared_folder

c = F.col
OUTCOME = "partition string, outcome string, staged_rows long, stored_rows long, reason string"
_PLAIN = ("string", "boolean", "tinyint", "smallint", "int", "bigint", "float", "double", "date", "timestamp", "timestamp_ntz", "binary", "decimal")


def row_hash(df: DataFrame, salt: int) -> Column:
    """64 bits of a row: each column's name, whether it is null, and its value; nested ones as JSON, nulls kept."""
    parts: list[Column] = [F.lit(salt)]
    for name, kind in sorted(df.dtypes):
        value = c(f"`{name}`")
        if not kind.startswith(_PLAIN):
            value = F.to_json(F.struct(value.alias("v")), {"ignoreNullFields": "false"})
        parts += [F.lit(name), value.isNull(), value]
    return F.xxhash64(*parts)


def digests(df: DataFrame, by: str | None = None) -> DataFrame:
    """``by, rows, sum, xor``: equal for equal multisets of rows, and not for rows repeated, lost, or with values in other columns."""
    rows = df if by is None else df.drop(by)
    both = df.select(*([by] if by else []), row_hash(rows, 1).alias("_a"), row_hash(rows, 2).alias("_b"))
    grouped = both.groupBy(*([by] if by else []))
    return grouped.agg(F.count("*").alias("rows"), F.sum(c("_a").cast("decimal(20,0)")).cast("string").alias("sum"), F.bit_xor("_b").alias("xor"))


def discover_days(spark: SparkSession, stores: list[str], column: str = "snapshot_date") -> list[str]:
    """Days that any of the stores has a partition of."""
    return sorted(set().union(*[partition_values(spark, path, column) for path in stores]))


def _stage(df: DataFrame, column: str) -> str:
    path = f"{shared_folder(df.sparkSession)}/postlens/staged-{uuid.uuid4().hex[:12]}"
    df.write.partitionBy(column).parquet(path)
    return path


def promote(df: DataFrame, target: str, column: str = "snapshot_date", dry_run: bool = False) -> DataFrame:
    """Publish the partitions of ``df`` that ``target`` lacks, verify those that it has.

    Returns a row a partition: ``generated`` (moved there), ``preserved`` (there, with the same rows), ``refused`` (there,
    with other rows: MISMATCH, or other columns: SCHEMA_DIFFERS) or, in a dry run, ``missing``. What is there is never written.
    """
    spark = df.sparkSession
    staged = _stage(df, column)
    mine, theirs = partition_values(spark, staged, column), set(partition_values(spark, target, column))
    both = [p for p in mine if p in theirs]
    outcomes = {p: "missing" for p in mine if p not in theirs}
    table: dict[str, tuple] = {}
    if mine:
        new = spark.read.parquet(staged)
        count = {str(r[column]): r["n"] for r in new.groupBy(c(column).cast("string").alias(column)).agg(F.count("*").alias("n")).collect()}
    if both:
        old = spark.read.parquet(target)
        kinds = lambda x: sorted((n, t) for n, t in x.dtypes if n != column)
        inside = c(column).cast("string").isin(*both)
        if kinds(new) != kinds(old):
            table = {p: ("refused", count[p], None, "SCHEMA_DIFFERS") for p in both}
        else:
            a, b = ({str(r[column]): (r["rows"], r["sum"], r["xor"]) for r in digests(x.where(inside).withColumn(column, c(column).cast("string")), column).collect()} for x in (new, old))
            table = {p: ("preserved" if a.get(p) == b.get(p) else "refused", a[p][0], b.get(p, (0,))[0], None if a.get(p) == b.get(p) else "MISMATCH") for p in both}
    for p in outcomes:
        if not dry_run:
            move(spark, f"{staged}/{column}={p}", f"{target}/{column}={p}")
            outcomes[p] = "generated"
        table[p] = (outcomes[p], count[p], None, None)
    delete(spark, staged)
    return spark.createDataFrame([(p, *table[p]) for p in sorted(table)], OUTCOME)


#: Results of a day's backfill (fixed values), by whether it was complete before, is now, and what was made.
def backfill_results(before: DataFrame, after: DataFrame, outcomes: DataFrame, needed: list[str], core: list[str]) -> DataFrame:
    """``date, result, refused``: what became of each day.

    before, after: ``date`` and a flag for each artifact, as ``ops.coverage`` gives them; outcomes: those of all artifacts,
    with ``artifact``. FAILED: a partition was refused; ALREADY_COMPLETE, BACKFILLED: all of ``needed`` are there;
    PARTIAL_BACKFILL: something was made, or all of ``core`` are there; else NOT_RECOVERABLE.
    """
    whole = lambda names, side: F.forall(F.array(*[F.coalesce(c(f"{side}.{n}"), F.lit(False)) for n in names]), lambda x: x)
    made = outcomes.groupBy(c("partition").cast("date").alias("date")).agg(F.bool_or(c("outcome") == "generated").alias("made"), F.array_sort(F.collect_set(F.when(c("outcome") == "refused", c("artifact")))).alias("refused"))
    a, b = (df.withColumn("date", c("date").cast("date")) for df in (before, after))
    rows = b.alias("after").join(a.alias("before"), "date", "left").join(made, "date", "left")
    refused = F.coalesce("refused", F.array().cast("array<string>"))
    result = (
        F.when(F.size(refused) > 0, "FAILED").when(whole(needed, "before"), "ALREADY_COMPLETE").when(whole(needed, "after"), "BACKFILLED")
        .when(F.coalesce("made", F.lit(False)) | whole(core, "after"), "PARTIAL_BACKFILL").otherwise("NOT_RECOVERABLE")
    )
    return rows.select("date", result.alias("result"), refused.alias("refused"))


def artifact_days(spark: SparkSession, stores: dict[str, str], column: str = "snapshot_date") -> DataFrame:
    """``artifact, date`` of every partition there is: what ``ops.coverage`` takes; told by folder names alone."""
    rows = [(name, day) for name, path in stores.items() for day in (partition_values(spark, path, column) if exists(spark, path) else [])]
    return spark.createDataFrame(rows, "artifact string, date string").withColumn("date", c("date").cast("date"))
