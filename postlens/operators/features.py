"""Parsed experience and education: buckets, preferences, statuses. The decisions themselves are tables (``decisions``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

c = F.col
PREFERENCE = r"优先|加分|更佳|尤佳|者优先|可考虑"
#: Worst first (fixed values).
STATUS_ORDER = ("conflict", "partial", "ok", "not_required", "unknown")


def years_bucket(years: Column) -> Column:
    return F.when(years.isNull(), "unknown").when(years <= 0, "none").when(years < 1, "0_1").when(years < 3, "1_3").when(years < 5, "3_5").when(years < 8, "5_8").otherwise("8_plus")


def hard_and_preferred(clauses: Column) -> Column:
    """``struct<hard, preferred>``: clauses with a word of preference apart."""
    wish = lambda x: x.rlike(PREFERENCE)
    return F.struct(F.filter(clauses, lambda x: ~wish(x)).alias("hard"), F.filter(clauses, wish).alias("preferred"))


def worst_status(rows: DataFrame, keys: list[str]) -> DataFrame:
    rank = F.array_position(F.array(*[F.lit(x) for x in STATUS_ORDER]), c("status"))
    return rows.groupBy(*keys).agg(F.min_by("status", rank).alias("status"))


def joined(values: Column) -> Column:
    return F.array_join(F.array_distinct(values), ";")


def summary(rows: DataFrame, pool: str = "pool", reasons: str = "reasons", top: int = 10) -> tuple[DataFrame, DataFrame]:
    """Counts by pool, and the most frequent reasons."""
    why = rows.select(F.explode(reasons).alias("reason")).groupBy("reason").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "reason").limit(top)
    return rows.groupBy(pool).agg(F.count("*").alias("n")), why
