"""Lists that a platform caps, read region by region: what covers a region whole, and what proves it.

A region whose list is longer than the platform shows is covered by its parts, and theirs in turn. ``details`` tells of each
region's list where reading it ended and why; ``cover`` which regions' lists stand for the whole; ``proof``
whether their union is all that the totals state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import is_missing
from . import postings

c = F.col
CAP = 500


def ledger(pages: DataFrame, platform: str) -> DataFrame:
    """A row a region and page: ``region, page, total, ids`` (in order)."""
    spec = postings.PLATFORMS[platform]
    mine = pages.where(c("platform") == platform).withColumn("_doc", F.try_parse_json("payload"))
    items = F.coalesce(F.try_variant_get("_doc", spec.items, "array<variant>"), F.array().cast("array<variant>"))
    total = F.try_variant_get("_doc", spec.total, "bigint") if spec.total else F.lit(None).cast("long")
    return mine.select(F.coalesce("region", F.lit("")).alias("region"), "page", total.alias("total"), F.transform(items, lambda x: postings.first_text(x, spec.id)).alias("ids"))


def details(pages: DataFrame, page_size: int, cap: int = CAP) -> DataFrame:
    """``region, source_total, expected_pages, pages_fetched, records_fetched, unique_job_ids, duplicates_within, stopped_by, complete``.

    pages: a ``ledger``. The first page's total is the region's. Reading goes on page by page until the first of: another
    total, no record though some are stated (or the reverse), the same ids as an earlier page, or all records read; what
    lies behind that is not counted.
    """
    order = Window.partitionBy("region").orderBy("page")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    rows = pages.withColumns({"stated": F.coalesce(F.first("total").over(upto), F.lit(0)), "n": F.size("ids"), "nth": F.row_number().over(order)})
    rows = rows.withColumns({"read": F.sum("n").over(upto), "again": (c("n") > 0) & (F.row_number().over(Window.partitionBy("region", F.sha2(F.to_json("ids"), 256)).orderBy("page")) > 1)})
    expected = F.ceil(c("stated") / page_size)
    # an empty page is read but not fetched: it is judged by what came before
    fetched = F.when(c("n") > 0, c("nth")).otherwise(c("nth") - 1)
    reached = F.when(fetched >= expected, "source_total_reached").otherwise("page_count_mismatch")
    stop = (
        F.when((c("nth") > 1) & ~c("total").eqNullSafe(c("stated")), "source_total_changed")
        .when((c("stated") == 0) & (c("n") > 0), "source_total_mismatch").when(c("stated") == 0, "empty_source")
        .when((c("n") == 0) & (c("read") >= c("stated")), reached)
        .when((c("n") == 0) & (c("stated") > cap) & (c("read") >= cap), "partition_limit").when(c("n") == 0, "empty_page")
        .when(c("again"), "repeated_page").when(c("read") >= c("stated"), reached)
    )
    rows = rows.withColumn("stop", stop).withColumn("ended", F.sum(F.when(c("stop").isNotNull(), 1).otherwise(0)).over(order.rowsBetween(Window.unboundedPreceding, -1)))
    rows = rows.where(F.coalesce("ended", F.lit(0)) == 0)
    counts = ~c("stop").isin("source_total_changed", "repeated_page", "source_total_mismatch") | c("stop").isNull()
    sums = rows.groupBy("region").agg(
        F.first("stated").alias("source_total"), F.max(expected).cast("long").alias("expected_pages"), F.count_if(counts & (c("n") > 0)).alias("pages_fetched"),
        F.coalesce(F.sum(F.when(counts, c("n"))), F.lit(0)).alias("records_fetched"), F.max("stop").alias("_stop"),
    )
    ids = rows.where(counts).select("region", F.explode("ids").alias("id")).where(~is_missing(c("id"))).groupBy("region").agg(F.count_distinct("id").alias("_unique"), F.count("*").alias("_ids"))
    rows = sums.join(ids, "region", "left").withColumn("unique_job_ids", F.coalesce("_unique", F.lit(0)))
    stopped = F.coalesce("_stop", F.when((c("source_total") > cap) & (c("records_fetched") >= cap), "partition_limit").otherwise("pages_missing"))
    return rows.select("region", "source_total", "expected_pages", "pages_fetched", "records_fetched", "unique_job_ids", (F.coalesce("_ids", F.lit(0)) - c("unique_job_ids")).alias("duplicates_within"), stopped.alias("stopped_by"), stopped.isin("source_total_reached", "empty_source").alias("complete"))


def ancestors(tree: DataFrame) -> DataFrame:
    """``region, above``: the regions that a region lies in, outermost first; tree: ``region, parent`` (null: a whole)."""
    text = "WITH RECURSIVE up(region, above, held) AS (SELECT region, CAST(array() AS ARRAY<STRING>), region FROM {tree} WHERE parent IS NULL UNION ALL SELECT t.region, array_append(up.above, t.parent), t.region FROM {tree} t JOIN up ON t.parent = up.held) SELECT region, above FROM up"
    return tree.sparkSession.sql(text, tree=tree)


def cover(found: DataFrame, tree: DataFrame, cap: int = CAP) -> DataFrame:
    """Adds ``role`` to ``details``: split (over the cap, and its parts have lists), used (its list stands for it), capped (over the cap without
    parts) and idle (inside a region whose own list will do). Regions of the tree without a list, whose whole was split, come as missing."""
    rows = tree.join(found, "region", "left")
    has_list = c("source_total").isNotNull()
    over = F.coalesce((c("source_total") > cap) | (c("stopped_by") == "partition_limit"), F.lit(False))
    parts = tree.join(found.select("region"), "region").where("parent IS NOT NULL").select(c("parent").alias("region"), F.lit(True).alias("_parts")).distinct()
    rows = rows.join(parts, "region", "left").withColumn("_split", over & F.coalesce("_parts", F.lit(False)))
    up = ancestors(tree).withColumn("_above", F.explode_outer("above"))
    state = rows.select(c("region").alias("_above"), c("_split").alias("_above_split"))
    open_ = up.join(state, "_above", "left").groupBy("region").agg(F.bool_and(F.coalesce("_above_split", c("_above").isNull())).alias("_open"))
    rows = rows.join(open_, "region")
    role = F.when(~c("_open"), "idle").when(c("_split"), "split").when(~has_list, "missing").when(over, "capped").otherwise("used")
    return rows.withColumn("role", role).where(has_list | (c("role") == "missing")).drop("_parts", "_split", "_open", "above")


def covered_postings(listed: DataFrame, covered: DataFrame) -> DataFrame:
    """One row an id of the regions whose lists are used: the earliest by region, page and place. listed: postings with ``region``."""
    used = listed.join(covered.where(c("role").isin("used", "capped")).select("region"), "region")
    first = used.where(~is_missing(c("job_id"))).groupBy("platform", "job_id").agg(F.min_by(F.struct(*used.columns), F.struct("region", "page", "position")).alias("_row"))
    return first.select("_row.*")


def proof(listed: DataFrame, covered: DataFrame) -> DataFrame:
    """``platform, regions, stated, unique, within, across, complete, reasons``: whether the union is what the wholes' totals state.

    REGION_MISSING, REGION_CAPPED, REGION_INCOMPLETE: a list that lacks, is cut off, or broke off; UNION_DEFICIT and
    UNION_EXCESS: the union has fewer or more ids than the wholes' totals; PARTS_DEFICIT: a split region's parts state less than it.
    """
    used = listed.join(covered.where(c("role").isin("used", "capped")).select("region"), "region")
    dups = postings.region_duplicates(used)
    unique = used.where(~is_missing(c("job_id"))).groupBy("platform").agg(F.count_distinct("job_id").alias("unique"))
    states = covered.agg(
        F.count_if(c("role").isin("used", "capped")).alias("regions"), F.sum(F.when(c("parent").isNull(), c("source_total"))).alias("stated"),
        F.count_if(c("role") == "missing").alias("_missing"), F.count_if(c("role") == "capped").alias("_capped"), F.count_if((c("role") == "used") & ~c("complete")).alias("_broken"),
    )  # one row
    parts = covered.where("parent IS NOT NULL").groupBy(c("parent").alias("region")).agg(F.sum("source_total").alias("_parts"))
    short = covered.where("role = 'split'").join(parts, "region").agg(F.count_if(c("_parts") < c("source_total")).alias("_short"))
    rows = unique.join(dups, "platform").crossJoin(F.broadcast(states)).crossJoin(F.broadcast(short))
    reasons = F.array_compact(
        F.array(
            F.when(c("_missing") > 0, "REGION_MISSING"), F.when(c("_capped") > 0, "REGION_CAPPED"), F.when(c("_broken") > 0, "REGION_INCOMPLETE"), F.when(c("_short") > 0, "PARTS_DEFICIT"),
            F.when(c("unique") < c("stated"), "UNION_DEFICIT"), F.when(c("unique") > c("stated"), "UNION_EXCESS"),
        )
    )
    return rows.select("platform", "regions", "stated", "unique", "within", "across", (F.size(reasons) == 0).alias("complete"), reasons.alias("reasons"))
