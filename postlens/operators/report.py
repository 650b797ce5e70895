"""Candidate reports, rankings, exclusion breakdowns and the bounded audit bundle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import content_key, or_missing, rx, text_of
from . import ontology as O

c = F.col
#: Fixed values.
STOP_WORDS = ("the", "and", "for", "with", "from", "are", "you", "our", "job", "com", "http", "https", "www", "that", "this", "will", "have", "your")
TERM = r"(?<!\w)[A-Za-z][A-Za-z0-9+.#-]{2,}(?!\w)"


def link_problems(classified: DataFrame, clean: DataFrame, sha: Column | None = None) -> DataFrame:
    """``platform, job_id, problem``: classification rows without posting, of a wrong status, undecided, or of another text.

    clean: ``platform, job_id`` and, if texts are compared, ``content_sha256``.
    """
    ids = clean.select("platform", "job_id", F.lit(True).alias("_linked"), (sha if sha is not None else F.lit(None).cast("string")).alias("_sha"))
    rows = classified.join(ids, ["platform", "job_id"], "left")
    fresh = c("classification_status") == "fresh"
    problem = (
        F.when(c("_linked").isNull(), "UNLINKED_IDENTITY")
        .when(~c("classification_status").isin("fresh", "carried_forward", "review_required"), "INVALID_STATUS")
        .when(fresh & c("career_pool").isNull(), "UNRESOLVED_CANDIDATE")
        .when(fresh & c("_sha").isNotNull() & (c("_sha") != c("content_sha256")), "CONTENT_MISMATCH")
    )
    return rows.withColumn("problem", problem).where("problem IS NOT NULL").select("platform", "job_id", "problem")


def candidates(classified: DataFrame, clean: DataFrame) -> DataFrame:
    """Same-day postings with their classification."""
    return clean.join(classified, ["platform", "job_id"])


def content_groups(rows: DataFrame, key: str = "content_sha256", order: str = "job_id") -> DataFrame:
    """``key, n, first``: postings of one text."""
    return rows.groupBy(key).agg(F.count("*").alias("n"), F.min(order).alias("first"))


def first_occurrences(rows: DataFrame, key: Column | None = None, order: str = "row_number") -> DataFrame:
    """Adds ``occurrence`` (1 for a text's first row) and ``duplicate_of``, the first row's number."""
    keyed = rows.withColumn("_key", content_key() if key is None else key)
    firsts = keyed.groupBy("_key").agg(F.min(order).alias("_first"))  # counts meet before the shuffle, so a text most rows share costs little
    return keyed.join(firsts, keyed["_key"].eqNullSafe(firsts["_key"])).select(rows["*"], F.when(c(order) != c("_first"), c("_first")).alias("duplicate_of"))


def ranking(rows: DataFrame, tags: str, denominator: int | None = None, title: str = "title", order: str = "row_number", examples: int = 3) -> DataFrame:
    """``name, n, share, example_titles``: how many postings have a tag; the first distinct titles stand as examples."""
    flat = rows.select(F.explode(F.array_distinct(tags)).alias("name"), title, order)
    counts = flat.groupBy("name").agg(F.count("*").alias("n"))
    titles = flat.where(text_of(c(title)) != "").groupBy("name", text_of(c(title)).alias("t")).agg(F.min(order).alias("at"))
    few = titles.withColumn("_n", F.row_number().over(Window.partitionBy("name").orderBy("at", "t"))).where(c("_n") <= examples)
    shown = few.groupBy("name").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "t"))), lambda x: x["t"]).alias("example_titles"))
    total = F.lit(rows.count() if denominator is None else denominator)
    return counts.join(shown, "name", "left").withColumn("share", F.coalesce(F.try_divide("n", total), F.lit(0.0))).orderBy(F.desc("n"), "name")


def company_table(selected: DataFrame, scoped: DataFrame) -> DataFrame:
    """``company, matched, in_scope, of_matched, of_in_scope``: two denominators."""
    company = or_missing(c("company")).alias("company")
    both = scoped.groupBy(company).agg(F.count("*").alias("in_scope")).join(selected.groupBy(company).agg(F.count("*").alias("matched")), "company", "left")
    total = F.lit(selected.count())
    both = both.withColumn("matched", F.coalesce("matched", F.lit(0)))
    return both.withColumns({"of_matched": F.try_divide("matched", total), "of_in_scope": F.try_divide("matched", "in_scope")})


def exclusion_breakdown(rows: DataFrame, codes: str = "exclusion_codes", top: int = 5) -> DataFrame:
    """``reason, n, top_companies``: ties go to the company first in order."""
    flat = rows.select(F.explode(codes).alias("reason"), or_missing(c("company")).alias("company"))
    by_company = flat.groupBy("reason", "company").agg(F.count("*").alias("k"))
    best = by_company.withColumn("_n", F.row_number().over(Window.partitionBy("reason").orderBy(F.desc("k"), "company"))).where(c("_n") <= top)
    shown = best.groupBy("reason").agg(F.transform(F.array_sort(F.collect_list(F.struct("_n", "company"))), lambda x: x["company"]).alias("top_companies"))
    return by_company.groupBy("reason").agg(F.sum("k").alias("n")).join(shown, "reason")


def names_missing(configured: DataFrame, observed: DataFrame) -> DataFrame:
    """Configured names that were not observed."""
    return configured.distinct().join(observed.distinct(), configured.columns, "left_anti")


def names_unmatched(configured: DataFrame, observed: DataFrame, selected: DataFrame) -> DataFrame:
    """Names configured and observed of which nothing was selected."""
    return configured.intersect(observed).subtract(selected)


def field_coverage(rows: DataFrame, field: str, body: Column, top: int = 10) -> tuple[DataFrame, DataFrame]:
    """One row ``present, absent_from_body``, and the most frequent values ``value, n``."""
    value = text_of(c(field))
    found = rows.agg(F.count_if(value != "").alias("present"), F.count_if((value != "") & ~F.contains(F.lower(body), F.lower(value))).alias("absent_from_body"))
    values = rows.where(value != "").groupBy(value.alias("value")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "value").limit(top)
    return found, values


def counters(rows: DataFrame) -> DataFrame:
    """``rows, blank_titles, blank_texts, distinct_ids, repeated_ids``."""
    out = rows.agg(F.count("*").alias("rows"), F.count_if(text_of(c("title")) == "").alias("blank_titles"), F.count_if((text_of(c("description")) == "") & (text_of(c("requirements")) == "")).alias("blank_texts"), F.count_distinct("platform", "job_id").alias("distinct_ids"))
    return out.withColumn("repeated_ids", c("rows") - c("distinct_ids"))


def term_candidates(rows: DataFrame, text: Column, rules: tuple = O.SKILLS, least: int = 3, top: int = 40, company: str = "company", pattern: str = TERM) -> DataFrame:
    """``term, job_count, company_breadth``: Latin words outside the known rules' matches, in ``least`` postings or more."""
    body = text
    for _, known in rules:
        body = F.regexp_replace(body, rx(known), " ")
    words = F.array_distinct(F.transform(F.regexp_extract_all(body, F.lit(rx(pattern)), 0), F.lower))
    flat = rows.select(F.explode(words).alias("term"), company).where(~c("term").isin(*STOP_WORDS))
    out = flat.groupBy("term").agg(F.count("*").alias("job_count"), F.count_distinct(company).alias("company_breadth"))
    return out.where(c("job_count") >= least).orderBy(F.desc("job_count"), "term").limit(top)


def audit_categories(rows: DataFrame) -> DataFrame:
    """``platform, job_id, category``: why a posting is worth a look.

    rows: ``classified`` (has a row), ``classification_status, career_pool, content_reliable, event_types, near_miss``.
    """
    has_row = F.coalesce("classified", F.lit(False))
    status = F.coalesce("classification_status", F.lit(""))
    each = F.array_compact(
        F.array(
            F.when(has_row & F.arrays_overlap("event_types", F.array(F.lit("NEW"), F.lit("UPDATED"))), "NEW_OR_UPDATED_MARKET"),
            F.when((has_row & (status == "review_required")) | ~c("content_reliable"), "REVIEW_REQUIRED"),
            F.when(has_row & (F.coalesce("career_pool", F.lit("")).isin("X", "REF") | (status == "carried_forward")), "RULE_BOUNDARY"),
            F.when(c("near_miss"), "NEAR_MISS"),
        )
    )
    return rows.select("platform", "job_id", F.posexplode(each).alias("at", "category"))


def audit_sample(categories: DataFrame, per_category: int = 40, at_most: int = 150) -> DataFrame:
    """The postings of the bundle, with their categories: both caps hold, in identity order.

    Whether a posting still fits depends on those before it. A category can use
    no more postings than lie before ``at_most + per_category`` of its own, so
    that many a category are folded, however long the table.
    """
    head = categories.withColumn("_n", F.row_number().over(Window.partitionBy("category").orderBy("platform", "job_id"))).where(c("_n") <= at_most + per_category)
    chosen, used = {}, {}
    for row in head.orderBy("platform", "job_id", "at").toLocalIterator():
        key = (row.platform, row.job_id)
        if used.get(row.category, 0) < per_category and (key in chosen or len(chosen) < at_most):
            chosen.setdefault(key, []).append(row.category)
            used[row.category] = used.get(row.category, 0) + 1
    return categories.sparkSession.createDataFrame([(*k, v) for k, v in chosen.items()], "platform string, job_id string, categories array<string>")
