"""Predictions held against labelled cases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

c = F.col
#: Order in which a case's main failure is chosen (fixed values).
PRECEDENCE = ("SCOPE_FN", "SCOPE_FP", "RELEVANCE_WRONG", "PRIMARY_ROLE_WRONG", "AI_RELATION_WRONG", "SECONDARY_ROLE_MISSING", "SECONDARY_ROLE_EXTRA", "SECONDARY_FIELD_UNAVAILABLE", "SECONDARY_OUTPUT_INVALID", "MULTI_FIELD_WRONG")
FIELDS = (("market_relevance", "RELEVANCE_WRONG"), ("role_family", "PRIMARY_ROLE_WRONG"), ("ai_relation", "AI_RELATION_WRONG"))


def confusion(rows: DataFrame, expected: str, predicted: str) -> DataFrame:
    """``expected, predicted, n``."""
    return rows.groupBy(c(expected).alias("expected"), c(predicted).alias("predicted")).agg(F.count("*").alias("n"))


def precision_recall(rows: DataFrame, expected: Column, predicted: Column) -> DataFrame:
    """One row: counts, and precision, recall, F1 and accuracy, null over nothing."""
    out = rows.agg(F.count_if(expected & predicted).alias("tp"), F.count_if(~expected & predicted).alias("fp"), F.count_if(~expected & ~predicted).alias("tn"), F.count_if(expected & ~predicted).alias("fn"))
    return out.withColumns(
        {
            "precision": F.try_divide("tp", c("tp") + c("fp")),
            "recall": F.try_divide("tp", c("tp") + c("fn")),
            "f1": F.try_divide(2 * c("tp"), 2 * c("tp") + c("fp") + c("fn")),
            "accuracy": F.try_divide(c("tp") + c("tn"), c("tp") + c("tn") + c("fp") + c("fn")),
        }
    )


def score_cases(rows: DataFrame) -> DataFrame:
    """Adds ``failure_codes, primary_failure, exact_match`` to rows of ``expected`` and ``predicted`` market structs."""
    e, p = (lambda k: c(f"expected.{k}")), (lambda k: c(f"predicted.{k}"))
    none = F.array().cast("array<string>")
    want, got = F.coalesce(e("secondary_role_families"), none), F.coalesce(p("secondary_role_families"), none)
    inside = e("in_scope")
    wrong = [F.when(inside & ~p(f).eqNullSafe(e(f)), code) for f, code in FIELDS]
    unavailable, repeated = p("secondary_role_families").isNull(), F.size(F.array_distinct(got)) != F.size(got)
    differs = unavailable | repeated | (F.size(F.array_except(want, got)) > 0) | (F.size(F.array_except(got, want)) > 0)
    second = [
        F.when(inside & (F.size(F.array_except(want, got)) > 0), "SECONDARY_ROLE_MISSING"),
        F.when(inside & (F.size(F.array_except(got, want)) > 0), "SECONDARY_ROLE_EXTRA"),
        F.when(inside & unavailable, "SECONDARY_FIELD_UNAVAILABLE"),
        F.when(inside & ~unavailable & repeated, "SECONDARY_OUTPUT_INVALID"),
    ]
    scope = F.when(inside & ~p("in_scope"), "SCOPE_FN").when(~inside & p("in_scope"), "SCOPE_FP")
    fields = (inside != p("in_scope")).cast("int") + (inside & differs).cast("int")
    for f, _ in FIELDS:
        fields = fields + (inside & ~p(f).eqNullSafe(e(f))).cast("int")
    codes = F.array_compact(F.array(scope, *wrong, *second, F.when(fields > 1, "MULTI_FIELD_WRONG")))
    rows = rows.withColumn("failure_codes", codes)
    first = F.filter(F.array(*[F.lit(x) for x in PRECEDENCE]), lambda x: F.array_contains("failure_codes", x))
    return rows.withColumns({"primary_failure": F.try_element_at(first, F.lit(1)), "exact_match": F.size("failure_codes") == 0})


def micro_sets(rows: DataFrame, expected: str, predicted: str) -> DataFrame:
    """Micro counts over sets of labels."""
    out = rows.agg(*[F.coalesce(F.sum(F.size(x)), F.lit(0)).alias(k) for k, x in (("tp", F.array_intersect(expected, predicted)), ("fp", F.array_except(predicted, expected)), ("fn", F.array_except(expected, predicted)))])
    return out.withColumns({"precision": F.try_divide("tp", c("tp") + c("fp")), "recall": F.try_divide("tp", c("tp") + c("fn")), "f1": F.try_divide(2 * c("tp"), 2 * c("tp") + c("fp") + c("fn"))})


def pass_rates(rows: DataFrame, tags: str, passed: Column) -> DataFrame:
    """``tag, cases, passed, rate`` of boundary tags."""
    flat = rows.select(F.explode(tags).alias("tag"), passed.alias("ok"))
    return flat.groupBy("tag").agg(F.count("*").alias("cases"), F.count_if("ok").alias("passed")).withColumn("rate", F.try_divide("passed", "cases"))


def migrated(cases: DataFrame, changes: DataFrame, fields: list[str]) -> DataFrame:
    """Cases with approved changes of their expectations, bound to the text they were approved for.

    changes: ``case_id, content_sha256`` and the new ``fields`` (null: unchanged). A change for another text is not applied.
    """
    new = changes.select("case_id", "content_sha256", *[c(f).alias(f"_{f}") for f in fields])
    rows = cases.join(new, ["case_id", "content_sha256"], "left")
    return rows.select(*[F.coalesce(f"_{f}", f).alias(f) if f in fields else c(f) for f in cases.columns])


def case_problems(cases: DataFrame, expected_count: int) -> DataFrame:
    """``problem`` rows: wrong count, repeated case or identity, quotes that are not in the text."""
    sums = cases.agg(F.count("*").alias("n"), F.count_distinct("case_id").alias("ids"), F.count_distinct("platform", "job_id").alias("identities"))
    each = F.array_compact(F.array(F.when((c("n") != expected_count) | (c("ids") != c("n")), "CASE_COUNT_OR_DUPLICATE"), F.when(c("identities") != c("n"), "IDENTITY_DUPLICATE")))
    out = sums.select(F.explode(each).alias("problem"), F.lit(None).cast("string").alias("case_id"))
    for f in ("title", "description", "requirements"):
        bad = cases.where(F.exists(f"evidence.{f}", lambda q: (q == "") | ~F.contains(F.coalesce(f, F.lit("")), q)))
        out = out.union(bad.select(F.lit("EVIDENCE_NOT_IN_TEXT"), "case_id"))
    return out


def regression_problems(cases: DataFrame, frozen: DataFrame, labels: list[str], texts: list[str]) -> DataFrame:
    """``case_id, problem`` of a frozen set of cases that is not what it was: ids that are blank or repeat, cases that came or
    went, texts other than those frozen (by SHA-256), and expectations that are missing.

    cases: ``case_id``, texts and ``expected_<label>``; frozen: ``case_id, content_sha256``.
    """
    digest = F.sha2(F.to_json(F.array(*[F.coalesce(c(t), F.lit("")) for t in texts])), 256)
    rows = cases.select("case_id", digest.alias("_sha"), F.exists(F.array(*[c(f"expected_{k}").isNull() for k in labels]), lambda x: x).alias("_bare")).withColumn("_n", F.count("*").over(Window.partitionBy("case_id")))
    both = rows.join(frozen.select(c("case_id").alias("_id"), c("content_sha256").alias("_old")), c("case_id").eqNullSafe(c("_id")), "full_outer")
    problem = (
        F.when(c("_n").isNull(), "CASE_MISSING")
        .when(c("case_id").isNull() | (c("case_id") == ""), "CASE_ID_BLANK")
        .when(c("_n") > 1, "CASE_REPEATED")
        .when(c("_id").isNull(), "CASE_NOT_FROZEN")
        .when(c("_sha") != c("_old"), "CASE_TEXT_CHANGED")
        .when(c("_bare"), "EXPECTATION_MISSING")
    )
    return both.select(F.coalesce("case_id", "_id").alias("case_id"), problem.alias("problem")).where("problem IS NOT NULL").distinct()


def label_diff(cases: DataFrame, labels: list[str]) -> DataFrame:
    """``case_id, label, expected, actual`` of every label that is another than expected (columns ``expected_<label>``, ``actual_<label>``)."""
    pair = lambda k: F.struct(F.lit(k).alias("label"), c(f"expected_{k}").cast("string").alias("expected"), c(f"actual_{k}").cast("string").alias("actual"))
    rows = cases.select("case_id", F.inline(F.array(*[pair(k) for k in labels])))
    return rows.where(~c("expected").eqNullSafe(c("actual")))


def fixture_identities(rules: list[str], cases: DataFrame, fields: tuple[str, ...] = ("case_id", "job_id", "url", "company")) -> DataFrame:
    """``field, value`` of cases whose identity stands in a rule's pattern: rules may know texts, never single postings."""
    spark = cases.sparkSession
    held = [k for k in fields if k in cases.columns]
    values = cases.select(F.inline(F.array(*[F.struct(F.lit(k).alias("field"), c(k).cast("string").alias("value")) for k in held]))).where("length(value) > 2").distinct()
    patterns = spark.createDataFrame([(r,) for r in rules], "pattern string")
    return values.join(F.broadcast(patterns), F.contains("pattern", c("value")), "left_semi")  # rules are a module's constants


def split_regression(labelled: DataFrame, expected: DataFrame, suite: str = "both") -> tuple[DataFrame, DataFrame]:
    """Market and fit labels held against expectations apart: ``suite, total, passed, failed``, and ``suite, case_id, field, expected, actual`` of what differs.

    labelled: ``case_id`` and the structs ``market`` and ``fit``; expected: ``case_id, in_scope, role_family, ai_relation, seniority_level,
    career_pool, fit_reason_codes``. Fit is judged only of cases that the market takes in. Cases without an expectation, or the reverse, are an error.
    """
    fields = {"market": {k: c(f"market.{k}") for k in ("in_scope", "role_family", "ai_relation", "seniority_level")}, "fit": {"career_pool": c("fit.career_pool"), "fit_reason_codes": F.array_join("fit.reason_codes", ",")}}
    if suite not in ("both", *fields):
        raise ValueError(f"unknown suite: {suite}")
    names = tuple(fields) if suite == "both" else (suite,)
    want = expected.withColumn("fit_reason_codes", F.array_join("fit_reason_codes", ","))
    both = labelled.join(want.select(c("case_id").alias("_id"), *[c(k).alias(f"_{k}") for k in want.columns if k != "case_id"]), c("case_id") == c("_id"), "full_outer")
    stray = both.where("case_id IS NULL OR _id IS NULL").select(F.coalesce("case_id", "_id").alias("id")).orderBy("id").first()
    if stray is not None:
        raise ValueError(f"EXPECTATIONS_MUST_COVER_THE_CASES: {stray.id}")
    total, failures = None, None
    for name in names:
        mine = both.where("market.in_scope") if name == "fit" else both
        each = F.array(*[F.struct(F.lit(k).alias("field"), c(f"_{k}").cast("string").alias("expected"), v.cast("string").alias("actual")) for k, v in fields[name].items()])
        rows = mine.select("case_id", F.filter(each, lambda x: ~x["expected"].eqNullSafe(x["actual"])).alias("wrong"))
        one = rows.agg(F.lit(name).alias("suite"), F.count("*").alias("total"), F.count_if(F.size("wrong") == 0).alias("passed"), F.count_if(F.size("wrong") > 0).alias("failed"))
        bad = rows.select(F.lit(name).alias("suite"), "case_id", F.inline("wrong"))
        total, failures = (one, bad) if total is None else (total.unionByName(one), failures.unionByName(bad))
    return total, failures
