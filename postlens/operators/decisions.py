"""Ordered decision tables as data: the first rule that holds decides, and the tables can be looked into.

A rule is a row: a number, conditions over named facts, a decision and its reason codes. ``decide`` makes one ``when`` chain
of a table. Which rules hold for a row (``holding``) shows rules that never fire, rules that an earlier one always
shadows, and pairs that hold together and decide otherwise.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

c = F.col
Facts = dict[str, Column]


@dataclass(frozen=True)
class Rule:
    """number; facts that must all hold (one that starts with "not " must not); decision; reason codes."""

    number: int
    when: tuple[str, ...]
    decision: str
    codes: tuple[str, ...]


# The specification's rules, in its order (fixed values).
EXPERIENCE = (
    Rule(1, ("conflict",), "grey", ("experience_conflict",)),
    Rule(2, ("unknown",), "grey", ("experience_unknown",)),
    Rule(3, ("mixed",), "grey", ("experience_mixed_requirement",)),
    Rule(4, ("partial",), "grey", ("experience_partial",)),
    Rule(5, ("not_asked",), "pass", ("experience_no_requirement",)),
    Rule(6, ("ok", "type_none"), "pass", ("experience_no_requirement",)),
    Rule(7, ("years_too_high", "only_rejected"), "reject", ("years_too_high", "experience_required_tags_mismatch")),
    Rule(8, ("years_too_high",), "reject", ("years_too_high",)),
    Rule(9, ("accepted_and_rejected",), "grey", ("experience_required_tags_conflict",)),
    Rule(10, ("unlisted_tags",), "grey", ("experience_required_tags_unknown",)),
    Rule(11, ("only_rejected",), "reject", ("experience_required_tags_mismatch",)),
    Rule(12, ("prefer_only",), "pass", ("prefer_only_not_blocking",)),
    Rule(13, ("not years_too_high", "tags_fine"), "pass", ("years_ok", "experience_required_tags_match")),
)
EDUCATION = (
    Rule(1, ("conflict",), "grey", ("education_conflict",)),
    Rule(2, ("unknown",), "grey", ("education_unknown",)),
    Rule(3, ("partial",), "grey", ("education_partial",)),
    Rule(4, ("not_asked",), "pass", ("education_no_requirement",)),
    Rule(5, ("ok", "no_degree", "no_major"), "pass", ("education_no_requirement",)),
    Rule(6, ("degree_bad", "major_bad"), "reject", ("degree_too_high", "major_mismatch")),
    Rule(7, ("degree_bad",), "reject", ("degree_too_high", "major_ok")),
    Rule(8, ("major_bad",), "reject", ("degree_ok", "major_mismatch")),
    Rule(9, ("degree_met", "not preferences_differ"), "pass", ("degree_ok", "major_ok")),
    Rule(10, ("major_met", "not preferences_differ"), "pass", ("degree_ok", "major_ok")),
    Rule(11, ("major_wish_bad", "not degree_wish_bad"), "pass", ("degree_ok", "major_prefer_only")),
    Rule(12, ("degree_wish_bad", "not major_wish_bad"), "pass", ("degree_prefer_only", "major_ok")),
    Rule(13, ("degree_wish_bad", "major_wish_bad"), "pass", ("degree_ok", "major_ok")),
)
CITY = (
    Rule(1, ("city_wanted",), "pass", ("city_match",)),
    Rule(2, ("city_known",), "reject", ("city_mismatch",)),
    Rule(3, (), "reject", ("city_unknown",)),
)
TABLES = {"experience": EXPERIENCE, "education": EDUCATION, "city": CITY}
DEGREES = ("none", "college", "bachelor", "master", "phd")


def _has(values: str, allowed: list[str]) -> Column:
    return F.arrays_overlap(F.coalesce(c(values), F.array().cast("array<string>")), F.array(*[F.lit(x) for x in allowed]).cast("array<string>"))


def experience_facts(accepted: list[str], rejected: list[str], max_years: float) -> Facts:
    """Over ``experience_parse_status, experience_requirement_type, experience_min_years, experience_required_tags``; the tags of either list, others are unlisted."""
    tags = F.coalesce("experience_required_tags", F.array().cast("array<string>"))
    good, bad = _has("experience_required_tags", accepted), _has("experience_required_tags", rejected)
    other = F.size(F.array_except(tags, F.array(*[F.lit(x) for x in (*accepted, *rejected)]).cast("array<string>"))) > 0
    status, kind = c("experience_parse_status"), c("experience_requirement_type")
    return {
        "conflict": status == "conflict", "unknown": F.coalesce(~status.isin("conflict", "partial", "ok", "not_experience"), F.lit(True)), "mixed": kind == "mixed", "partial": status == "partial", "not_asked": status == "not_experience", "ok": status == "ok", "type_none": kind == "none",
        "years_too_high": c("experience_min_years") > max_years, "only_rejected": bad & ~good & ~other, "accepted_and_rejected": good & bad, "unlisted_tags": other, "prefer_only": kind == "prefer_only", "tags_fine": ~bad & ~other,
    }


def education_facts(degree: str, majors: list[str]) -> Facts:
    """Over ``education_parse_status``, ``education_degree_barrier, education_degree_prefer`` (names of DEGREES, a list for the latter), and the lists
    ``education_major_barrier, education_major_prefer``; degree and majors: what the candidate has."""
    status = c("education_parse_status")
    rank = lambda x: F.array_position(F.array(*[F.lit(d) for d in DEGREES]), x)
    mine = DEGREES.index(degree) + 1
    barrier = F.coalesce("education_degree_barrier", F.lit("none"))
    asked = lambda k: F.size(F.coalesce(c(k), F.array().cast("array<string>"))) > 0
    met = lambda k: ~asked(k) | _has(k, majors)
    degree_wish_bad = asked("education_degree_prefer") & ~F.exists("education_degree_prefer", lambda x: rank(x) <= mine)
    major_wish_bad = ~met("education_major_prefer")
    return {
        "conflict": status == "conflict", "unknown": F.coalesce(~status.isin("conflict", "partial", "ok", "not_education"), F.lit(True)), "partial": status == "partial", "not_asked": status == "not_education", "ok": status == "ok",
        "no_degree": barrier == "none", "no_major": ~asked("education_major_barrier"), "degree_bad": rank(barrier) > mine, "major_bad": ~met("education_major_barrier"), "degree_met": rank(barrier) <= mine, "major_met": met("education_major_barrier"),
        "degree_wish_bad": degree_wish_bad, "major_wish_bad": major_wish_bad, "preferences_differ": degree_wish_bad | major_wish_bad,
    }


def city_facts(wanted: list[str]) -> Facts:
    """Over ``city_norm``; blank and ``unknown`` names are none."""
    named = F.filter(F.coalesce("city_norm", F.array().cast("array<string>")), lambda x: ~F.coalesce(x, F.lit("")).isin("", "unknown"))
    return {"city_wanted": F.arrays_overlap(named, F.array(*[F.lit(x) for x in wanted]).cast("array<string>")), "city_known": F.size(named) > 0}


def _holds(rule: Rule, fact: Callable[[str], Column]) -> Column:
    one = lambda name: ~fact(name[4:]) if name.startswith("not ") else fact(name)
    return reduce(Column.__and__, map(one, rule.when), F.lit(True))


def decide(rows: DataFrame, table: tuple[Rule, ...], facts: Facts, name: str) -> DataFrame:
    """Adds ``{name}_decision, {name}_reason_codes, {name}_rule``, of the rule of least number that holds; null where none does.

    Facts are computed once; a fact that is null does not hold.
    """
    used = sorted({x.removeprefix("not ") for r in table for x in r.when})
    told = rows.withColumn("_facts", F.struct(*[F.coalesce(facts[k], F.lit(False)).alias(k) for k in used]) if used else F.lit(None))
    chain = None
    for r in sorted(table, key=lambda r: r.number):
        out = F.struct(F.lit(r.decision).alias("decision"), F.array(*[F.lit(x) for x in r.codes]).alias("codes"), F.lit(r.number).alias("rule"))
        when = _holds(r, lambda k: c(f"_facts.{k}"))
        chain = F.when(when, out) if chain is None else chain.when(when, out)
    told = told.withColumn("_out", chain)
    return told.withColumns({f"{name}_decision": c("_out.decision"), f"{name}_reason_codes": c("_out.codes"), f"{name}_rule": c("_out.rule")}).drop("_facts", "_out")


def final_pool(rows: DataFrame, names: tuple[str, ...] = ("city", "education", "experience")) -> DataFrame:
    """Adds ``final_pool`` (candidate, rejected, grey) and ``final_reason_codes``: those of every dimension that rejects, else that some are grey, else that all pass.

    A city's own code tells its mismatch; the other dimensions tell ``{name}_reject``.
    """
    of = lambda k, v: F.coalesce(c(f"{k}_decision") == v, F.lit(False))
    bad = F.array_compact(F.array(*[F.when(of(k, "reject"), c("city_reason_codes")[0] if k == "city" else F.lit(f"{k}_reject")) for k in names]))
    grey = reduce(Column.__or__, [of(k, "grey") | c(f"{k}_decision").isNull() for k in names])
    pool = F.when(F.size(bad) > 0, "rejected").when(grey, "grey").otherwise("candidate")
    fine = F.array(*[F.lit(f"{k}_ok") for k in names], F.lit("all_core_dimensions_pass"))
    return rows.withColumns({"final_pool": pool, "final_reason_codes": F.when(F.size(bad) > 0, bad).when(grey, F.array(F.lit("has_grey_dimension"))).otherwise(fine)})


def holding(rows: DataFrame, table: tuple[Rule, ...], facts: Facts) -> DataFrame:
    """Adds ``rules``, the numbers of all rules that hold, in order."""
    fact = lambda k: F.coalesce(facts[k], F.lit(False))
    return rows.withColumn("rules", F.array_compact(F.array(*[F.when(_holds(r, fact), F.lit(r.number)) for r in sorted(table, key=lambda r: r.number)])))


def table_problems(rows: DataFrame, table: tuple[Rule, ...], facts: Facts) -> DataFrame:
    """``problem, rule, other, n`` over all rows: NEVER_HOLDS; SHADOWED (holds, but ``other`` always decides before it, the one that
    does so most often); CONFLICT (both hold in n rows and decide otherwise, ``rule`` before ``other``); UNDECIDED (no rule holds)."""
    spark = rows.sparkSession
    held = holding(rows, table, facts).groupBy("rules").agg(F.count("*").alias("n"))  # as many rows as there are combinations
    known = spark.createDataFrame([(r.number, r.decision) for r in table], "rule int, decision string")
    each = held.select("rules", "n", F.explode("rules").alias("rule"))
    seen = each.groupBy("rule").agg(F.sum("n").alias("n"), F.sum(F.when(c("rules")[0] == c("rule"), c("n")).otherwise(0)).alias("decides"))
    before = each.where(c("rules")[0] != c("rule")).groupBy("rule", c("rules")[0].alias("other")).agg(F.sum("n").alias("m")).groupBy("rule").agg(F.max_by("other", F.struct("m", -c("other"))).alias("other"))
    never = known.join(seen, "rule", "left_anti").select(F.lit("NEVER_HOLDS").alias("problem"), "rule", F.lit(None).cast("int").alias("other"), F.lit(0).cast("long").alias("n"))
    shadowed = seen.where("decides = 0").join(before, "rule").select(F.lit("SHADOWED").alias("problem"), "rule", "other", "n")
    pairs = each.select("rules", "n", "rule", F.explode("rules").alias("other")).where("rule < other").groupBy("rule", "other").agg(F.sum("n").alias("n"))
    a, b = known.select("rule", c("decision").alias("_a")), known.select(c("rule").alias("other"), c("decision").alias("_b"))
    conflict = pairs.join(a, "rule").join(b, "other").where("_a <> _b").select(F.lit("CONFLICT").alias("problem"), "rule", "other", "n")
    none = held.where(F.size("rules") == 0).select(F.lit("UNDECIDED").alias("problem"), *[F.lit(None).cast("int").alias(k) for k in ("rule", "other")], "n")
    return never.unionByName(shadowed).unionByName(conflict).unionByName(none)


def provable_conflicts(cases: DataFrame, oracle: DataFrame, fields: list[str], overrides: DataFrame | None = None) -> DataFrame:
    """``case_id, oracle_case_id, field, expected, required, proof``: expectations of two case sets that cannot both hold.

    cases, oracle: ``case_id, content_sha256, in_scope`` and text fields. IDENTICAL_FULL_CONTENT_SHA256: the same text with another
    label. STOP_SEMANTICS: a case out of scope that expects a label, though scope decides before. overrides: ``case_id, field, value`` that stand in for a case's own.
    """
    names = ["in_scope", *fields]
    long = lambda df: df.select("case_id", "content_sha256", c("in_scope").alias("_in"), F.inline(F.array(*[F.struct(F.lit(k).alias("field"), c(k).cast("string").alias("value")) for k in names])))
    mine = long(cases)
    if overrides is not None:
        mine = mine.join(overrides.select("case_id", "field", c("value").alias("_new"), F.lit(True).alias("_set")), ["case_id", "field"], "left").withColumn("value", F.when(c("_set"), c("_new")).otherwise(c("value"))).drop("_new", "_set")
    text = F.lit(None).cast("string")
    stop = mine.where(~c("_in") & (c("field") != "in_scope") & c("value").isNotNull()).select("case_id", text.alias("oracle_case_id"), "field", c("value").alias("expected"), text.alias("required"), F.lit("STOP_SEMANTICS").alias("proof"))
    other = long(oracle).select(c("case_id").alias("oracle_case_id"), "content_sha256", "field", c("value").alias("required"))
    same = mine.join(other, ["content_sha256", "field"]).where(~c("value").eqNullSafe(c("required"))).select("case_id", "oracle_case_id", "field", c("value").alias("expected"), "required", F.lit("IDENTICAL_FULL_CONTENT_SHA256").alias("proof"))
    return stop.unionByName(same)
