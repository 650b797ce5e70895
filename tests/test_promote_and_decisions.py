import datetime as dt
import itertools

import pytest
from pyspark.sql import functions as F

from postlens.operators import decisions as X
from postlens.operators import ops
from postlens.plans import promote as P

D = [dt.date(2024, 1, d) for d in (1, 2, 3)]
ROWS = "snapshot_date date, a string, b string, n int, tags array<string>"


def table(spark, *rows):
    return spark.createDataFrame(list(rows), ROWS)


def test_digest_of_a_multiset(spark):
    base = [(D[0], "x", "y", 1, ["p", None]), (D[0], "x", None, 2, []), (D[0], None, "x", None, None)]
    of = lambda *rows: tuple(P.digests(table(spark, *rows), "snapshot_date").first())[1:]
    want = of(*base)
    assert of(*reversed(base)) == want and of(base[0], *base) != want and of(*base[:2]) != want
    changed = [(0, "y", "x", 1, ["p", None]), (0, "x", "y", 1, [None, "p"]), (0, "x", "y", None, ["p", None]), (0, "x", "y", 1, ["p"])]
    assert len({of((D[0], *c[1:]), *base[1:]) for c in changed} | {want}) == len(changed) + 1
    assert of(base[0], base[0]) != of(base[1], base[1])  # an even number of copies: the sum tells them apart
    swapped = table(spark, *base).select("snapshot_date", F.col("b").alias("a"), F.col("a").alias("b"), "n", "tags")
    assert tuple(P.digests(swapped, "snapshot_date").first())[1:] != want


def outcomes(df):
    return {r.partition: (r.outcome, r.staged_rows, r.stored_rows, r.reason) for r in df.collect()}


def test_promote_or_verify(spark, tmp_path):
    target = str(tmp_path / "store")
    day = lambda d, *v: [(d, x, "y", 1, []) for x in v]
    first = table(spark, *day(D[0], "a", "b"), *day(D[1], "c"))
    assert outcomes(P.promote(first, target, dry_run=True)) == {"2024-01-01": ("missing", 2, None, None), "2024-01-02": ("missing", 1, None, None)}
    assert not (tmp_path / "store").exists()
    assert {v[0] for v in outcomes(P.promote(first, target)).values()} == {"generated"}
    files = sorted(p.name for p in (tmp_path / "store").rglob("*.parquet"))
    again = table(spark, *day(D[0], "b", "a"), *day(D[1], "c", "c"), *day(D[2], "d")).repartition(3)
    assert outcomes(P.promote(again, target)) == {"2024-01-01": ("preserved", 2, 2, None), "2024-01-02": ("refused", 2, 1, "MISMATCH"), "2024-01-03": ("generated", 1, None, None)}
    assert set(files) < {p.name for p in (tmp_path / "store").rglob("*.parquet")} and spark.read.parquet(target).count() == 4
    assert outcomes(P.promote(first.withColumn("n", F.col("n").cast("long")), target))["2024-01-01"] == ("refused", 2, None, "SCHEMA_DIFFERS")
    assert P.discover_days(spark, [target, str(tmp_path / "none")]) == [str(d) for d in D]
    assert P.promote(first.limit(0), target).count() == 0


def test_backfill_results(spark, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    rows = lambda *days: table(spark, *[(d, "x", "y", 1, []) for d in days])
    P.promote(rows(D[0]), a), P.promote(rows(D[0], D[1]), b)
    flags = lambda: ops.coverage(P.artifact_days(spark, {"a": a, "b": b}))
    before = spark.createDataFrame(flags().collect(), flags().schema)
    made = P.promote(rows(D[0], D[1], D[2]), a).withColumn("artifact", F.lit("a"))
    made = made.unionByName(P.promote(rows(D[0]).withColumn("a", F.lit("other")), b).withColumn("artifact", F.lit("b")))
    got = {r.date: (r.result, r.refused) for r in P.backfill_results(before, flags(), made, ["a", "b"], ["a"]).collect()}
    assert got == {D[0]: ("FAILED", ["b"]), D[1]: ("BACKFILLED", []), D[2]: ("PARTIAL_BACKFILL", [])}
    none = made.limit(0)
    got = {r.date: r.result for r in P.backfill_results(flags(), flags(), none, ["a", "b"], ["b"]).collect()}
    assert got == {D[0]: "ALREADY_COMPLETE", D[1]: "ALREADY_COMPLETE", D[2]: "NOT_RECOVERABLE"}


# decisions

STATUS = ["conflict", "unknown", "partial", "not_experience", "ok", None, "odd"]
KINDS = ["hard_min", "range", "prefer_only", "none", "mixed", "unknown", None]
TAGS = [[], ["ai"], ["game"], ["ai", "game"], ["zzz"], ["game", "zzz"], None]
YEARS = [None, 0.0, 5.0, 9.0]


def plain_experience(status, kind, years, tags):
    """The 13 rules once more, in plain Python."""
    tags = set(tags or [])
    good, bad, other = tags & {"ai"}, tags & {"game"}, tags - {"ai", "game"}
    high = years is not None and years > 5
    if status == "conflict":
        return 1, "grey", ["experience_conflict"]
    if status not in ("partial", "not_experience", "ok"):
        return 2, "grey", ["experience_unknown"]
    if kind == "mixed":
        return 3, "grey", ["experience_mixed_requirement"]
    if status == "partial":
        return 4, "grey", ["experience_partial"]
    if status == "not_experience":
        return 5, "pass", ["experience_no_requirement"]
    if kind == "none":
        return 6, "pass", ["experience_no_requirement"]
    only_bad = bool(bad) and not good and not other
    if high:
        return (7, "reject", ["years_too_high", "experience_required_tags_mismatch"]) if only_bad else (8, "reject", ["years_too_high"])
    if good and bad:
        return 9, "grey", ["experience_required_tags_conflict"]
    if other:
        return 10, "grey", ["experience_required_tags_unknown"]
    if only_bad:
        return 11, "reject", ["experience_required_tags_mismatch"]
    return (12, "pass", ["prefer_only_not_blocking"]) if kind == "prefer_only" else (13, "pass", ["years_ok", "experience_required_tags_match"])


@pytest.fixture(scope="module")
def experience(spark):
    rows = list(itertools.product(STATUS, KINDS, YEARS, TAGS))
    return spark.createDataFrame(rows, "experience_parse_status string, experience_requirement_type string, experience_min_years double, experience_required_tags array<string>")


def test_experience_table(experience):
    got = X.decide(experience, X.EXPERIENCE, X.experience_facts(["ai"], ["game"], 5.0), "experience").collect()
    assert len(got) == len(STATUS) * len(KINDS) * len(YEARS) * len(TAGS)
    for r in got:
        assert (r.experience_rule, r.experience_decision, r.experience_reason_codes) == plain_experience(*r[:4]), r


def test_what_a_table_hides(experience):
    facts = X.experience_facts(["ai"], ["game"], 5.0)
    told = {(r.problem, r.rule, r.other) for r in X.table_problems(experience, X.EXPERIENCE, facts).collect()}
    assert not [t for t in told if t[0] in ("NEVER_HOLDS", "SHADOWED", "UNDECIDED")]
    assert ("CONFLICT", 1, 8) in told and ("CONFLICT", 7, 8) not in told
    turned = tuple(X.Rule({7: 8, 8: 7}.get(r.number, r.number), r.when, r.decision, r.codes) for r in X.EXPERIENCE)  # the wider rule first
    told = {(r.problem, r.rule, r.other) for r in X.table_problems(experience.where("experience_parse_status = 'ok'"), turned, facts).collect()}
    assert ("SHADOWED", 8, 7) in told or ("SHADOWED", 8, 3) in told
    assert ("NEVER_HOLDS", 1, None) in told and ("NEVER_HOLDS", 5, None) in told
    short = X.EXPERIENCE[:12]
    n = X.decide(experience, X.EXPERIENCE, facts, "x").where("x_rule = 13").count()
    assert [(r.problem, r.n) for r in X.table_problems(experience, short, facts).where("problem = 'UNDECIDED'").collect()] == [("UNDECIDED", n)]


def test_education_table(spark):
    fields = "education_parse_status string, education_degree_barrier string, education_degree_prefer array<string>, education_major_barrier array<string>, education_major_prefer array<string>"
    case = lambda *x: ("ok", *x)
    rows = [
        (("conflict", None, None, None, None), 1, "grey"), ((None, "phd", None, None, None), 2, "grey"), (("partial", "phd", None, None, None), 3, "grey"), (("not_education", "phd", None, None, None), 4, "pass"),
        (case("none", [], [], []), 5, "pass"), (case("phd", [], ["law"], []), 6, "reject"), (case("phd", [], ["cs"], []), 7, "reject"), (case("bachelor", [], ["law"], []), 8, "reject"),
        (case("bachelor", ["master"], [], []), 9, "pass"), (case("bachelor", ["phd"], [], []), 12, "pass"), (case("bachelor", [], ["cs"], ["law"]), 11, "pass"), (case("bachelor", ["phd"], ["cs"], ["law"]), 13, "pass"),
    ]
    df = spark.createDataFrame([r[0] for r in rows], fields)
    got = {repr(tuple(r[:5])): (r.education_rule, r.education_decision) for r in X.decide(df, X.EDUCATION, X.education_facts("master", ["cs"]), "education").collect()}
    assert got == {repr(k): (n, d) for k, n, d in rows}


def test_city_and_pool(spark):
    df = spark.createDataFrame([(1, ["深圳"], "pass", "pass"), (2, ["北京"], "pass", "reject"), (3, ["unknown", ""], "grey", "pass"), (4, None, "pass", "pass"), (5, ["深圳"], "grey", "pass"), (6, ["深圳"], "reject", "grey")], "id int, city_norm array<string>, education_decision string, experience_decision string")
    rows = X.final_pool(X.decide(df, X.CITY, X.city_facts(["深圳"]), "city")).orderBy("id").collect()
    assert [(r.city_rule, r.final_pool, r.final_reason_codes) for r in rows] == [
        (1, "candidate", ["city_ok", "education_ok", "experience_ok", "all_core_dimensions_pass"]), (2, "rejected", ["city_mismatch", "experience_reject"]), (3, "rejected", ["city_unknown"]),
        (3, "rejected", ["city_unknown"]), (1, "grey", ["has_grey_dimension"]), (1, "rejected", ["education_reject"]),
    ]


def test_provable_conflicts(spark):
    fields = "case_id string, content_sha256 string, in_scope boolean, role string, relation string"
    cases = spark.createDataFrame([("a", "h1", True, "qa", "core"), ("b", "h2", False, "qa", None), ("c", "h3", True, "dev", "core")], fields)
    oracle = spark.createDataFrame([("o1", "h1", True, "dev", "core"), ("o2", "h9", True, "x", "y"), ("o3", "h3", True, "dev", "core")], fields)
    show = lambda o: {tuple(r) for r in X.provable_conflicts(cases, oracle, ["role", "relation"], o).collect()}
    clash, stop = ("a", "o1", "role", "qa", "dev", "IDENTICAL_FULL_CONTENT_SHA256"), ("b", None, "role", "qa", None, "STOP_SEMANTICS")
    assert show(None) == {clash, stop}
    new = spark.createDataFrame([("a", "role", "dev"), ("c", "relation", None)], "case_id string, field string, value string")
    assert show(new) == {stop, ("c", "o3", "relation", None, "core", "IDENTICAL_FULL_CONTENT_SHA256")}
