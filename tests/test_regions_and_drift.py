import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from postlens.sources import drift, postings, regions

DAY = dt.date(2024, 1, 1)


def pages(spark, lists, size=2):
    """lists: region -> (stated total, ids); cut into pages."""
    rows = []
    for region, (total, ids, *more) in lists.items():
        cut = [ids[k : k + size] for k in range(0, len(ids), size)] or [[]]
        for n, mine in enumerate(cut + list(more), 1):
            rows.append(("aliyun", region, n, json.dumps({"content": {"totalCount": total, "datas": [{"id": i, "name": f"t{i}", "workLocations": ["深圳"]} for i in mine]}})))
    return spark.createDataFrame(rows, "platform string, region string, page int, payload string")


def told(spark, lists, cap=4):
    return {r.region: (r.stopped_by, r.complete, r.pages_fetched, r.records_fetched, r.unique_job_ids, r.duplicates_within) for r in regions.details(regions.ledger(pages(spark, lists), "aliyun"), 2, cap).collect()}


def test_where_a_list_ends(spark):
    got = told(spark, {"a": (3, [1, 2, 3]), "b": (0, []), "c": (0, [1]), "d": (9, [1, 2, 3, 4], []), "e": (3, [1, 2], []), "f": (5, [1, 2, 1, 2]), "g": (4, [1, 1, 2, 3]), "h": (9, [1, 2]), "i": (3, [1, 2, 3], [4, 5])})
    assert got == {
        "a": ("source_total_reached", True, 2, 3, 3, 0), "b": ("empty_source", True, 0, 0, 0, 0), "c": ("source_total_mismatch", False, 0, 0, 0, 0), "d": ("partition_limit", False, 2, 4, 4, 0), "e": ("empty_page", False, 1, 2, 2, 0),
        "f": ("repeated_page", False, 1, 2, 2, 0), "g": ("source_total_reached", True, 2, 4, 3, 1), "h": ("pages_missing", False, 1, 2, 2, 0), "i": ("source_total_reached", True, 2, 3, 3, 0),
    }
    changed = pages(spark, {"a": (3, [1, 2])}).unionByName(pages(spark, {"a": (4, [1, 2, 3, 4])}).where("page = 2"))
    assert regions.details(regions.ledger(changed, "aliyun"), 2).first().stopped_by == "source_total_changed"


TREE = [("all", None), ("n", "all"), ("s", "all"), ("n1", "n"), ("n2", "n"), ("s1", "s")]
LISTS = {"all": (7, [1, 2, 3, 4], []), "n": (5, [1, 2, 3, 4], []), "s": (3, [5, 6, 7]), "n1": (3, [1, 2, 3]), "n2": (3, [3, 4, 7]), "s1": (1, [5])}


def covered(spark, lists, cap=4):
    tree = spark.createDataFrame(TREE, "region string, parent string")
    rows = pages(spark, lists)
    found = regions.cover(regions.details(regions.ledger(rows, "aliyun"), 2, cap), tree, cap)
    listed = rows.withColumn("_doc", F.parse_json("payload")).select("platform", "region", "page", F.posexplode(F.variant_get("_doc", "$.content.datas", "array<variant>")).alias("position", "_x")).select("platform", "region", "page", "position", F.variant_get("_x", "$.id", "string").alias("job_id"))
    return found, listed


def test_cover_of_a_capped_list(spark):
    assert {r.region: r.above for r in regions.ancestors(spark.createDataFrame(TREE, "region string, parent string")).collect()} == {"all": [], "n": ["all"], "s": ["all"], "n1": ["all", "n"], "n2": ["all", "n"], "s1": ["all", "s"]}
    found, listed = covered(spark, LISTS)
    assert {r.region: r.role for r in found.collect()} == {"all": "split", "n": "split", "s": "used", "n1": "used", "n2": "used", "s1": "idle"}
    assert sorted(r.job_id for r in regions.covered_postings(listed, found).collect()) == list("1234567")
    assert tuple(regions.proof(listed, found).first()) == ("aliyun", 3, 7, 7, 0, 2, True, [])


def test_what_a_cover_lacks(spark):
    reasons = lambda lists: set(regions.proof(*reversed(covered(spark, lists))).first().reasons)
    assert reasons({k: v for k, v in LISTS.items() if k != "n2"}) == {"REGION_MISSING", "UNION_DEFICIT", "PARTS_DEFICIT"}
    assert reasons({**LISTS, "n2": (9, [3, 4, 7, 8], [])}) == {"REGION_CAPPED", "UNION_EXCESS"}
    assert reasons({**LISTS, "s": (3, [5, 6], [])}) == {"REGION_INCOMPLETE"}
    assert reasons({**LISTS, "n2": (1, [3])}) == {"UNION_DEFICIT", "PARTS_DEFICIT"}


# drift


def landed(spark, *payloads, platform="baidu"):
    return spark.createDataFrame([(platform, DAY, n, p if isinstance(p, str) else json.dumps(p)) for n, p in enumerate(payloads, 1)], "platform string, snapshot_date date, page int, payload string")


GOOD = {"data": {"total": 2, "list": [{"postId": "1", "name": "a", "bgShortName": "b", "workPlace": "c", "workYears": "d", "education": "e", "workContent": "f", "serviceCondition": "g"}]}}


def changed(**more):
    return {"data": {"total": 2, "list": [{k: v for k, v in {**GOOD["data"]["list"][0], **more}.items() if v != "gone"}]}}


def test_paths_of_a_schema():
    got = [(x["path"], x["kind"]) for x in drift.paths_of("OBJECT<a: ARRAY<OBJECT<`b c``: d`: DECIMAL(3,1), e: VOID>>, f: STRING>")]
    assert got == [("$", "OBJECT"), ("$.a", "ARRAY"), ("$.a[]", "OBJECT"), ("$.a[].b c`: d", "DECIMAL"), ("$.a[].e", "VOID"), ("$.f", "STRING")]
    assert drift.paths_of(None) == [] and drift.paths_of("ARRAY<VOID>") == [{"path": "$", "kind": "ARRAY"}, {"path": "$[]", "kind": "VOID"}]


def problems(df):
    return {(r.path, r.problem, r.found, r.pages, r.of_pages) for r in drift.drift(df).collect()}


def test_drift(spark):
    assert problems(landed(spark, GOOD, GOOD)) == set()
    item = "$.data.list[]"
    assert problems(landed(spark, changed(name="gone"), changed(name="gone"))) == {(f"{item}.name", "MISSING", None, 0, 2)}
    assert problems(landed(spark, GOOD, changed(name="gone"))) == set()  # one page has it
    assert problems(landed(spark, changed(workPlace=["x"]), changed(workPlace=["x"]))) == {(f"{item}.workPlace", "RETYPED", "ARRAY", 2, 2), (f"{item}.workPlace[]", "NEW", "STRING", 2, 2)}
    assert problems(landed(spark, GOOD, changed(salary={"min": 1}))) == {(f"{item}.salary", "NEW", "OBJECT", 1, 2)}
    assert problems(landed(spark, {"data": {"total": 0}})) == {("$.data.list", "MISSING", None, 0, 1)}
    assert problems(landed(spark, GOOD, "broken")) == {("$", "UNREADABLE", None, 1, 2)}
    drift.check_shape(landed(spark, GOOD, changed(salary=1)))
    with pytest.raises(ValueError, match=r"SCHEMA_DRIFT: baidu 2024-01-01 \$\.data\.list MISSING"):
        drift.check_shape(landed(spark, {"data": {"total": 0}}))
    assert drift.expected(spark).groupBy("platform").count().count() == len(postings.PLATFORMS)


def test_sweep(spark):
    rows = [("k1", 1, 0, "1", "测试"), ("k1", 1, 1, "2", "猎头顾问"), ("k1", 2, 0, "1", "测试"), ("k2", 1, 0, "2", "测试"), ("k2", 1, 1, "3", "b"), ("k2", 1, 2, "", "b"), ("zz", 1, 0, "9", "x")]
    listed = spark.createDataFrame(rows, "keyword string, page int, position int, job_id string, title string").withColumn("platform", F.lit("liepin"))
    kept, ledger, out = drift.sweep(listed, ["k1", "k2", "k3"], ["猎头"])
    assert sorted((r.job_id, r.keyword) for r in kept.collect()) == [("1", "k1"), ("3", "k2")] and [r.job_id for r in out.collect()] == ["2"]
    assert [tuple(r) for r in ledger.collect()] == [("k1", 2, 3, 1, 1, 1, 0), ("k2", 1, 3, 1, 1, 0, 1), ("k3", 0, 0, 0, 0, 0, 0)]
