import hashlib
import json

import pytest
from pyspark.sql import functions as F

from postlens.operators import evidence, features, ops, quality, report, scoring
from postlens.sources import files, postings
from postlens.streaming import observations


def test_read_platform(spark):
    page = {"data": {"list": [{"id": 1, "name": "甲", "workPlaceNameList": ["广州", "深圳"], "description": "d", "requirement": "r"}, {"id": 2, "name": "乙", "workPlaceNameList": []}, {"name": "丙"}], "total": 3}}
    pages = spark.createDataFrame([("netease", 1, json.dumps(page)), ("netease", 2, json.dumps({"data": {"list": [{"id": 2, "name": "again"}]}})), ("netease", 3, "broken")], "platform string, page int, payload string")
    rows = postings.read_platform(pages, "netease")
    got = sorted((r.job_id, r.title, r.location, r.description) for r in rows.collect())
    assert got == [("", "丙", "", ""), ("1", "甲", "广州, 深圳", "d"), ("2", "again", "", ""), ("2", "乙", "", "")]
    assert {(r.job_id, r.title) for r in postings.distinct_postings(rows).collect()} == {("1", "甲"), ("2", "乙")}
    m = postings.manifest_counters(rows, ["深圳"], include_unknown=False).first()
    assert (m.records_fetched, m.jobs_mapped, m.jobs_in_scope, m.outside_city_scope, m.unknown_location, m.duplicate_records, m.missing_job_id) == (4, 2, 1, 1, 1, 1, 1)
    ledger = {r.page: r for r in postings.page_ledger(pages, "netease").collect()}
    assert ledger[1].total == 3 and ledger[1].ids == ["1", "2", ""] and ledger[3].empty


def test_platform_shapes(spark):
    payloads = [
        ("aliyun", {"content": {"datas": [{"id": 7, "name": "a", "experience": {"from": 3, "to": 5}, "degree": "Bachelor", "workLocations": ["北京"]}, {"id": 8, "experience": {"from": 2}, "degree": "x"}, {"id": 9, "experience": "None"}]}}),
        ("bytedance", {"data": {"job_post_list": [{"id": 1, "city_info": {"name": "上海"}, "job_category": {"name": "测试", "parent": {"name": "研发"}}}]}}),
        ("jd", [{"requirementId": 5, "positionName": "b", "workCity": "广东省"}]),
        ("kuaishou", {"result": {"list": [{"id": "k", "salaryMin": 10, "workLocationsCode": ["bj", "sh"]}]}}),
        ("meituan", {"data": {"list": [{"jobUnionId": "m", "jobDuty": "duty", "highLight": "light", "department": [{"name": "d1"}, {"name": "d2"}]}]}}),
        ("didi", {"data": {"items": [{"jdNo": "N1", "jdId": "I1", "jobName": "j"}]}}),
    ]
    pages = spark.createDataFrame([(p, 1, json.dumps(x)) for p, x in payloads], "platform string, page int, payload string")
    rows = {(r.platform, r.job_id): r for r in postings.read_all(pages, [p for p, _ in payloads], {"didi": {"name": "D", "detail_url": "https://d/{job_id}"}}).collect()}
    assert [(rows["aliyun", i].experience, rows["aliyun", i].education) for i in "789"] == [("3-5年", "本科"), ("2年以上", "x"), ("", "")]
    assert rows["bytedance", "1"].department == "研发 - 测试" and rows["bytedance", "1"].location == "上海"
    assert rows["jd", "5"].title == "b"
    assert (rows["kuaishou", "k"].salary, rows["kuaishou", "k"].location) == ("10以上", "bj, sh")
    assert (rows["meituan", "m"].description, rows["meituan", "m"].department) == ("duty\nlight", "d1, d2")
    assert (rows["didi", "N1"].url, rows["didi", "N1"].company) == ("https://d/I1", "D")
    assert spark.range(1).select(postings.province_wanted(F.lit("广东省"), ["深圳市"]).alias("x")).first().x is True


def test_details_and_decoding(spark):
    listed = spark.createDataFrame([("p", "1", "list", ""), ("p", "2", "list", "")], "platform string, job_id string, description string, requirements string")
    details = spark.createDataFrame([("p", "1", "detail", " ")], "platform string, job_id string, description string, requirements string")
    assert sorted(r.description for r in postings.with_details(listed, details).collect()) == ["detail", "list"]
    assert spark.range(1).select(postings.decode(F.lit("a, b"), {"a": "甲"}).alias("x")).first().x == "甲, b"


def test_stable_list(spark):
    rows = [(1, 3, ["a", "b"], False), (2, 3, ["b", ""], False)]
    ledger = spark.createDataFrame(rows, "page int, total long, ids array<string>, empty boolean")
    again = lambda *ids: spark.createDataFrame([(list(ids),)], "ids array<string>")
    r = postings.list_problems(ledger, again("a", "c")).first()
    assert r.reasons == ["dynamic_page1", "duplicate_pagination", "unique_deficit", "incomplete_list"] and r.primary == "dynamic_page1"
    assert r.first_hash == hashlib.sha256(b'["a","b"]').hexdigest()
    page = lambda *rows: spark.createDataFrame(list(rows), "page int, total long, ids array<string>, empty boolean")
    fine = page((1, 3, ["a", "b"], False), (2, 3, ["c"], False))
    assert postings.list_problems(fine, again("a", "b")).first().reasons == []
    assert postings.list_problems(fine).first().reasons == ["incomplete_list"]  # page one was not read again
    assert postings.list_problems(page((1, 3, ["a"], False), (2, 4, ["b"], False), (3, 4, [], True)), again("a")).first().reasons == ["dynamic_total", "unique_deficit"]
    assert postings.list_problems(page((1, 2, ["a", "b"], False), (2, 2, ["c", "d"], False)), again("a", "b")).first().reasons == ["incomplete_list"]


def test_json_files(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"job_id": "1", "title": "甲"}, {"job_id": "2"}]), encoding="utf-8")
    assert files.read_json_array(spark, str(tmp_path / "a.json")).where("title IS NULL").count() == 1
    out = str(tmp_path / "lines")
    files.write_jsonl(spark.createDataFrame([("a\u2028b", None)], "x string, y string"), out)
    assert "".join(p.read_text() for p in sorted((tmp_path / "lines").glob("part-*"))) == '{"x":"a\\u2028b","y":null}\n'
    assert files.read_jsonl(spark, out, "x string, y string").first().x == "a\u2028b"


def test_bad_elements(spark, tmp_path):
    (tmp_path / "bad.json").write_text('[{"a": 1}, 5, {"b": 2}, "x", null, [1]]', encoding="utf-8")
    (tmp_path / "object.json").write_text('{"a": 1}', encoding="utf-8")
    (tmp_path / "fine.json").write_text('[{"a": 1}, {}]', encoding="utf-8")
    at = lambda name: str(tmp_path / name)
    assert sorted(r.row_number for r in files.bad_elements(spark, at("bad.json")).collect()) == [2, 4, 5, 6]
    files.check_json_array(spark, at("fine.json"))
    with pytest.raises(ValueError, match="row 2"):
        files.check_json_array(spark, at("bad.json"))
    with pytest.raises(ValueError, match="not an array"):
        files.check_json_array(spark, at("object.json"))


def test_day_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    files.write_day(spark.createDataFrame([("d1", "p", 1), ("d1", "q", 2)], "snapshot_date string, platform string, v int"), path)
    files.write_day(spark.createDataFrame([("d1", "q", 3)], "snapshot_date string, platform string, v int"), path)
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [1, 3]
    with pytest.raises(ValueError):
        files.write_day(spark.createDataFrame([], "snapshot_date string, platform string, v int"), path)


def test_config(spark, tmp_path):
    pytest.importorskip("yaml")
    (tmp_path / "c.yaml").write_text("platforms:\n  a: {enabled: true}\n  b: {enabled: true, companies: [{name: x}]}\n  c: {enabled: false}\n")
    scope = files.scope_rows(spark, files.read_config(str(tmp_path / "c.yaml")))
    assert sorted((r.platform, r.companies) for r in scope.collect()) == [("a", None), ("b", ["x"])]
    (tmp_path / "d.yaml").write_text("a: 1\na: 2\n")
    with pytest.raises(ValueError):
        files.read_config(str(tmp_path / "d.yaml"))
    files.write_text(str(tmp_path / "r.md"), "x", bom=True)
    assert (tmp_path / "r.md").read_bytes() == b"\xef\xbb\xbfx"


@pytest.mark.parametrize(
    "text, want",
    [
        ("要求3-5年工作经验", [("year_range", 3, 5)]),
        ("至少三年以上测试经验，5年开发经验", [("min_years", 3, None), ("exact_years", 5, 5)]),
        ("经验不限，应届毕业生优先", [("no_requirement", None, None), ("fresh_graduate", 0, 1)]),
        ("负责3年的项目", []),
        ("3年内完成", []),
    ],
)
def test_years(text, want):
    assert [(x["pattern_name"], x["min_years"], x["max_years"]) for x in evidence.years_in(text)] == want


def test_sentences():
    text = "1. 本科及以上；\n2) 熟悉Node.js 3. 其他。"
    found = evidence.sentences_of(text)
    assert [x["sentence"] for x in found] == ["本科及以上；", "熟悉Node.", "js", "其他。"]
    assert all(text[x["start"] : x["end"]] == x["sentence"] for x in found)


def test_degrees(spark):
    assert evidence.degree_in("本科及以上学历，硕士优先")["reason"] == "hard_degree_requirement_found;degree_preferred_found"
    assert evidence.degree_in("硕士或博士优先") == {"degree": "preferred_only", "reason": "degree_preferred_only_no_hard_requirement", "start": 0, "end": 7, "preferred": "硕士或博士"}
    assert evidence.degree_in("其他") is None
    both = evidence.education_in("计算机相关专业，本科及以上学历，人工智能专业优先")
    assert (both["pattern_name"], both["suggested_value"], both["barrier"], both["preferred"], both["confidence"]) == ("bachelor_plus;major_required", "bachelor_plus;计算机相关专业", "bachelor_plus;计算机相关专业", "人工智能专业", "medium")
    assert evidence.education_in("专业不限，学历不限")["barrier"] == "no_requirement"
    assert evidence.education_in("具备专业能力") is None
    unknown = evidence.unknown_patterns(spark.createDataFrame([("p", "1", "", "", "熟悉相关经验；统计学位", "")], "platform string, job_id string, education string, experience string, requirements string, description string"))
    assert sorted((r.field, r.reason) for r in unknown.collect()) == [("education", "contains_degree_keyword_but_no_hard_requirement"), ("experience", "contains_experience_keyword_but_no_year")]
    jobs = spark.createDataFrame([("p", "1", "", "", "本科及以上；3年以上测试经验", ""), ("p", "2", "本科", "3年", "本科及以上", None)], "platform string, job_id string, education string, experience string, requirements string, description string")
    assert [r.pattern_name for r in evidence.education_evidence(jobs).collect()] == ["bachelor_plus"]
    r = evidence.experience_evidence(jobs).first()
    assert (r.job_id, r.min_years, "本科及以上；3年以上测试经验"[r.evidence_start : r.evidence_end]) == ("1", 3, "3年以上")


def test_quality(spark):
    rows = [(1, "p", "A  b", "x"), (2, "p", "a B", "y"), (3, "q", " ", "z"), (4, "q", "c", "z"), (5, "r", "A b", None)]
    df = spark.createDataFrame(rows, "row_number int, platform string, title string, company string")
    groups = quality.duplicate_groups(df, ["title"], "row_number")
    assert [(r.title, r.n, r.extra, r.first_row) for r in groups.collect()] == [("a b", 3, 2, 1)]
    members = df.select("platform", F.lower(F.regexp_replace("title", " +", " ")).alias("title"))
    assert quality.covering_groups(groups, members, ["title"], 2).count() == 1
    urls = spark.createDataFrame([("HTTP://a.b/c",), ("ftp://a",), ("http://",), (None,), ("x",)], "u string")
    assert [r.v for r in urls.select(quality.valid_http_url(F.col("u")).alias("v")).collect()] == [True, False, False, False, False]


def test_quality_report(spark):
    fields = ("job_id", "platform", "title", "company", "department", "location", "experience", "education", "salary", "description", "requirements", "url", "scraped_at")
    row = dict.fromkeys(fields, "x") | {"job_id": "1", "platform": "p", "url": "https://a/", "education": "本科", "experience": "3年", "scraped_at": "2024-01-01 10:00:00", "description": "d" * 60}
    rows = [(1, *row.values()), (2, *(row | {"job_id": "2", "url": "", "education": "?"}).values())]
    jobs = spark.createDataFrame(rows, "row_number int, " + ", ".join(f"{f} string" for f in fields))
    manifest = spark.createDataFrame([("p", 3, 3, 0, True, "odd")], "platform string, jobs_in_scope long, details_fetched long, detail_failed long, complete boolean, stopped_by string")
    got = {r.issue: r.n for r in quality.quality_report(jobs, manifest, 3).collect()}
    assert got == {"missing_required": 1, "missing_optional": 0, "duplicate_ids": 0, "suspected_duplicates": 1, "short_text": 0, "empty_text": 0, "invalid_url": 1, "unparseable_education": 1, "unparseable_experience": 0, "unparseable_scraped_at": 0, "count_mismatch": 1, "platform_mismatch": 1, "incomplete_platforms": 0, "abnormal_stops": 1}


def test_scoring(spark):
    side = "struct<in_scope: boolean, market_relevance: string, role_family: string, ai_relation: string, secondary_role_families: array<string>>"
    rows = [
        ((True, "core", "a", "x", ["b"]), (True, "core", "a", "x", ["b"])),
        ((True, "core", "a", "x", ["b"]), (True, "core", "c", "x", ["b", "d"])),
        ((False, None, None, None, []), (True, "core", "a", "x", [])),
    ]
    got = scoring.score_cases(spark.createDataFrame(rows, f"expected {side}, predicted {side}")).collect()
    assert [(r.failure_codes, r.primary_failure, r.exact_match) for r in got] == [([], None, True), (["PRIMARY_ROLE_WRONG", "SECONDARY_ROLE_EXTRA", "MULTI_FIELD_WRONG"], "PRIMARY_ROLE_WRONG", False), (["SCOPE_FP"], "SCOPE_FP", False)]


def test_audit_bundle(spark):
    rows = [("p", str(i), True, "fresh", "X", True, ["NEW"] if i % 2 else [], False) for i in range(6)]
    df = spark.createDataFrame(rows, "platform string, job_id string, classified boolean, classification_status string, career_pool string, content_reliable boolean, event_types array<string>, near_miss boolean")
    got = report.audit_sample(report.audit_categories(df), per_category=2, at_most=3)
    assert {r.job_id: r.categories for r in got.collect()} == {"0": ["RULE_BOUNDARY"], "1": ["NEW_OR_UPDATED_MARKET", "RULE_BOUNDARY"], "3": ["NEW_OR_UPDATED_MARKET"]}


def test_notifications(spark):
    table = spark.createDataFrame([("2024-01-01", "daily", "pending", 1)], "run_date string, kind string, state string, attempts int")
    new = spark.createDataFrame([("2024-01-01", "daily"), ("2024-01-02", "daily")], "run_date string, kind string")
    got = {r.run_date: (r.state, r.attempts) for r in ops.queue(table, new).collect()}
    assert got == {"2024-01-01": ("superseded", 1), "2024-01-02": ("pending", 0)}


def test_run_health(spark):
    runs = spark.createDataFrame([("SUCCESS", "DEGRADED", "SUCCESS", "SUCCESS"), ("SUCCESS", "SUCCESS", "FAILED", "SUCCESS")], "status string, crawl string, clean string, analysis string")
    assert [r.x for r in runs.select(ops.technical_health(runs).alias("x")).collect()] == ["SUCCESS", "FAILED"]
    ok = spark.createDataFrame([("partial", False)], "s string, c boolean")
    assert ok.select(ops.completeness(F.col("s"), F.col("c")).alias("x")).first().x == "PARTIAL"
    with pytest.raises(Exception, match="MISMATCH"):
        spark.createDataFrame([("partial", True)], "s string, c boolean").select(ops.completeness(F.col("s"), F.col("c"))).collect()


def test_features(spark):
    got = spark.createDataFrame([(0.0,), (0.5,), (2.0,), (3.0,), (8.0,), (None,)], "y double").select(features.years_bucket(F.col("y")).alias("b")).collect()
    assert [r.b for r in got] == ["none", "0_1", "1_3", "3_5", "8_plus", "unknown"]
    parts = F.array(*[F.lit(x) for x in ("要求测试经验", "有AI经验优先")])
    r = spark.range(1).select(features.hard_and_preferred(parts).alias("x"), features.joined(F.array(F.lit("a"), F.lit("b"), F.lit("a"))).alias("j")).first()
    assert (r.x.hard, r.x.preferred, r.j) == (["要求测试经验"], ["有AI经验优先"], "a;b")
    rows = spark.createDataFrame([("1", "ok"), ("1", "conflict"), ("1", "partial"), ("2", "unknown"), ("2", "not_required")], "id string, status string")
    assert {x.id: x.status for x in features.worst_status(rows, ["id"]).collect()} == {"1": "conflict", "2": "not_required"}
    pools, why = features.summary(spark.createDataFrame([("candidate", ["a"]), ("rejected", ["b", "a"]), ("rejected", ["b"])], "pool string, reasons array<string>"))
    assert {x.pool: x.n for x in pools.collect()} == {"candidate": 1, "rejected": 2} and [tuple(x) for x in why.collect()] == [("a", 2), ("b", 2)]


def test_streams(spark, tmp_path):
    rows = spark.createDataFrame([("p", "1", "2024-01-01", "a"), ("p", "1", "2024-01-02", "b"), ("p", "2", "2024-01-01", None)], "platform string, job_id string, snapshot_date string, sha string")
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    q = observations.content_changes(stream, F.col("sha")).writeStream.format("memory").queryName("changes").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).start()
    q.processAllAvailable()
    q.stop()
    assert sorted(map(tuple, spark.table("changes").collect())) == [("p", "1", "FIRST_SEEN"), ("p", "1", "UPDATED"), ("p", "2", "FIRST_SEEN")]


def test_postings_outside_windows_need_no_shuffle_by_platform(spark, monkeypatch):
    rows = [(i, "ab"[i % 2], i) for i in range(40)] + [(99, None, 5), (98, "c", 5), (97, "a", None)]
    jobs = spark.createDataFrame(rows, "id int, platform string, scraped_at int")
    windows = spark.createDataFrame([("a", 2, 10), ("a", 20, 30), ("b", 0, 39), (None, 0, 50)], "platform string, started_at int, finished_at int")
    want = sorted(i for i, p, at in rows if not any(p is not None and p == w[0] and at is not None and w[1] <= at <= w[2] for w in windows.collect()))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        few = ops.outside_windows(jobs, windows)
        assert sorted(r.id for r in few.collect()) == want
        assert "hashpartitioning" not in few._jdf.queryExecution().executedPlan().toString()
        monkeypatch.setattr(ops, "MAX_WINDOWS", 2)
        assert sorted(r.id for r in ops.outside_windows(jobs, windows).collect()) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_evidence_goes_through_repeated_texts_once(spark):
    """Texts with evidence, without any, and with the words apart give what going through each sentence gives; Python sees one text of many equal ones."""
    texts = ["1. 要求3年以上测试经验；熟悉软件", "需要有5年相关经验。应届毕业生", "本科及以上学历，计算机相关专业；硕士优先", "计算机专 业优先", "PHD Preferred", "沟通良好", "", None] * 3
    jobs = spark.createDataFrame([("p", str(i), "", None, x, texts[-i]) for i, x in enumerate(texts)], "platform string, job_id string, experience string, education string, requirements string, description string")
    section = lambda r: [(k, r[k] or "") for k in ("requirements", "description")]
    each = [(r.job_id, k, x) for r in jobs.collect() for k, t in section(r) for x in evidence.sentences_of(t)]
    years = sorted((j, k, h["pattern_name"], h["start"] + x["start"]) for j, k, x in each for h in evidence.years_in(x["sentence"]))
    degrees = sorted((j, k, h["barrier"], h["preferred"], h["end"] + x["start"]) for j, k, x in each if (h := evidence.education_in(x["sentence"])))
    assert sorted((r.job_id, r.source_section, r.pattern_name, r.evidence_start) for r in evidence.experience_evidence(jobs).collect()) == years and len(years) > 10
    assert sorted((r.job_id, r.source_section, r.barrier, r.preferred, r.evidence_end) for r in evidence.education_evidence(jobs).collect()) == degrees and len(degrees) > 10
    count = spark.sparkContext.accumulator(0)
    once = evidence._evidence(lambda x: count.add(1) or evidence.years_in(x), evidence.YEAR_HIT.elementType)
    evidence.evidence_rows(jobs.coalesce(1), once, evidence.EXPERIENCE_NEEDS).collect()
    assert count.value <= 6


def test_evidence_sentences_are_cut_by_their_places(spark):
    """Sentences come from the text by their places, those after characters beyond 16 bits too; words without case are looked for in the text as it is."""
    texts = ["𠮷😀 简介。\n（1） 3年以上测试经验 ；熟悉", "- 至少五年　研发经验。2. 经验不限", "\t应届毕业生\r\n", "PHD Preferred；硕士优先"]
    jobs = spark.createDataFrame([("p", str(i), "", "", x, "") for i, x in enumerate(texts)], "platform string, job_id string, experience string, education string, requirements string, description string")
    want = lambda find: sorted((str(i), x["sentence"]) for i, t in enumerate(texts) for x in evidence.sentences_of(t) for _ in find(x["sentence"]))
    years = evidence.experience_evidence(jobs)
    assert sorted((r.job_id, r.sentence) for r in years.collect()) == want(evidence.years_in) and years.count() == 4
    degrees = evidence.education_evidence(jobs)
    assert sorted((r.job_id, r.sentence) for r in degrees.collect()) == want(lambda x: [y for y in [evidence.education_in(x)] if y]) and degrees.count() == 2
    plan = years._jdf.queryExecution().optimizedPlan().toString()
    assert "lower(" not in plan and "lambda" not in plan
