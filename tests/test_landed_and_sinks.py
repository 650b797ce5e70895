import csv
import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from postlens.operators import clean
from postlens.sources import landed, postings, sinks


@pytest.fixture()
def root(tmp_path):
    for platform in ("baidu", "netease"):
        for day in ("2024-01-01", "2024-01-02"):
            for page in (1, 2):
                items = [{"postId": f"{page}{i}", "id": f"{page}{i}", "name": "测试", "workPlace": "深圳市"} for i in range(3)]
                landed.land(str(tmp_path), platform, day, page, json.dumps({"data": {"total": 6, "list": items}}, ensure_ascii=False))
    landed.land(str(tmp_path), "feishu", "2024-01-02", 1, "{}", company="某司", region="sz")
    (tmp_path / "platform=baidu" / "date=2024-01-01" / "notes.txt").write_text("x")
    (tmp_path / "README").write_text("x")
    return str(tmp_path)


pages = landed.read_landed


def test_read_of_landed_files(spark, root):
    rows = pages(spark, root)
    assert rows.count() == 9
    one = rows.where("platform = 'feishu'").first()
    assert (one.company, one.region, one.page, one.payload, one.snapshot_date) == ("某司", "sz", 1, "{}", dt.date(2024, 1, 2)) and one.scraped_at.startswith("20")
    listed = postings.read_platform(rows.where("platform = 'baidu' AND snapshot_date = DATE'2024-01-01'"), "baidu", {"name": "百度"})
    assert sorted(r.job_id for r in listed.collect()) == ["10", "11", "12", "20", "21", "22"]
    assert pages(spark, root, taskBytes="1").rdd.getNumPartitions() == 9
    with pytest.raises(Exception, match="FileNotFound|none"):
        pages(spark, root + "/none").count()


@pytest.mark.parametrize(
    "where, files",
    [
        ("platform = 'baidu' AND snapshot_date = DATE'2024-01-01'", ["platform=baidu/date=2024-01-01/page=1.json", "platform=baidu/date=2024-01-01/page=2.json"]),
        ("platform IN ('feishu', 'netease') AND snapshot_date > DATE'2024-01-01' AND page <= 1", ["platform=feishu/date=2024-01-02/company=某司,region=sz,page=1.json", "platform=netease/date=2024-01-02/page=1.json"]),
        ("company = '某司'", ["platform=feishu/date=2024-01-02/company=某司,region=sz,page=1.json"]),
        ("platform = 'none'", []),
    ],
)
def test_a_filtered_read_opens_only_matching_files(spark, root, where, files):
    """All other files are made unreadable as text files: folders in their place would fail if opened."""
    for f in landed.listed(root):
        if os.path.relpath(f.path, root) not in files:
            os.remove(f.path)
            os.mkdir(f.path)
    assert pages(spark, root).where(where).count() == len(files)
    with pytest.raises(Exception, match="Is a directory"):
        pages(spark, root).count()


def test_names_of_landed_files(tmp_path):
    with pytest.raises(ValueError):
        landed.land(str(tmp_path), "p", "2024-01-01", 1, "{}", company="a,b")


# sinks


def rows(spark, n=40, parts=4):
    return spark.range(n, numPartitions=parts).select("id", F.concat(F.lit("p"), F.col("id") % 3).alias("platform"), F.when(F.col("id") % 5 != 0, F.concat(F.lit("a|b\n\"c\",é"), F.col("id"))).alias("text"), F.array(F.lit("x"), F.lit("x"), F.lit("y")).alias("codes"), (F.col("id") % 2 == 0).alias("even"))


def test_one_csv_with_mark(spark, tmp_path):
    path = str(tmp_path / "r.csv")
    sinks.write_report(rows(spark), path, order=["id"], bom=True)
    raw = open(path, "rb").read()
    assert raw.startswith(b"\xef\xbb\xbfid,platform,text,codes,even\n") and raw.count(b"\xef\xbb\xbf") == 1
    got = list(csv.reader(open(path, encoding="utf-8-sig", newline="")))
    assert [r[0] for r in got[1:]] == [str(i) for i in range(40)] and got[2] == ["1", "p1", 'a|b\n"c",é1', "x;y", "false"] and got[1][2] == ""
    sinks.write_report(rows(spark, 0), path)
    assert open(path, "rb").read() == b"id,platform,text,codes,even\n" and os.listdir(tmp_path) == ["r.csv"]


def test_one_markdown_by_sections(spark, tmp_path):
    path = str(tmp_path / "r.md")
    sinks.write_report(rows(spark, 6), path, order=["id"], title="Report", section="platform", note="all rows")
    text = open(path, encoding="utf-8").read()
    assert text.startswith("# Report\n\nall rows\n\n## p0\n\n| id | text | codes | even |\n| --- | --- | --- | --- |\n| 0 |  | x;y | true |\n| 3 | a\\|b<br>\"c\",é3 |")
    assert [x for x in text.split("\n") if x.startswith("## ")] == ["## p0", "## p1", "## p2"]
    plain = str(tmp_path / "s.md")
    sinks.write_report(rows(spark, 2), plain, order=["id"], title="T")
    assert open(plain, encoding="utf-8").read().startswith("# T\n\n| id | platform |")


def test_a_failed_task_leaves_what_was_there(spark, tmp_path):
    path = str(tmp_path / "r.csv")
    sinks.write_report(rows(spark, 3), path, order=["id"])
    before = open(path, "rb").read()
    bad = rows(spark).withColumn("text", F.when(F.col("id") == 33, F.raise_error(F.lit("torn")).cast("string")).otherwise(F.col("text")))
    with pytest.raises(Exception, match="torn"):
        sinks.write_report(bad, path)
    assert open(path, "rb").read() == before and os.listdir(tmp_path) == ["r.csv"]
    spark.dataSource.register(sinks.ReportCsv)
    with pytest.raises(Exception, match="FileExists"):
        rows(spark, 1).write.format("report_csv").option("path", path).mode("append").save()
    assert os.listdir(tmp_path) == ["r.csv"]


def test_reports_of_the_library(spark, tmp_path):
    jobs = spark.createDataFrame([("p", "co", "P1", "深圳"), ("q", "co", "X", "广东"), ("q", "d", "P1", "")], "platform string, company string, career_pool string, location string")
    sinks.write_report(clean.normalize_locations(jobs).select("platform", "location", "city_norm"), str(tmp_path / "cities.csv"), order=["platform", "location"], bom=True)
    assert open(tmp_path / "cities.csv", encoding="utf-8-sig").read().splitlines()[:2] == ["platform,location,city_norm", "p,深圳,深圳"]
