import hashlib
import re
import unicodedata

from pyspark.sql import functions as F

from postlens.functions import text as X
from postlens.operators import clean


def one(spark, expression, **values):
    schema = ", ".join(f"{k} string" for k in values)
    return spark.createDataFrame([tuple(values.values())], schema).select(expression.alias("x")).first().x


def test_strip_and_missing(spark):
    assert one(spark, X.strip(F.col("t")), t=" 　\x1c a b \n") == "a b"
    assert one(spark, X.is_missing(F.col("t")), t=None) is True
    assert one(spark, X.or_missing(F.col("t")), t="  ") == "<missing>"


def test_clauses(spark):
    assert one(spark, X.clauses(F.col("t")), t="b；a;; b。\r c") == ["b", "a", "b", "c"]
    assert one(spark, X.clauses(F.col("t"), ordered=False), t="b；a;b") == ["a", "b"]
    assert one(spark, X.clauses(F.col("t")), t=None) == []


def test_terms_and_tags(spark):
    assert one(spark, X.matched_terms(F.col("t"), "llm|agent", "i"), t="LLM agent llm Agent") == ["LLM", "agent"]
    assert one(spark, X.tags(F.col("t"), (("b", "x+"), ("a", "y"))), t="yx") == ["b", "a"]


def content(text):
    text = unicodedata.normalize("NFKC", text).replace("\r\n", "\n").replace("\r", "\n")
    lines = (re.sub(r"\s+", " ", x).strip() for x in text.split("\n"))
    return "\n".join(x for x in lines if x).casefold()


def test_content_hash(spark):
    rows = [("Ｔitle", " Straße\r\n\r\n  a\tb ", None), ("", "", ""), ("x　y", "\n\n", "Ω\r")]
    got = spark.createDataFrame(rows, "title string, description string, requirements string").select(X.content_sha256().alias("h")).collect()
    want = [hashlib.sha256("\n---\n".join(content(x or "") for x in r).encode()).hexdigest() for r in rows]
    assert [r.h for r in got] == want


def test_locations(spark):
    rows = [("广东/广东省",), ("",), (None,), ("深圳市、北京,foo/bar，苏州市",), ("中国香港 / 中国",), ("湖南省",)]
    got = clean.normalize_locations(spark.createDataFrame(rows, "location string")).collect()
    assert [(r.locations_norm, r.location_level, r.province_norm, r.city_norm) for r in got] == [
        (["广东省"], ["province"], ["广东省"], []),
        (["unknown"], ["unknown"], [], []),
        (["unknown"], ["unknown"], [], []),
        (["深圳", "北京", "unknown", "苏州"], ["city", "city", "unknown", "city"], [], ["深圳", "北京", "苏州"]),
        (["香港", "中国"], ["region", "country"], [], []),
        (["湖南省"], ["province"], ["湖南省"], []),
    ]
    report = clean.clean_report(clean.normalize_locations(spark.createDataFrame(rows, "location string"))).first()
    assert tuple(report) == (6, 3, 2)


def test_city_names_and_filter(spark):
    assert one(spark, clean.city_names(F.col("t"), True), t="广州市、广东省,广州市") == ["广州", "广东", "广州"]
    assert one(spark, clean.location_wanted(F.col("t"), ["深圳市"], False), t="广东深圳南山") is True
    assert one(spark, clean.location_wanted(F.col("t"), ["深圳"], True), t=" ") is True
    assert one(spark, clean.location_wanted(F.col("t"), ["深圳"], True), t="北京") is False


def test_education_values(spark):
    rows = [("doctorate", "", ""), (None, "本科及以上", "博士优先"), ("硕士", "", "")]
    df = spark.createDataFrame(rows, "education string, description string, requirements string")
    assert [r.x for r in df.select(clean.education_values(df).alias("x")).collect()] == [["博士"], ["博士", "本科及以上"], ["硕士"]]


def test_content_is_normalised_some_texts_at_a_time(spark, monkeypatch):
    import pyarrow as pa

    from postlens.functions import text as X

    texts = ["Ａ  b\r\n\r\n \tC ", None, "", "ﬁ ß\rx", "İ\n\n"] * 50
    most = []
    monkeypatch.setattr(X, "pa", type("Counted", (), {"array": staticmethod(lambda x, t: most.append(len(x)) or pa.array(x, t)), "string": pa.string, "concat_arrays": pa.concat_arrays}))
    got = X.normalize_content.func(pa.array(texts)).to_pylist()
    assert got == ["a b\nc", "", "", "fi ss\nx", "i̇"] * 50 and max(most) <= X.TEXTS_AT_ONCE
