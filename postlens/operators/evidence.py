"""Education and experience stated in free text, with places.

Sentences and the evidence in them are found in Arrow batches, as Spark has no
regular expressions that tell offsets; the outcome is rows again (explode, join,
group) from there on.
"""

from __future__ import annotations

import re

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from ..functions.text import is_missing

LONGEST = 180
# Fixed values.
NUMBERS = {"一": 1, "二": 2, "两": 2, "三": 3, "四": 4, "五": 5, "六": 6, "七": 7, "八": 8, "九": 9, "十": 10}
NUMBER = r"(?:\d+|[一二两三四五六七八九十])"
BULLET = re.compile(r"^\s*(?:[-*•]|[0-9]+[.)、]|（[0-9]+）|\([0-9]+\))\s*")
ITEM = re.compile(r"(?:(?<=\s)|(?<=[。；;\n\r]))(?:[-*•]|[0-9]+[.)、]|（[0-9]+）|\([0-9]+\))\s+")
LINE = re.compile(r"[；;\n\r]+")
VETO = re.compile(r"(?:负责|管理|支持|完成|近|每周|项目|团队|案例|模块|QPS|个月|月|天|人团队|个项目)", re.I)
AROUND_YEARS = re.compile(r"(经验|经历|工作|相关|研发|开发|产品|运营|测试|管理)")
DEGREES = (
    ("no_requirement", "degree_no_requirement_found", r"(?:学历不限|不限学历)"),
    ("college_plus", "hard_degree_requirement_found", r"(?:大专|专科)\s*(?:及以上|以上|或以上)(?:学历|学位)?"),
    ("bachelor_plus", "hard_degree_requirement_found", r"(?:大学)?本科\s*(?:及以上|以上|或以上)(?:学历|学位)?"),
    ("bachelor_plus", "hard_degree_requirement_found", r"(?:全日制|统招)\s*本科(?:\s*(?:及以上|以上|或以上))?(?:学历|学位)?"),
    ("master_plus", "hard_degree_requirement_found", r"(?:硕士|研究生)\s*(?:及以上|以上|或以上)(?:学历|学位)?"),
    ("phd", "hard_degree_requirement_found", r"(?:博士(?:学历|学位)?|doctorate|phd)"),
)
PREFERRED_TAIL = re.compile(r"\s*(?:学历|学位|毕业)?\s*(?:优先|preferred)", re.I)
PREFERRED_DEGREE = (
    r"(?P<phrase>硕士\s*(?:或|/|、)\s*博士|硕士|研究生|博士|doctorate|phd)\s*(?:学历|学位|毕业)?\s*(?:优先|preferred)",
    r"(?:优先考虑|preferred)\s*(?P<phrase>硕士\s*(?:或|/|、)\s*博士|硕士|研究生|博士|doctorate|phd)",
)
NO_MAJOR = re.compile(r"(?:专业不限|不限专业)")
NOT_A_MAJOR = re.compile(r"(专业能力|专业知识|专业技能|专业判断|专业服务|专业团队|专业工具|专业经验|专业精神|专业素养)")
MAJOR_NAME = re.compile(r"(计算机|软件|人工智能|智能|信息技术|通信|电气|自动化|数学|统计|计算语言学|语言学|汉语言文学|翻译|小语种|理工科|电子信息|金融|经济|数据科学|机器学习|自然语言处理|工程|AI)", re.I)
MAJOR_WORD = re.compile(r"专业|专业背景|学科背景|教育背景")
MAJOR_REQUIRED = (
    re.compile(r"(?P<phrase>[^，,。；;\n]{1,90}?(?:等)?相关专业)(?=(?:本科|硕士|博士|大专|专科|学历|学位))"),
    re.compile(r"(?P<phrase>[^，,。；;\n]{1,90}?(?:等)?(?:相关专业|专业背景|学科背景|教育背景|类专业|专业))"),
)
MAJOR_LEAD = re.compile(r"^(?:要求|任职要求|具备|拥有|具有|有|需|需要|本科及以上学历|本科及以上|硕士及以上学历|学历不限|不限学历)\s*")
MAJOR_LABEL = re.compile(r"^(?:相关)?专业(?:要求)?[:：]\s*")
SHORTER = (("等相关专业", "相关专业"), ("或相关专业", "相关专业"), ("及相关专业", "相关专业"), ("相关专业背景", "相关专业"), ("专业背景", "专业"))
EDGES = " ，,、；;。:："
EDUCATION_WORDS = ("学历", "本科", "硕士", "博士", "doctorate", "phd", "大专", "专科", "研究生", "专业背景", "专业", "学科背景", "教育背景", "学位")
MAJOR_WORDS = ("专业背景", "专业", "学科背景", "教育背景")
DEGREE_WORDS = r"(?i)(学历|本科|硕士|博士|doctorate|phd|大专|专科|研究生|学位)"
EXPERIENCE_WORDS = ("经验", "经历", "工作经验", "工作经历", "相关经验", "相关经历", "年以上", "年及以上", "年限", "背景")
YEARS = {
    "year_range": re.compile(rf"(?P<min>{NUMBER})\s*(?:-|~|到|至)\s*(?P<max>{NUMBER})\s*年"),
    "min_years": re.compile(rf"(?:(?:至少|不少于)\s*)?(?P<years>{NUMBER})\s*年\s*(?:及以上|以上)|(?:(?:至少|不少于)\s*)(?P<prefix_years>{NUMBER})\s*年"),
    "exact_years": re.compile(rf"(?P<years>{NUMBER})\s*年(?!\s*(?:内|间|前|后|来|度|月))"),
}
NO_YEARS = (("no_requirement", re.compile(r"(?:经验不限|不限经验)")), ("fresh_graduate", re.compile(r"应届毕业生")))
RANK = {"no_requirement": 0, "fresh_graduate": 0, "year_range": 1, "min_years": 2, "exact_years": 3}

def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


_TEXT, _INT = T.StringType(), T.IntegerType()
SPAN = T.ArrayType(_struct(sentence=_TEXT, start=_INT, end=_INT))
YEAR_HIT = T.ArrayType(_struct(pattern_name=_TEXT, suggested_value=_TEXT, min_years=_INT, max_years=_INT, bucket=_TEXT, confidence=_TEXT, start=_INT, end=_INT, reason=_TEXT))
EDUCATION_HIT = _struct(pattern_name=_TEXT, suggested_value=_TEXT, barrier=_TEXT, preferred=_TEXT, confidence=_TEXT, start=_INT, end=_INT, reason=_TEXT)


def _sentence_end(text: str, i: int) -> bool:
    """A full stop that isn't the end of a number before a blank."""
    after = text[i + 1 : i + 2]
    return text[i] == "." and not (text[i - 1 : i].isdigit() and (not after or after.isspace()))


def sentences_of(text: str, longest: int = LONGEST) -> list[dict]:
    """Sentences without their bullets, with their places in the text."""
    cuts = {0, len(text)} | {i + 1 for i, ch in enumerate(text) if ch in "。；;\n\r" or _sentence_end(text, i)} | {m.start() for m in ITEM.finditer(text)}
    edges, spans = sorted(cuts), []
    for a, b in zip(edges, edges[1:]):
        if len(text[a:b].strip()) > longest:  # once more at line ends and semicolons, which go
            marks = [m.span() for m in LINE.finditer(text, a, b)]
            pieces = [(x, y) for x, y in zip([a, *[e for _, e in marks]], [*[s for s, _ in marks], b]) if x < y]
            spans += pieces or [(a, b)]
        else:
            spans.append((a, b))
    out = []
    for a, b in spans:
        raw = text[a:b]
        start, end = a + len(raw) - len(raw.lstrip()), a + len(raw.rstrip())
        body = raw.strip()
        if bullet := BULLET.match(body):
            rest = body[bullet.end() :]
            start += bullet.end() + len(rest) - len(rest.lstrip())
            body = rest.strip()
        if body:
            out.append({"sentence": body, "start": start, "end": end})
    return out


def _number(x: str) -> int:
    return int(x) if x.isdigit() else NUMBERS[x]


def years_in(sentence: str) -> list[dict]:
    """Stated years of experience; of overlapping ones the first, at one place the stronger."""
    hit = lambda kind, value, low, high, bucket, sure, m, why: {"pattern_name": kind, "suggested_value": value, "min_years": low, "max_years": high, "bucket": bucket, "confidence": sure, "start": m.start(), "end": m.end(), "reason": why}
    found = []
    for kind, pattern in NO_YEARS:
        low, high = (0, 1) if kind == "fresh_graduate" else (None, None)
        found += [hit(kind, kind, low, high, kind, "high", m, "explicit_experience_requirement_found") for m in pattern.finditer(sentence)]
    for kind, pattern in YEARS.items():
        for m in pattern.finditer(sentence):
            if VETO.search(sentence[max(0, m.start() - 8) : m.end() + 10]):
                continue
            low = _number(m["min"] if kind == "year_range" else m["years"] or m["prefix_years"])
            if kind == "year_range":
                found.append(hit(kind, f"{low}-{_number(m['max'])}年", low, _number(m["max"]), "range", "high", m, "year_range_found"))
            elif kind == "min_years":
                found.append(hit(kind, f"{low}年以上", low, None, kind, "high", m, "minimum_year_requirement_found"))
            elif not (re.search(r"(?:-|~|到|至)\s*$", sentence[max(0, m.start() - 4) : m.start()]) or re.match(r"\s*(?:及以上|以上)", sentence[m.end() : m.end() + 4])):
                if AROUND_YEARS.search(sentence[max(0, m.start() - 12) : m.end() + 18]):
                    found.append(hit(kind, f"{low}年", low, low, kind, "medium", m, "exact_year_requirement_found"))
    kept, free_from = [], 0
    for x in sorted(found, key=lambda x: (x["start"], RANK[x["pattern_name"]])):
        if x["start"] >= free_from:
            kept.append(x)
            free_from = x["end"]
    return kept


def degree_in(sentence: str) -> dict | None:
    """The required degree (if it isn't only preferred) and the preferred one."""
    hard = None
    for name, why, pattern in DEGREES:
        m = re.search(pattern, sentence, re.I)
        if m and not PREFERRED_TAIL.match(sentence[m.end() : m.end() + 8]):
            hard = (name, why, m.start(), m.end())
            break
    soft = next((m for p in PREFERRED_DEGREE if (m := re.search(p, sentence, re.I))), None)
    if not hard and not soft:
        return None
    wish = re.sub(r"\s+", "", soft["phrase"]) if soft else ""
    wish = re.sub(r"doctorate|phd", "博士", wish, flags=re.I).replace("/", "或").replace("、", "或")
    ends = ([hard[2:]] if hard else []) + ([(soft.start("phrase"), soft.end())] if soft else [])
    reasons = ([hard[1]] if hard else []) + ([("degree_preferred_found" if hard else "degree_preferred_only_no_hard_requirement")] if soft else [])
    return {"degree": hard[0] if hard else "preferred_only", "reason": ";".join(reasons), "start": min(a for a, _ in ends), "end": max(b for _, b in ends), "preferred": wish}


def _major(phrase: str, at: int) -> tuple[str, int, int] | None:
    """The major a phrase names, in short, with the phrase's place."""
    bare = phrase.strip(EDGES)
    name = re.sub(r"者$", "", MAJOR_LABEL.sub("", MAJOR_LEAD.sub("", bare)).strip(EDGES))
    for long, short in SHORTER:
        name = name.replace(long, short)
    name = re.sub(r"\s+", "", name).strip(EDGES.rstrip(":："))
    if not name or NOT_A_MAJOR.search(name) or not MAJOR_WORD.search(name) or not MAJOR_NAME.search(name):
        return None
    start = at + phrase.find(bare)
    return name, start, start + len(bare)


def major_in(sentence: str) -> dict | None:
    """``kind`` (none, required or preferred), the required and preferred names, and the place."""
    if m := NO_MAJOR.search(sentence):
        return {"kind": "none", "required": "", "preferred": "", "start": m.start(), "end": m.end()}
    wish = None
    for m in re.finditer(r"(?:优先|preferred)", sentence, re.I):
        begin = max(sentence.rfind(x, 0, m.start()) for x in "，,；;。\n\r") + 1
        if hit := _major(sentence[begin : m.start()], begin):
            wish = (hit[0], hit[1], m.end())
            break
    must = None
    for pattern in MAJOR_REQUIRED:
        for m in pattern.finditer(sentence):
            a, b = m.span("phrase")
            apart = not wish or b <= wish[1] or wish[2] <= a
            if apart and not re.match(r"\s*(?:优先|preferred)", sentence[b : b + 4], re.I) and (must := _major(m["phrase"], a)):
                break
        if must:
            break
    found = [x for x in (must, wish) if x]
    if not found:
        return None
    return {"kind": "required" if must else "preferred", "required": must[0] if must else "", "preferred": wish[0] if wish else "", "start": min(x[1] for x in found), "end": max(x[2] for x in found)}


def education_in(sentence: str) -> dict | None:
    """What a sentence asks of degree and major, as one row."""
    d, m = degree_in(sentence), major_in(sentence)
    if not d and not m:
        return None
    hard = d["degree"] if d and d["degree"] != "preferred_only" else ""
    soft, kind = (d["preferred"] if d else ""), (m["kind"] if m else "")
    free = kind == "none"
    names = [hard] * bool(hard) + ["preferred_only"] * bool(soft) + ([{"none": "major_no_requirement", "required": "major_required", "preferred": "major_preferred_only"}[kind]] if m else [])
    major_value = {"none": "no_requirement", "required": m["required"], "preferred": m["preferred"], "": "unknown"}[kind] if m else "unknown"
    barrier = ([hard] if hard else []) + ([m["required"]] if kind == "required" else []) + (["no_requirement"] if free and hard != "no_requirement" else [])
    wishes = [x for x in (soft, m["preferred"] if m else "") if x]
    binding = bool(hard) or free or kind == "required"
    reasons = ([d["reason"].split(";")[0]] if hard else []) + ([{"none": "major_no_requirement_found", "required": "hard_major_requirement_found"}[kind]] if kind in ("none", "required") else [])
    reasons += ["degree_preferred_found" if hard else "degree_preferred_only_no_hard_requirement"] * bool(soft)
    reasons += ["major_preferred_only_found" if binding else "major_preferred_only_no_hard_requirement"] * bool(m and m["preferred"])
    return {
        "pattern_name": ";".join(names), "suggested_value": f"{hard or ('preferred_only' if soft else 'unknown')};{major_value}", "barrier": ";".join(barrier) or "unknown", "preferred": ";".join(wishes),
        "confidence": "high" if not wishes else "medium" if binding else "low", "start": min(x["start"] for x in (d, m) if x), "end": max(x["end"] for x in (d, m) if x), "reason": ";".join(dict.fromkeys(reasons)),
    }


@F.pandas_udf(SPAN)
def sentences(texts: pd.Series) -> pd.Series:
    return texts.fillna("").map(sentences_of)


@F.pandas_udf(YEAR_HIT)
def experience_hits(texts: pd.Series) -> pd.Series:
    return texts.fillna("").map(years_in)


@F.pandas_udf(EDUCATION_HIT)
def education_hits(texts: pd.Series) -> pd.DataFrame:
    names = EDUCATION_HIT.names
    rows = [education_in(x) or dict.fromkeys(names) for x in texts.fillna("")]
    return pd.DataFrame(rows, columns=names).astype({"start": "Int32", "end": "Int32"})


SENTENCE = _struct(sentence=_TEXT, sentence_start=_INT, sentence_end=_INT)


class Sentences:
    """``sentences(text [, longest])``: a table function for LATERAL joins, a row a sentence with its place in the text."""

    @staticmethod
    def analyze(text: AnalyzeArgument, longest: AnalyzeArgument | None = None) -> AnalyzeResult:
        if text.dataType not in (T.StringType(), T.NullType()):
            raise ValueError("sentences(text): a string is needed")
        if longest is not None and (not longest.isConstantExpression or not isinstance(longest.value, int) or longest.value < 1):
            raise ValueError("sentences(text, longest): a positive number is needed, the same for all rows")
        return AnalyzeResult(SENTENCE)

    def eval(self, text: str | None, longest: int = LONGEST):
        for x in sentences_of(text or "", longest):
            yield x["sentence"], x["start"], x["end"]


def register_sentences(spark: SparkSession) -> None:
    """Make ``sentences`` known to the session's SQL."""
    spark.udtf.register("sentences", F.udtf(Sentences, useArrow=True))


def sentence_table(jobs: DataFrame, section: str) -> DataFrame:
    """``jobs`` with a row for each sentence of one section: ``source_section, sentence, sentence_start, sentence_end``; by the table function."""
    register_sentences(jobs.sparkSession)
    return jobs.sparkSession.sql(f"SELECT j.*, '{section}' AS source_section, s.* FROM {{jobs}} j, LATERAL sentences(CASE WHEN trim(j.`{section}`) <> '' THEN j.`{section}` END) s", jobs=jobs)


def sentence_rows(jobs: DataFrame, sections: tuple[str, ...] = ("requirements", "description")) -> DataFrame:
    """A row for each sentence of the sections, in their order; blank sections have none."""
    each = F.array(*[F.struct(F.lit(s).alias("section"), F.when(is_missing(F.col(s)), "").otherwise(F.col(s)).alias("text")) for s in sections])
    rows = jobs.withColumn("_s", F.explode(each)).withColumn("_x", F.explode(sentences(F.col("_s.text"))))
    return rows.withColumns({"source_section": F.col("_s.section"), "sentence": F.col("_x.sentence"), "sentence_start": F.col("_x.start"), "sentence_end": F.col("_x.end")}).drop("_s", "_x")


_KINDS = {_TEXT: pa.string(), _INT: pa.int32()}
#: What a section must have for any year, degree or major to be found in it.
EXPERIENCE_NEEDS = ("年", "经验不限", "不限经验", "应届毕业生")
EDUCATION_NEEDS = ("学历", "大专", "专科", "本科", "硕士", "研究生", "博士", "doctorate", "phd", "专业", "学科背景", "教育背景", "优先", "preferred")


def _evidence(find, hit: T.StructType):
    """A function of texts: the evidence ``find`` gives in each one's sentences, with these by their places. Texts that a batch repeats are gone through once."""
    kind = pa.list_(pa.struct([("sentence_start", pa.int32()), ("sentence_end", pa.int32()), ("hit", pa.struct([(f.name, _KINDS[f.dataType]) for f in hit]))]))

    @F.arrow_udf(T.ArrayType(_struct(sentence_start=_INT, sentence_end=_INT, hit=hit)))
    def found(texts: pa.Array) -> pa.Array:
        coded = texts.dictionary_encode()
        each = ([{"sentence_start": x["start"], "sentence_end": x["end"], "hit": h} for x in sentences_of(t) for h in find(x["sentence"])] for t in coded.dictionary.to_pylist())
        return pa.array(each, kind).take(coded.indices)

    return found


_experience = _evidence(years_in, YEAR_HIT.elementType)
_education = _evidence(lambda x: [y] if (y := education_in(x)) else [], EDUCATION_HIT)


def evidence_rows(jobs: DataFrame, found, needs: tuple[str, ...], sections: tuple[str, ...] = ("requirements", "description")) -> DataFrame:
    """A row for each piece of evidence: ``source_section, sentence, sentence_start, _hit``; only sections with one of the words go to Python, once."""
    each = F.array(*[F.struct(F.lit(s).alias("section"), F.col(s).alias("text")) for s in sections])
    rows = jobs.withColumn("_s", F.explode(each)).where(_names(F.col("_s.text"), needs))
    rows = rows.withColumn("_x", F.explode(found(F.col("_s.text"))))
    start, end = F.col("_x.sentence_start"), F.col("_x.sentence_end")
    return rows.withColumns({"source_section": F.col("_s.section"), "sentence": F.substring(F.col("_s.text"), start + 1, end - start), "sentence_start": start, "_hit": F.col("_x.hit")}).drop("_s", "_x")


def experience_evidence(jobs: DataFrame) -> DataFrame:
    """Evidence of postings whose experience field is blank: a row a hit, places in the section."""
    rows = evidence_rows(jobs.where(is_missing(F.col("experience")) | (F.col("experience") == "<missing>")), _experience, EXPERIENCE_NEEDS)
    return rows.select("platform", "job_id", "source_section", "sentence", "_hit.pattern_name", "_hit.suggested_value", "_hit.min_years", "_hit.max_years", "_hit.bucket", "_hit.confidence", (F.col("_hit.start") + F.col("sentence_start")).alias("evidence_start"), (F.col("_hit.end") + F.col("sentence_start")).alias("evidence_end"), "_hit.reason")


def education_evidence(jobs: DataFrame) -> DataFrame:
    rows = evidence_rows(jobs.where(is_missing(F.col("education")) | (F.col("education") == "<missing>")), _education, EDUCATION_NEEDS)
    names = ("pattern_name", "suggested_value", "barrier", "preferred", "confidence", "reason")
    return rows.select("platform", "job_id", "source_section", "sentence", *[f"_hit.{k}" for k in names], (F.col("_hit.start") + F.col("sentence_start")).alias("evidence_start"), (F.col("_hit.end") + F.col("sentence_start")).alias("evidence_end"))


def _names(sentence: Column, words: tuple[str, ...]) -> Column:
    """If it has one of the words, in any case; it is lowered only for words that have one, which come last."""
    found, cased = F.lit(False), [w for w in words if w.upper() != w]
    for w in [w for w in words if w not in cased]:
        found = found | F.contains(sentence, F.lit(w))
    for w in cased:
        found = found | F.contains(F.lower(sentence), F.lit(w))
    return found


def education_unknown(sentence: Column) -> Column:
    """Why a sentence with a word of education gave no evidence; null without one."""
    asked = _names(sentence, EDUCATION_WORDS) & ~sentence.rlike(NOT_A_MAJOR.pattern)
    why = F.when(_names(sentence, MAJOR_WORDS), "contains_major_keyword_but_unsupported_pattern").when(sentence.rlike(DEGREE_WORDS), "contains_degree_keyword_but_no_hard_requirement").otherwise("unsupported_pattern")
    return F.when(asked, why)


def experience_unknown(sentence: Column) -> Column:
    """Why a sentence with a word of experience gave no evidence; null without one."""
    why = F.when(sentence.rlike(NUMBER + r"\s*年"), "contains_year_number_but_unclear_context").when(sentence.rlike("(经验|经历|工作经验|工作经历|相关经验|相关经历)"), "contains_experience_keyword_but_no_year").otherwise("unsupported_pattern")
    return F.when(_names(sentence, EXPERIENCE_WORDS), why)


def unknown_patterns(jobs: DataFrame) -> DataFrame:
    """``platform, job_id, field, source_section, sentence, reason``: sentences that speak of a missing field in no known way."""
    out = None
    for field, hits, why in (("education", education_hits, education_unknown), ("experience", experience_hits, experience_unknown)):
        rows = sentence_rows(jobs.where(is_missing(F.col(field)) | (F.col(field) == "<missing>"))).withColumn("_hit", hits(F.col("sentence")))
        none = F.col("_hit.pattern_name").isNull() if field == "education" else F.size("_hit") == 0
        found = rows.where(none).select("platform", "job_id", F.lit(field).alias("field"), "source_section", "sentence", why(F.col("sentence")).alias("reason")).where("reason IS NOT NULL")
        out = found if out is None else out.unionByName(found)
    return out


def evidence_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("platform", "pattern_name").agg(F.count("*").alias("n"))
