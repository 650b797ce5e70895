"""Postings and manifests from landed payloads.

Network collection is not part of this library: a collector lands each page's
JSON as a row ``platform, page, region, company, payload`` and the readers here
make postings of them. A platform is a row of ``PLATFORMS``: where its list is
and from which paths its fields come, the first non-blank path winning.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import is_missing, strip, text_of
from ..operators.clean import location_wanted

FIELDS = ("job_id", "platform", "title", "company", "department", "location", "experience", "education", "salary", "description", "requirements", "url", "scraped_at")


@dataclass(frozen=True)
class Platform:
    """Paths into an item; a path that ends in ``[]`` or has ``[].name`` is a list, joined by a comma.

    paths: of a field's paths the first that isn't blank; parts: all of them, joined by a separator.
    """

    items: str
    total: str | None
    id: tuple[str, ...]
    paths: dict[str, tuple[str, ...]] = field(default_factory=dict)
    parts: dict[str, tuple[str, tuple[str, ...]]] = field(default_factory=dict)


# Field paths of the platforms' own payloads (fixed values).
PLATFORMS = {
    "tencent": Platform("$.Data.Posts", "$.Data.Count", ("$.PostId",), {"title": ("$.RecruitPostName",), "department": ("$.BGName",), "location": ("$.LocationName",), "experience": ("$.RequireWorkYearsName",), "description": ("$.Responsibility",)}),
    "netease": Platform("$.data.list", "$.data.total", ("$.id",), {"title": ("$.name",), "department": ("$.firstDepName",), "location": ("$.workPlaceNameList[]",), "experience": ("$.reqWorkYearsName",), "education": ("$.reqEducationName",), "description": ("$.description",), "requirements": ("$.requirement",)}),
    "aliyun": Platform("$.content.datas", "$.content.totalCount", ("$.id",), {"title": ("$.name",), "department": ("$.department", "$.departmentName"), "location": ("$.workLocations[]",), "experience": ("$.experience",), "education": ("$.degree",), "description": ("$.description",), "requirements": ("$.requirement",)}),
    "baidu": Platform("$.data.list", "$.data.total", ("$.postId", "$.jobId"), {"title": ("$.name",), "department": ("$.bgShortName", "$.orgName"), "location": ("$.workPlace",), "experience": ("$.workYears",), "education": ("$.education",), "description": ("$.workContent",), "requirements": ("$.serviceCondition",)}),
    "bytedance": Platform("$.data.job_post_list", "$.data.count", ("$.id",), {"title": ("$.title",), "location": ("$.city_info.name", "$.city_list[].name"), "description": ("$.description",), "requirements": ("$.requirement",)}, {"department": (" - ", ("$.job_category.parent.name", "$.job_category.name"))}),
    "didi": Platform("$.data.items", "$.data.total", ("$.jdNo", "$.jdId"), {"title": ("$.jobName",), "department": ("$.deptName",), "location": ("$.workArea",), "description": ("$.jobDesc",), "requirements": ("$.qualification",)}),
    "feishu": Platform("$.data.job_post_list", "$.data.count", ("$.id",), {"title": ("$.title",), "location": ("$.city_list[].name",), "description": ("$.description",), "requirements": ("$.requirement",)}),
    "jd": Platform("$", None, ("$.requirementId",), {"title": ("$.positionNameOpen", "$.positionName"), "department": ("$.positionDeptName", "$.jobType"), "location": ("$.workCity",), "description": ("$.workContent",), "requirements": ("$.qualification",)}),
    "kuaishou": Platform("$.result.list", "$.result.total", ("$.id",), {"title": ("$.name",), "department": ("$.departmentName",), "location": ("$.workLocationsCode[]", "$.workLocationCode"), "experience": ("$.workExperienceCode",), "education": ("$.educationLimitCode",), "description": ("$.description",), "requirements": ("$.positionDemand",)}),
    "liepin": Platform("$.data.data.jobCardList", None, ("$.job.jobId",), {"title": ("$.job.title",), "department": ("$.job.department",), "location": ("$.job.dq",), "experience": ("$.job.requireWorkYears",), "education": ("$.job.requireEduLevel",), "salary": ("$.job.salary",), "description": ("$.job.labels[]",)}),
    "meituan": Platform("$.data.list", "$.data.page.totalCount", ("$.jobUnionId",), {"title": ("$.name",), "department": ("$.department[].name",), "location": ("$.cityList[].name",), "experience": ("$.workYear",), "requirements": ("$.jobRequirement",)}, {"description": ("\n", ("$.jobDuty", "$.highLight"))}),
    "xiaohongshu": Platform("$.data.list", "$.data.total", ("$.positionId",), {"title": ("$.positionName",), "department": ("$.jobType",), "location": ("$.workplace",), "description": ("$.duty",), "requirements": ("$.qualification",)}),
}
PLATFORMS |= {name: PLATFORMS["aliyun"] for name in ("tongyi", "dingtalk", "quark")}
DEGREES = {"bachelor": "本科", "master": "硕士", "doctor": "博士", "phd": "博士", "college": "大专", "high_school": "高中"}
#: Platforms whose degree is a code and whose experience may be a range of years.
RANGED = ("aliyun", "tongyi", "dingtalk", "quark")
#: Cities that a province stands for where a platform filters by city (fixed values).
PROVINCE_CITIES = {"广东": ("广州", "深圳"), "浙江": ("杭州",)}


def _at(item: Column, path: str, separator: str = ", ") -> Column:
    """Text at a path: text and numbers as they are, lists joined."""
    if "[]" not in path:
        return F.try_variant_get(item, path, "string")
    base, _, rest = path.partition("[]")
    values = F.try_variant_get(item, base, "array<variant>")
    texts = F.transform(values, lambda v: F.try_variant_get(v, "$" + rest, "string"))
    return F.array_join(F.filter(texts, lambda x: x.isNotNull() & (x != "")), separator)


def first_text(item: Column, paths: tuple[str, ...]) -> Column:
    """Of the paths' texts the first that is not blank, else blank."""
    found = [F.when(~is_missing(_at(item, p)), strip(_at(item, p))) for p in paths]
    return F.coalesce(*found, F.lit("")) if found else F.lit("")


def coerce_text(value: Column) -> Column:
    """Text of a variant of any shape: lists joined, an object's name or else its JSON, null blank."""
    name = F.coalesce(F.try_variant_get(value, "$.name", "string"), F.try_variant_get(value, "$.value", "string"))
    many = F.array_join(F.transform(F.try_variant_get(value, "$", "array<variant>"), lambda v: F.coalesce(F.try_variant_get(v, "$.name", "string"), F.try_variant_get(v, "$", "string"))), ", ")
    return F.coalesce(name, many, F.try_variant_get(value, "$", "string"), F.lit(""))


def _items(pages: DataFrame, spec: Platform) -> DataFrame:
    parsed = pages.withColumn("_doc", F.try_parse_json("payload"))
    return parsed.select(*pages.columns, F.posexplode(F.try_variant_get("_doc", spec.items, "array<variant>")).alias("_at", "_item"))


def joined_text(item: Column, separator: str, paths: tuple[str, ...]) -> Column:
    texts = F.array(*[text_of(_at(item, p)) for p in paths])
    return F.array_join(F.filter(texts, lambda x: x != ""), separator)


def read_platform(pages: DataFrame, platform: str, settings: dict[str, str] | None = None) -> DataFrame:
    """Postings of one platform's pages, as listed: ``FIELDS`` and ``page, position``.

    settings: ``name``, the company where pages don't say it, and ``detail_url`` with ``{job_id}``.
    """
    spec, settings = PLATFORMS[platform], settings or {}
    rows = _items(pages.where(F.col("platform") == platform), spec)
    item, fields = F.col("_item"), {}
    for f in FIELDS:
        fields[f] = joined_text(item, *spec.parts[f]) if f in spec.parts else first_text(item, spec.id if f == "job_id" else spec.paths.get(f, ()))
    if platform in RANGED:
        low, high = (F.try_variant_get(item, f"$.experience.{k}", "string") for k in ("from", "to"))
        fields["experience"] = F.when(low.isNotNull(), years_text(low, high)).when(fields["experience"] == "None", "").otherwise(fields["experience"])
        degree = F.create_map(*[x for pair in DEGREES.items() for x in map(F.lit, pair)])
        fields["education"] = F.coalesce(degree[F.lower(fields["education"])], fields["education"])
    if platform == "kuaishou":
        fields["salary"] = salary_range(*[F.try_variant_get(item, f"$.{k}", "string") for k in ("salaryMin", "salaryMax")])
    name = F.lit(settings.get("name", platform))
    fields["platform"] = F.lit(platform)
    fields["company"] = F.coalesce("company", name) if "company" in pages.columns else name
    fields["scraped_at"] = F.coalesce("scraped_at", F.lit("")) if "scraped_at" in pages.columns else F.lit("")
    if url := settings.get("detail_url"):
        address = F.replace(F.lit(url), F.lit("{job_id}"), first_text(item, spec.id[-1:]))  # the platform's own id, where it has two
        fields["url"] = F.when(fields["job_id"] != "", address).otherwise("")
    return rows.select(*[v.alias(k) for k, v in fields.items()], "page", F.col("_at").alias("position"))


def read_all(pages: DataFrame, platforms: list[str], settings: dict[str, dict[str, str]] | None = None) -> DataFrame:
    """Postings of all given platforms; one without pages adds none."""
    out = None
    for p in platforms:
        rows = read_platform(pages, p, (settings or {}).get(p))
        out = rows if out is None else out.unionByName(rows)
    return out


def with_details(postings: DataFrame, details: DataFrame, fields: tuple[str, ...] = ("description", "requirements", "department")) -> DataFrame:
    """Listed postings with their detail pages' texts (``platform, job_id`` and fields) where those are not blank."""
    more = details.select("platform", "job_id", *[F.col(f).alias(f"_{f}") for f in fields if f in details.columns])
    rows = postings.join(more, ["platform", "job_id"], "left")
    given = [f for f in fields if f in details.columns]
    return rows.withColumns({f: F.when(~is_missing(F.col(f"_{f}")), F.col(f"_{f}")).otherwise(F.col(f)) for f in given}).drop(*[f"_{f}" for f in given])


def distinct_postings(postings: DataFrame) -> DataFrame:
    """One row an id: the earliest listed. Rows without id go."""
    order = F.struct("page", "position")
    first = postings.where(~is_missing(F.col("job_id"))).groupBy("platform", "job_id").agg(F.min_by(F.struct(*postings.columns), order).alias("_row"))
    return first.select("_row.*")


def decode(codes: Column, names: dict[str, str], separator: str = ", ") -> Column:
    """Names of comma-separated codes; a code without name stays."""
    known = F.create_map(*[x for pair in names.items() for x in map(F.lit, pair)])
    return F.array_join(F.transform(F.split(codes, r"\s*,\s*"), lambda x: F.coalesce(known[x], x)), separator)


def salary_range(low: Column, high: Column) -> Column:
    return F.when(low.isNotNull() & high.isNotNull(), F.concat_ws("-", low, high)).when(low.isNotNull(), F.concat(low, F.lit("以上"))).when(high.isNotNull(), F.concat(high, F.lit("以下"))).otherwise("")


def years_text(low: Column, high: Column) -> Column:
    """A range of years as the list shows it."""
    return F.when(low.isNotNull() & high.isNotNull(), F.concat(low.cast("string"), F.lit("-"), high.cast("string"), F.lit("年"))).when(low.isNotNull(), F.concat(low.cast("string"), F.lit("年以上"))).otherwise("")


def province_wanted(location: Column, cities: list[str]) -> Column:
    """A bare province counts where one of the cities it stands for is wanted."""
    wanted = {x.strip().removesuffix("市") for x in cities}
    names = [p for p, inside in PROVINCE_CITIES.items() if wanted & set(inside)]
    place = F.regexp_replace(text_of(location), "省$", "")
    return place.isin(*names) if names else F.lit(False)


def city_totals(ledger: DataFrame) -> DataFrame:
    """``city, first, last, low, high``: the totals a city's pages stated, for a list read city by city (``city, page, total``)."""
    return ledger.groupBy("city").agg(F.min_by("total", "page").alias("first"), F.max_by("total", "page").alias("last"), F.min("total").alias("low"), F.max("total").alias("high"))


def detail_queue(postings: DataFrame, limit: int | None = None) -> DataFrame:
    """Ids whose detail page is to be read, in listed order, ``limit`` of them at most."""
    rows = postings.where(~is_missing(F.col("job_id"))).select("platform", "job_id", "page", "position").orderBy("page", "position", "job_id")
    return rows if limit is None else rows.limit(limit)


def not_recruiters(title: Column, terms: list[str]) -> Column:
    return ~F.exists(F.array(*[F.lit(t.lower()) for t in terms]), lambda t: F.contains(F.lower(title), t))


def page_ledger(pages: DataFrame, platform: str) -> DataFrame:
    """A row a page: ``page, items, ids`` (in order), ``total``, ``repeated`` (an earlier page has the same ids), ``empty``."""
    spec = PLATFORMS[platform]
    item = F.col("_item")
    ids = _items(pages.where(F.col("platform") == platform), spec).groupBy("page").agg(F.array_sort(F.collect_list(F.struct("_at", first_text(item, spec.id).alias("id")))).alias("_ids"))
    total = F.try_variant_get(F.try_parse_json("payload"), spec.total, "bigint") if spec.total else F.lit(None).cast("long")
    listed = pages.where(F.col("platform") == platform).select("page", total.alias("total"))
    rows = listed.join(ids, "page", "left").withColumn("ids", F.transform(F.coalesce("_ids", F.array().cast("array<struct<_at: int, id: string>>")), lambda x: x["id"]))
    same = Window.partitionBy(F.sha2(F.to_json("ids"), 256)).orderBy("page")
    return rows.withColumns({"items": F.size("ids"), "empty": F.size("ids") == 0}).withColumn("repeated", ~F.col("empty") & (F.row_number().over(same) > 1)).drop("_ids")


def manifest_counters(postings: DataFrame, cities: list[str], include_unknown: bool = False) -> DataFrame:
    """Counters a platform: fetched, mapped, in scope, outside, unknown location, repeated and missing ids."""
    rows = postings.withColumns({"_missing": is_missing(F.col("job_id")), "_first": F.row_number().over(Window.partitionBy("platform", "job_id").orderBy("page", "position")) == 1})
    mapped = ~F.col("_missing") & F.col("_first")
    inside = location_wanted(F.col("location"), cities, include_unknown)
    blank = is_missing(F.col("location"))
    n = lambda when: F.count_if(when)
    return rows.groupBy("platform").agg(
        F.count("*").alias("records_fetched"), n(mapped).alias("jobs_mapped"), n(mapped & inside).alias("jobs_in_scope"), n(mapped & ~inside).alias("outside_city_scope"),
        n(mapped & blank).alias("unknown_location"), n(~F.col("_missing") & ~F.col("_first")).alias("duplicate_records"), n("_missing").alias("missing_job_id"),
    )


def region_duplicates(postings: DataFrame) -> DataFrame:
    """``platform, within, across``: repeated ids in one region's list, and ids that several regions list."""
    once = postings.groupBy("platform", "job_id", "region").agg(F.count("*").alias("n"))
    ids = once.groupBy("platform", "job_id").agg(F.sum(F.col("n") - 1).alias("within"), (F.count("*") - 1).alias("across"))
    return ids.groupBy("platform").agg(F.sum("within").alias("within"), F.sum("across").alias("across"))


def ordered_hash(ids: Column) -> Column:
    """SHA-256 of the ids' JSON array, in their order."""
    return F.sha2(F.to_json(ids), 256)


def list_problems(ledger: DataFrame, first_page_again: DataFrame | None = None, keys: tuple[str, ...] = ()) -> DataFrame:
    """A row a list (``keys``) ``reasons, primary, first_hash``: what speaks against a complete, stable list, in fixed order.

    ledger: ``keys, page, total, ids, empty``; first_page_again: ``keys, ids`` of page one read again at the end. A list
    ends where a page is empty or shorter than the first one.
    """
    by = list(keys) or ["_list"]
    if not keys:
        ledger = ledger.withColumn("_list", F.lit(""))
        first_page_again = None if first_page_again is None else first_page_again.withColumn("_list", F.lit(""))
    ids = ledger.select(*by, F.explode("ids").alias("id")).groupBy(*by).agg(F.count("*").alias("n"), F.count_distinct(F.when(F.col("id") != "", F.col("id"))).alias("unique"), F.count_if(F.col("id") == "").alias("missing"))
    pages = ledger.groupBy(*by).agg(F.min("total").alias("low"), F.max("total").alias("high"), F.min_by("ids", "page").alias("first"), F.max_by("ids", "page").alias("last"), F.max_by("empty", "page").alias("ends_empty"))
    again = ledger.sparkSession.createDataFrame([], ", ".join([*(f"{k} string" for k in by), "again array<string>"])) if first_page_again is None else first_page_again.select(*by, F.col("ids").alias("again"))
    rows = pages.join(ids, by, "left").join(again, by, "left")
    unique, missing, n = (F.coalesce(k, F.lit(0)) for k in ("unique", "missing", "n"))
    stable = F.col("low") == F.col("high")
    ended = F.col("ends_empty") | (F.size("last") < F.size("first"))
    reasons = F.array_compact(
        F.array(
            F.when(~stable, "dynamic_total"),
            F.when(F.col("first") != F.col("again"), "dynamic_page1"),
            F.when(unique + missing < n, "duplicate_pagination"),
            F.when(unique < F.col("high"), "unique_deficit"),
            F.when(F.col("high").isNull() | F.col("again").isNull() | ~ended | (missing > 0) | (stable & (unique > F.col("high"))), "incomplete_list"),
        )
    )
    return rows.select(*keys, reasons.alias("reasons"), ordered_hash(F.col("first")).alias("first_hash")).withColumn("primary", F.try_element_at("reasons", F.lit(1)))


def stated_totals(pages: DataFrame, platforms: list[str]) -> DataFrame:
    """``platform, source_total, expected_pages, pages_fetched, list_end``: what the pages state and what was fetched.

    Expected are as many pages as the total needs at the first page's length, at least up to the last page that is there;
    a platform that states no total is measured by its own records. ``list_end``: the last page is empty or a short one.
    """
    out = None
    for p in platforms:
        ledger = page_ledger(pages, p)
        sums = ledger.agg(F.max("total").alias("total"), F.sum("items").alias("items"), F.min_by("items", "page").alias("first"), F.max_by("items", "page").alias("last"), F.max("page").alias("last_page"), F.count_distinct("page").alias("pages_fetched")).where("pages_fetched > 0")
        wanted = F.coalesce("total", "items", F.lit(0)).cast("long")
        expected = F.greatest(F.ceil(F.try_divide(wanted, F.col("first"))), F.col("last_page"), F.lit(1)).cast("long")
        row = sums.select(F.lit(p).alias("platform"), wanted.alias("source_total"), expected.alias("expected_pages"), "pages_fetched", (F.coalesce("last", F.lit(0)) < F.coalesce("first", F.lit(0))).alias("list_end"))
        out = row if out is None else out.unionByName(row)
    return out


def error_histogram(details: DataFrame, column: str = "error_type", top: int = 20) -> DataFrame:
    return details.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column).limit(top)


def placeholders(postings: DataFrame, values: dict[str, str]) -> DataFrame:
    return postings.withColumns({k: F.when(is_missing(F.col(k)), F.lit(v)).otherwise(text_of(F.col(k))) for k, v in values.items()})
