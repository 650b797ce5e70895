"""Audits of data quality. Each returns rows; a report is their union."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, SparkSession
from pyspark.sql import functions as F

from ..functions.text import is_missing, normalized, or_missing, rx, strip, text_of

REQUIRED = ("job_id", "platform", "title", "company", "description", "location", "url")
OPTIONAL = ("department", "experience", "education", "salary", "requirements")
SHORT_TEXT = 50
# Fixed values.
NORMAL_STOPS = ("all_partitions_complete", "configured_max_pages", "empty_page", "repeated_page", "source_total_reached")
EDUCATION = r"(不限|无要求|博士|硕士|研究生|本科|学士|大专|专科|高中|中专|中技|初中|doctor|phd|master|bachelor|college|associate|high school)"
EXPERIENCE = r"(?:\d+(?:\.\d+)?|[零〇一二两三四五六七八九十百]+)\s*(?:[-~—至到]\s*(?:\d+(?:\.\d+)?|[零〇一二两三四五六七八九十百]+)\s*)?(?:年|years?)"


def missing_values(rows: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    """``field, n``: blank values of each field, in one pass."""
    counts = rows.agg(*[F.count_if(is_missing(F.col(f).cast("string"))).alias(f) for f in fields])
    return counts.unpivot([], list(fields), "field", "n")


def samples(rows: DataFrame, platform: str, order: str, per_platform: int) -> DataFrame:
    """The first rows of each platform; a blank platform is one of its own."""
    named = rows.withColumn("_platform", or_missing(F.col(platform)))
    ranked = named.withColumn("_n", F.row_number().over(Window.partitionBy("_platform").orderBy(order)))
    return ranked.where(F.col("_n") <= per_platform).drop("_n", "_platform")


def duplicate_groups(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Groups of two rows or more with one normalised key; rows with a blank key field stay out.

    ``key columns, n, extra, first_row``: extra is what a removal would drop. Only
    counts are gathered, so a key that most rows share costs no more than another.
    """
    whole = rows
    for k in keys:
        whole = whole.where(~is_missing(F.col(k)))
    groups = whole.groupBy(*[normalized(F.col(k)).alias(k) for k in keys]).agg(F.count("*").alias("n"), F.min(order).alias("first_row"))
    return groups.where("n > 1").withColumn("extra", F.col("n") - 1)


def covering_groups(groups: DataFrame, members: DataFrame, keys: list[str], per_platform: int) -> DataFrame:
    """Groups to show so that each platform has up to ``per_platform`` rows in them.

    A group is shown if one of its platforms still lacks rows when its turn comes,
    which depends on the groups shown before. Groups go by their first row, a
    bounded head of them for each platform: per_platform groups of a platform
    always suffice for it, so the fold sees no more than that.
    """
    pairs = members.join(groups.select(*keys, "first_row"), keys).groupBy(*keys, "first_row", "platform").agg(F.count("*").alias("rows"))
    head = pairs.withColumn("_n", F.row_number().over(Window.partitionBy("platform").orderBy("first_row", *keys))).where(F.col("_n") <= per_platform)
    listed = pairs.join(head.select(*keys).distinct(), keys, "left_semi").groupBy(*keys, "first_row").agg(F.collect_list(F.struct("platform", "rows")).alias("platforms"))
    shown, have = [], {}
    for row in listed.orderBy("first_row", *keys).toLocalIterator():
        if any(have.get(p.platform, 0) < per_platform for p in row.platforms):
            for p in row.platforms:
                have[p.platform] = have.get(p.platform, 0) + p.rows
            shown.append(tuple(row[k] for k in keys) + (row.first_row,))
    schema = ", ".join([f"{k} string" for k in keys] + [f"first_row {groups.schema['first_row'].dataType.simpleString()}"])
    return groups.sparkSession.createDataFrame(shown, schema)


def text_length(rows: DataFrame, fields: tuple[str, ...] = ("description", "requirements")) -> Column:
    total = F.lit(0)
    for f in fields:
        total = total + F.length(text_of(F.col(f)))
    return total


def short_texts(rows: DataFrame, fields: tuple[str, ...] = ("description", "requirements"), least: int = SHORT_TEXT) -> DataFrame:
    return rows.where(text_length(rows, fields) < least)


def empty_texts(rows: DataFrame, fields: tuple[str, ...] = ("description", "requirements")) -> DataFrame:
    return rows.where(text_length(rows, fields) == 0)


def valid_http_url(url: Column) -> Column:
    """An http or https address with something between the slashes."""
    return F.coalesce(text_of(url).rlike(r"^[hH][tT][tT][pP][sS]?://[^/?#]+"), F.lit(False))


def parses_education(value: Column) -> Column:
    return F.coalesce(value.rlike(rx(EDUCATION, "i")), F.lit(False))


def parses_experience(value: Column) -> Column:
    return F.coalesce(value.rlike(rx(EXPERIENCE, "i")), F.lit(False))


def parses_time(value: Column) -> Column:
    return F.try_to_timestamp(strip(value)).isNotNull() & ~is_missing(value)


def reconcile(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Counts by key on both sides, a missing side as 0, and whether they agree."""
    a = left.groupBy(*keys).agg(F.count("*").alias("left_rows"))
    b = right.groupBy(*keys).agg(F.count("*").alias("right_rows"))
    both = a.join(b, keys, "full_outer").withColumns({"left_rows": F.coalesce("left_rows", F.lit(0)), "right_rows": F.coalesce("right_rows", F.lit(0))})
    return both.withColumn("agree", F.col("left_rows") == F.col("right_rows"))


def manifest_reconcile(jobs: DataFrame, manifest: DataFrame) -> DataFrame:
    """Rows of each platform against its manifest's counters; absent counters are null."""
    counts = jobs.groupBy("platform").agg(F.count("*").alias("raw_rows"))
    rows = manifest.select("platform", "jobs_in_scope", "details_fetched", "detail_failed")
    return counts.join(rows, "platform", "full_outer").withColumn("raw_rows", F.coalesce("raw_rows", F.lit(0)))


def count_mismatch(jobs: DataFrame, job_count: int | None) -> DataFrame:
    """One row ``expected, found`` if a stated count differs."""
    found = jobs.agg(F.count("*").alias("found")).withColumn("expected", F.lit(job_count).cast("long"))
    return found.where(F.col("expected").isNotNull() & (F.col("expected") != F.col("found"))).select("expected", "found")


def incomplete_platforms(manifest: DataFrame) -> DataFrame:
    return manifest.where(~F.coalesce("complete", F.lit(False)))


def abnormal_stops(manifest: DataFrame) -> DataFrame:
    stop = text_of(F.col("stopped_by"))
    return manifest.where((stop != "") & ~stop.isin(*NORMAL_STOPS))


def quality_report(jobs: DataFrame, manifest: DataFrame, job_count: int | None, order: str = "row_number") -> DataFrame:
    """``issue, n`` for all audits."""
    one = lambda issue, df: df.agg(F.count("*").alias("n")).select(F.lit(issue).alias("issue"), "n")
    total = lambda issue, df, column: df.agg(F.coalesce(F.sum(column), F.lit(0)).alias("n")).select(F.lit(issue).alias("issue"), "n")
    compared = manifest_reconcile(jobs, manifest)
    parts = [
        total("missing_required", missing_values(jobs, REQUIRED), "n"),
        total("missing_optional", missing_values(jobs, OPTIONAL), "n"),
        total("duplicate_ids", duplicate_groups(jobs, ["platform", "job_id"], order), "extra"),
        total("suspected_duplicates", duplicate_groups(jobs, ["platform", "company", "title", "location"], order), "extra"),
        one("short_text", short_texts(jobs)),
        one("empty_text", empty_texts(jobs)),
        one("invalid_url", jobs.where(~valid_http_url(F.col("url")))),
        one("unparseable_education", jobs.where(~parses_education(F.col("education")))),
        one("unparseable_experience", jobs.where(~parses_experience(F.col("experience")))),
        one("unparseable_scraped_at", jobs.where(~parses_time(F.col("scraped_at")))),
        one("count_mismatch", count_mismatch(jobs, job_count)),
        one("platform_mismatch", compared.where(~F.col("raw_rows").eqNullSafe(F.col("jobs_in_scope")))),
        one("incomplete_platforms", incomplete_platforms(manifest)),
        one("abnormal_stops", abnormal_stops(manifest)),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def enum_status(value: Column, known: list[str], missing: list[str], invalid: list[str]) -> Column:
    """missing, known, invalid_format, invalid_unconfigured or unknown: the first that fits."""
    v = F.coalesce(value, F.lit(""))
    looks = (v.startswith("{") & v.endswith("}")) | (v.startswith("[") & v.endswith("]"))
    within = lambda names: v.isin(*names) if names else F.lit(False)
    return F.when(within(missing), "missing").when(within(known), "known").when(within(invalid), "invalid_format").when(looks, "invalid_unconfigured").otherwise("unknown")


Enums = dict[str, tuple[list[str], list[str], list[str]]]


def enum_rows(jobs: DataFrame, enums: Enums) -> DataFrame:
    """``platform, field, raw_value, status`` for each value of the enum fields."""
    keep = ["platform", "job_id", "url"]
    flat = jobs.select(*keep, *[F.coalesce(F.col(f), F.lit("")).alias(f) for f in enums]).unpivot(keep, list(enums), "field", "raw_value")
    status = None
    for field, (known, missing, invalid) in enums.items():
        of = enum_status(F.col("raw_value"), known, missing, invalid)
        status = F.when(F.col("field") == field, of) if status is None else status.when(F.col("field") == field, of)
    return flat.withColumn("status", status)


def enum_histogram(jobs: DataFrame, enums: Enums, samples_each: int = 2) -> DataFrame:
    """``platform, field, raw_value, status, n, samples``: samples are the ids least in order."""
    rows = enum_rows(jobs, enums)
    keys = ["platform", "field", "raw_value", "status"]
    few = rows.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy("job_id"))).where(F.col("_n") <= samples_each)
    shown = few.groupBy(*keys).agg(F.array_sort(F.collect_list("job_id")).alias("samples"))
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).join(shown, keys)


def enum_exceptions(jobs: DataFrame, enums: Enums) -> DataFrame:
    """Unknown and invalid values with the first address that isn't blank."""
    rows = enum_rows(jobs, enums).where(F.col("status").isin("unknown", "invalid_format", "invalid_unconfigured"))
    return rows.groupBy("platform", "field", "raw_value", "status").agg(F.count("*").alias("n"), F.min_by(F.when(~is_missing(F.col("url")), F.col("url")), F.when(~is_missing(F.col("url")), F.col("job_id"))).alias("url"))


def enum_health(jobs: DataFrame, enums: Enums) -> DataFrame:
    """``field, rows, known, missing, unknown, invalid, missing_rate, blocking``: configured invalid values don't block."""
    of = lambda *s: F.count_if(F.col("status").isin(*s))
    out = enum_rows(jobs, enums).groupBy("field").agg(
        F.count("*").alias("rows"), of("known").alias("known"), of("missing").alias("missing"), of("unknown").alias("unknown"), of("invalid_format", "invalid_unconfigured").alias("invalid"), of("invalid_unconfigured").alias("_blocks")
    )
    return out.withColumns({"missing_rate": F.try_divide("missing", "rows"), "blocking": (F.col("unknown") > 0) | (F.col("_blocks") > 0)}).drop("_blocks")


def failure_health(spark: SparkSession, fields: tuple[str, ...], reason: str) -> DataFrame:
    """What ``enum_health`` gives where the input can't be read at all: nothing counted, every field blocking, and why."""
    rows = [(f, 0, 0, 0, 0, 0, 0.0, True, reason) for f in fields]
    return spark.createDataFrame(rows, "field string, rows long, known long, missing long, unknown long, invalid long, missing_rate double, blocking boolean, blocking_reason string")
