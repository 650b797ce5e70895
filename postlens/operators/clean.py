"""Locations, scope and company summaries. All projections keep every row and column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import distinct_texts, is_missing, or_missing, strip, tags, text_of
from . import ontology as O

SEPARATORS = r"[、,，/]"
UNKNOWN = "unknown"


def split_locations(value: Column) -> Column:
    """Parts between separators, stripped, without blanks; none for null."""
    return F.filter(F.transform(F.split(F.coalesce(value, F.lit("")), SEPARATORS), strip), lambda x: x != "")


def _lookup(part: Column, level: str, names: dict[str, str]) -> list[tuple[Column, Column]]:
    return [(part == raw, F.struct(F.lit(name).alias("name"), F.lit(level).alias("level"))) for raw, name in names.items()]


def location_part(part: Column) -> Column:
    """``struct<name, level>``: aliases by city, province, region, country, then the suffix, else unknown."""
    known = [x for level, names in (("city", O.CITY_ALIASES), ("province", O.PROVINCE_ALIASES), ("region", O.REGION_ALIASES), ("country", O.COUNTRY_ALIASES)) for x in _lookup(part, level, names)]
    both = lambda name, level: F.struct(name.alias("name"), F.lit(level).alias("level"))
    chain = F.when(part == "", both(F.lit(UNKNOWN), UNKNOWN))
    for condition, value in known:
        chain = chain.when(condition, value)
    chain = chain.when(part.endswith("市"), both(strip(F.regexp_replace(part, "市$", "")), "city"))
    return chain.when(part.endswith("省"), both(part, "province")).otherwise(both(F.lit(UNKNOWN), UNKNOWN))


def normalize_locations(jobs: DataFrame, column: str = "location") -> DataFrame:
    """Adds ``locations_norm, location_level, province_norm, city_norm``; the first of equal names stays."""
    parts = F.transform(split_locations(F.col(column)), location_part)
    first = F.aggregate(parts, F.slice(parts, 1, 0), lambda out, x: F.when(F.exists(out, lambda y: y["name"] == x["name"]), out).otherwise(F.concat(out, F.array(x))))
    unknown = F.array(F.struct(F.lit(UNKNOWN).alias("name"), F.lit(UNKNOWN).alias("level")))
    jobs = jobs.withColumn("_parts", F.when(F.size(first) > 0, first).otherwise(unknown))
    named = lambda level: F.transform(F.filter("_parts", lambda x: x["level"] == level), lambda x: x["name"])
    return jobs.withColumns({"locations_norm": F.col("_parts.name"), "location_level": F.col("_parts.level"), "province_norm": named("province"), "city_norm": named("city")}).drop("_parts")


def city_names(value: Column, strip_province: bool = False) -> Column:
    """Parts without their city suffix (and province suffix); order and repetitions stay."""
    bare = lambda x: strip(F.regexp_replace(x, "市$", ""))
    bare2 = lambda x: strip(F.regexp_replace(bare(x), "省$", "")) if strip_province else bare(x)
    return F.filter(F.transform(split_locations(value), bare2), lambda x: x != "")


def place_companies(jobs: DataFrame, places: str = "city_norm") -> DataFrame:
    """``place, company, n``: a posting counts at each of its places."""
    return jobs.select(F.explode(places).alias("place"), or_missing(F.col("company")).alias("company")).groupBy("place", "company").agg(F.count("*").alias("n"))


def company_values(jobs: DataFrame, field: str) -> DataFrame:
    """``company, value, n``."""
    return jobs.groupBy(or_missing(F.col("company")).alias("company"), or_missing(F.col(field)).alias("value")).agg(F.count("*").alias("n"))


def report_counters() -> list[Column]:
    """Aggregates over normalised rows: ``job_count, city_count, province_only_count``."""
    only = (F.size("province_norm") > 0) & F.forall("location_level", lambda x: x == "province")
    return [F.count("*").alias("job_count"), F.coalesce(F.sum(F.size("city_norm")), F.lit(0)).alias("city_count"), F.count_if(only).alias("province_only_count")]


def clean_report(clean: DataFrame) -> DataFrame:
    return clean.agg(*report_counters())


def education_values(jobs: DataFrame) -> Column:
    """The stated education by its alias, else what the text says."""
    stated = text_of(F.col("education"))
    alias = F.create_map(*[x for pair in O.EDUCATION_ALIASES.items() for x in map(F.lit, pair)])
    body = F.concat_ws("\n", text_of(F.col("description")), text_of(F.col("requirements")))
    return F.when(stated != "", F.array(F.coalesce(alias[F.lower(stated)], stated))).otherwise(tags(body, O.EDUCATION))


def experience_values() -> Column:
    stated = text_of(F.col("experience"))
    alias = F.create_map(*[x for pair in O.EXPERIENCE_ALIASES.items() for x in map(F.lit, pair)])
    return F.when(stated != "", F.array(F.coalesce(alias[stated], stated))).otherwise(F.array().cast("array<string>"))


def text_list(values: Column) -> Column:
    return distinct_texts(values)


def in_scope(jobs: DataFrame, scope: DataFrame) -> DataFrame:
    """Postings of the scope's platforms (``platform, companies``), where a null company list allows all."""
    jobs = jobs.alias("j")
    wanted = scope.alias("s")
    return jobs.join(wanted, (text_of(F.col("j.platform")) == F.col("s.platform")) & (F.col("s.companies").isNull() | F.array_contains("s.companies", text_of(F.col("j.company")))), "left_semi")


def location_wanted(location: Column, cities: list[str], include_unknown: bool) -> Column:
    """A reader's filter: blank by the flag; without cities all; else a city's name inside the text."""
    place = text_of(location)
    bare = [x.strip().removesuffix("市") for x in cities]
    inside = F.lit(not bare)
    for city in bare:
        inside = inside | F.contains(place, F.lit(city))
    return F.when(is_missing(location), F.lit(include_unknown)).otherwise(inside)
