"""Readers and writers of the files around postings."""

from __future__ import annotations

import os
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

POSTING = T.StructType([T.StructField(x, T.StringType()) for x in ("job_id", "platform", "title", "company", "department", "location", "experience", "education", "salary", "description", "requirements", "url", "scraped_at")])
MANIFEST = T.StructType(
    [T.StructField(x, T.StringType()) for x in ("snapshot_date", "platform", "name", "status", "stopped_by", "error", "started_at", "finished_at")]
    + [T.StructField("complete", T.BooleanType())]
    + [T.StructField(x, T.LongType()) for x in ("source_total", "expected_pages", "pages_fetched", "records_fetched", "jobs_mapped", "jobs_in_scope", "outside_city_scope", "unknown_location", "duplicate_records", "missing_job_id", "details_fetched", "detail_failed")]
    + [T.StructField(x, T.ArrayType(T.StringType())) for x in ("failed_companies", "attempted_companies", "detail_failed_job_ids")]
    + [T.StructField("duration_seconds", T.DoubleType())]
)


def read_json_array(spark: SparkSession, path: str, schema: T.StructType = POSTING) -> DataFrame:
    """A JSON array of objects; anything else fails. Fields of the schema that a row lacks are null."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


def bad_elements(spark: SparkSession, path: str) -> DataFrame:
    """``path, row_number, kind`` of a file's array elements that are no objects (from 1); row 0 stands for a file that is no array."""
    files = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.try_variant_get(F.try_parse_json("value"), "$", "array<variant>").alias("_all"))
    each = files.select("path", F.posexplode_outer("_all").alias("_at", "_item"), F.col("_all").isNull().alias("_none"))
    kind = F.when(F.col("_none"), "not an array").otherwise(F.schema_of_variant("_item"))
    rows = each.where("_none OR _at IS NOT NULL").select("path", F.when(F.col("_none"), 0).otherwise(F.col("_at") + 1).alias("row_number"), F.coalesce(kind, F.lit("VOID")).alias("kind"))
    return rows.where(~F.col("kind").startswith("OBJECT"))


def check_json_array(spark: SparkSession, path: str) -> None:
    """Fails on the first element that is no object, with its number from 1."""
    first = bad_elements(spark, path).orderBy("path", "row_number").first()
    if first is not None:
        raise ValueError(f"{first.path}: row {first.row_number}: {first.kind}")


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A JSON object a line; blank lines are ignored."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    """A JSON object a line, nulls kept; the Unicode line ends inside texts are escaped."""
    line = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    for ch in ("\u0085", "\u2028", "\u2029"):
        line = F.replace(line, F.lit(ch), F.lit(f"\\u{ord(ch):04x}"))
    df.select(line.alias("value")).write.mode("overwrite").text(path)


def read_manifests(spark: SparkSession, path: str) -> DataFrame:
    """A row for each platform of each day's manifest; the day is the file's name."""
    envelope = T.StructType([T.StructField("job_count", T.LongType()), T.StructField("cities", T.ArrayType(T.StringType())), T.StructField("complete", T.BooleanType()), T.StructField("platforms", T.ArrayType(MANIFEST))])
    days = spark.read.schema(envelope).option("multiLine", True).json(path)
    days = days.withColumn("_day", F.regexp_extract(F.input_file_name(), r"(\d{4}-\d{2}-\d{2})_manifest", 1))
    rows = days.select("_day", "job_count", F.array_sort("cities").alias("cities"), F.col("complete").alias("day_complete"), F.explode("platforms").alias("p"))
    return rows.select(F.to_date("_day").alias("snapshot_date"), "job_count", "cities", "day_complete", *[F.col(f"p.{x.name}").alias(x.name) for x in MANIFEST if x.name != "snapshot_date"])


def write_day(df: DataFrame, path: str, keys: tuple[str, ...] = ("snapshot_date", "platform")) -> None:
    """Replace just the partitions that ``df`` has rows for; a run that fetched nothing replaces nothing."""
    if not df.limit(1).count():
        raise ValueError("no rows: the stored partitions stay as they are")
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def write_text(path: str, text: str, bom: bool = False) -> None:
    """A small report on the driver: written beside its place, then moved there."""
    target = Path(path)
    target.parent.mkdir(parents=True, exist_ok=True)
    handle, name = tempfile.mkstemp(dir=target.parent)
    with os.fdopen(handle, "w", encoding="utf-8-sig" if bom else "utf-8") as file:
        file.write(text)
        file.flush()
        os.fsync(file.fileno())
    os.replace(name, target)


def read_config(path: str) -> dict:
    """YAML without repeated keys."""
    import yaml

    class Strict(yaml.SafeLoader):
        pass

    def mapping(loader, node, deep=False):
        keys = [loader.construct_object(k, deep) for k, _ in node.value]
        if len(set(keys)) != len(keys):
            raise ValueError(f"{path}: repeated key in {keys}")
        return {k: loader.construct_object(v, True) for k, (_, v) in zip(keys, node.value)}

    Strict.add_constructor(yaml.resolver.BaseResolver.DEFAULT_MAPPING_TAG, mapping)
    with open(path, encoding="utf-8") as file:
        found = yaml.load(file, Strict)
    if not isinstance(found, dict):
        raise ValueError(f"{path}: not a mapping")
    return found


#: Shapes of configurations: names of keys with what their values are; "?" ends an optional key, "*" stands for any.
MAIN = {"platforms": {"*": {"enabled": bool, "name?": str, "companies?": list, "*?": object}}, "cities?": [str], "include_unknown?": bool, "*?": object}
VERSIONS = {"market_classifier_version": str, "fit_classifier_version": str, "skill_ontology_version": str, "trend": {"window_days": {7}, "removal_confirmation_runs": int, "version?": str}, "*?": object}
LIMITATIONS = {"version": {1}, "limitations": [{"id": str, "platform": str, "status": {"active", "retired"}, "category": str, "allowed_reasons": [str], "review_after": str, "review_cadence_days": int, "reference": {"*": object}, "*?": object}]}
TOLERANCE = {"max_failed_details": int, "max_failed_rate": float}


def config_problems(value, shape, path: str = "$") -> list[str]:
    """What in a configuration is not of the shape: keys that lack, keys that nobody knows, values of another type or not among those allowed."""
    if isinstance(shape, dict):
        if not isinstance(value, dict):
            return [f"{path}: a mapping is needed"]
        known = {k.rstrip("?"): v for k, v in shape.items() if k.rstrip("?") != "*"}
        other = shape.get("*", shape.get("*?"))
        out = [f"{path}.{k}: missing" for k in shape if not k.endswith("?") and k != "*" and k not in value]
        if "*" in shape and not value:
            out.append(f"{path}: empty")
        for k, v in value.items():
            if k in known or other is not None:
                out += config_problems(v, known.get(k, other), f"{path}.{k}")
            else:
                out.append(f"{path}.{k}: unknown key")
        return out
    if isinstance(shape, list):
        if not isinstance(value, list) or not value:
            return [f"{path}: a list of one or more is needed"]
        return [x for n, v in enumerate(value) for x in config_problems(v, shape[0], f"{path}[{n}]")]
    if isinstance(shape, set):
        return [] if not isinstance(value, bool) and value in shape else [f"{path}: one of {sorted(map(str, shape))} is needed"]
    fits = isinstance(value, (int, float)) if shape is float else isinstance(value, shape)
    if shape in (int, float) and isinstance(value, bool):
        fits = False
    if shape is str and not (isinstance(value, str) and value.strip()):
        fits = False
    return [] if fits else [f"{path}: {shape.__name__} is needed"]


def load_config(path: str, shape: dict) -> dict:
    """A configuration of a shape; all that is wrong with it is told at once."""
    found = read_config(path)
    if problems := config_problems(found, shape):
        raise ValueError(f"{path}: " + "; ".join(problems))
    return found


def scope_rows(spark: SparkSession, config: dict) -> DataFrame:
    """``platform, companies`` of the enabled platforms; null companies allow all."""
    rows = []
    for name, value in (config.get("platforms") or {}).items():
        if value.get("enabled"):
            companies = value.get("companies")
            names = [x["name"] if isinstance(x, dict) else x for x in companies] if isinstance(companies, list) else None
            rows.append((name, names))
    return spark.createDataFrame(rows, "platform string, companies array<string>")
