"""Landed payloads against the shape that their reader expects, and sweeps of keywords.

The shape of a day is its payloads' merged schema, found by Spark; what is expected is what ``postings.PLATFORMS`` reads.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import is_missing
from . import postings

c = F.col
PATHS = T.ArrayType(T.StructType([T.StructField("path", T.StringType()), T.StructField("kind", T.StringType())]))
#: Types whose values a reader takes as text.
SCALAR = ("STRING", "BIGINT", "DECIMAL", "DOUBLE", "FLOAT", "BOOLEAN", "VOID")


def paths_of(schema: str | None) -> list[dict]:
    """Paths and kinds in a schema as Spark writes it: ``OBJECT<a: BIGINT, b: ARRAY<OBJECT<c: STRING>>>``; a list's items are ``[]``."""
    out: list[dict] = []
    if not schema:
        return out
    at = 0

    def read(path: str) -> None:
        nonlocal at
        if schema.startswith("OBJECT<", at):
            out.append({"path": path, "kind": "OBJECT"})
            at += len("OBJECT<")
            while schema[at] != ">":
                if schema[at] == "`":
                    end = at + 1
                    while schema[end] != "`" or schema[end + 1 : end + 2] == "`":
                        end += 2 if schema[end] == "`" else 1
                    name, at = schema[at + 1 : end].replace("``", "`"), end + 1
                else:
                    end = schema.index(":", at)
                    name, at = schema[at:end], end
                at += len(": ")
                read(f"{path}.{name}")
                if schema.startswith(", ", at):
                    at += 2
            at += 1
        elif schema.startswith("ARRAY<", at):
            out.append({"path": path, "kind": "ARRAY"})
            at += len("ARRAY<")
            read(f"{path}[]")
            at += 1
        else:
            kind = re.match(r"[A-Z_ ]+(?:\([0-9, ]*\))?", schema[at:])[0]
            out.append({"path": path, "kind": kind.split("(")[0]})
            at += len(kind)

    read("$")
    return out


@F.pandas_udf(PATHS)
def schema_paths(schemas: Iterator[pd.Series]) -> Iterator[pd.Series]:
    known: dict[str, list] = {}
    for batch in schemas:
        yield batch.map(lambda s: known.setdefault(s, paths_of(s)))


def expected(spark: SparkSession, platforms: list[str] | None = None) -> DataFrame:
    """``platform, path, kind, needed``: what readers look at. Lists and objects on the way are needed, of a field's several paths none by itself."""
    rows: dict[tuple[str, str], tuple[str, bool]] = {}
    for name in platforms or postings.PLATFORMS:
        spec = postings.PLATFORMS[name]

        def add(path: str, kind: str, needed: bool, name=name) -> None:
            parts = re.findall(r"\$|\.[^.\[]+|\[\]", path)
            for n in range(1, len(parts)):
                above = "".join(parts[:n])
                rows[name, above] = ("ARRAY" if parts[n] == "[]" else "OBJECT", rows.get((name, above), ("", False))[1] or needed)
            rows.setdefault((name, path), (kind, needed))

        add(spec.items + "[]", "OBJECT", True)
        if spec.total:
            add(spec.total, "SCALAR", True)
        for f in (spec.id, *spec.paths.values(), *[p for _, p in spec.parts.values()]):
            for path in f:
                add(f"{spec.items}[]{path[1:]}", "SCALAR", len(f) == 1)
    return spark.createDataFrame([(p, path, kind, needed) for (p, path), (kind, needed) in sorted(rows.items())], "platform string, path string, kind string, needed boolean")


def shapes(pages: DataFrame) -> DataFrame:
    """``platform, snapshot_date, path, kind, pages, of_pages``: the merged kind of each path on each day, and on how many pages it is."""
    day = ["platform", "snapshot_date"]
    parsed = pages.select(*day, F.try_parse_json("payload").alias("_doc"))
    whole = parsed.groupBy(*day).agg(F.schema_of_variant_agg("_doc").alias("_schema"), F.count("*").alias("of_pages"))
    merged = whole.select(*day, "of_pages", F.inline(schema_paths("_schema")))
    each = parsed.select(*day, F.explode(F.array_distinct(F.transform(schema_paths(F.schema_of_variant("_doc")), lambda x: x["path"]))).alias("path")).groupBy(*day, "path").agg(F.count("*").alias("pages"))
    return merged.join(each, [*day, "path"], "left").select(*day, "path", "kind", F.coalesce("pages", F.lit(0)).alias("pages"), "of_pages")


def drift(pages: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """``platform, snapshot_date, path, problem, expected, found, pages, of_pages``: where a day's payloads are not of the expected shape.

    MISSING: a needed path that no page has (below a missing one its own paths are not told again); RETYPED: a list where
    a text was, or such; NEW: below an expected list or object, a path that no reader knows; UNREADABLE: pages that are no JSON.
    """
    wanted = expected(pages.sparkSession) if wanted is None else wanted
    day = ["platform", "snapshot_date"]
    got = shapes(pages)
    days = got.groupBy(*day).agg(F.max("of_pages").alias("_all"))
    both = days.join(wanted.withColumnRenamed("kind", "expected"), "platform").join(got.withColumnRenamed("kind", "found"), [*day, "path"], "full_outer")
    both = both.withColumn("_up", F.regexp_replace("path", r"(?:\.[^.\[]+|\[\])$", ""))
    above = got.select(*day, c("path").alias("_up"), F.lit(True).alias("_has_up"))
    known = wanted.select("platform", c("path").alias("_up"), F.lit(True).alias("_known_up"))
    rows = both.join(above, [*day, "_up"], "left").join(known, ["platform", "_up"], "left")
    scalar = (c("expected") == "SCALAR") & c("found").isin(*SCALAR)
    problem = (
        F.when(c("found").isNull() & c("needed") & (F.coalesce("_has_up", F.lit(False)) | (c("path") == "$")), "MISSING")
        .when(c("expected").isNotNull() & c("found").isNotNull() & ~scalar & (c("expected") != c("found")) & (c("found") != "VOID"), "RETYPED")
        .when(c("expected").isNull() & F.coalesce("_known_up", F.lit(False)), "NEW")
    )
    told = rows.withColumn("problem", problem).where("problem IS NOT NULL").select(*day, "path", "problem", "expected", "found", F.coalesce("pages", F.lit(0)).alias("pages"), F.coalesce("of_pages", "_all").alias("of_pages"))
    broken = pages.groupBy(*day).agg(F.count_if(F.try_parse_json("payload").isNull()).alias("pages"), F.count("*").alias("of_pages")).where("pages > 0")
    return told.unionByName(broken.select(*day, F.lit("$").alias("path"), F.lit("UNREADABLE").alias("problem"), *[F.lit(None).cast("string").alias(k) for k in ("expected", "found")], "pages", "of_pages"))


def check_shape(pages: DataFrame, wanted: DataFrame | None = None) -> None:
    """Fails on the first path that is missing, retyped or unreadable; new ones are no error."""
    first = drift(pages, wanted).where("problem <> 'NEW'").orderBy("platform", "snapshot_date", "path").first()
    if first is not None:
        raise ValueError(f"SCHEMA_DRIFT: {first.platform} {first.snapshot_date} {first.path} {first.problem}: {first.expected} but {first.found} on {first.pages} of {first.of_pages} pages")


def sweep(listed: DataFrame, keywords: list[str], recruiters: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Postings, a ledger and what was left out, of lists read keyword by keyword (``keyword, page, position`` beside the posting).

    Postings: each id once, at its first place in the order of the keywords. Ledger: ``keyword, pages, records, new`` (ids that no earlier
    keyword has), ``repeated, excluded, missing``, for keywords without a page too. Left out: recruiters' postings by their titles.
    """
    order = listed.sparkSession.createDataFrame(list(enumerate(keywords)), "_nth long, keyword string")
    rows = listed.join(F.broadcast(order), "keyword")  # the keywords that were asked for
    place = Window.partitionBy("platform", "job_id").orderBy("_nth", "page", "position")
    rows = rows.withColumns({"_missing": is_missing(c("job_id")), "_out": ~postings.not_recruiters(F.coalesce("title", F.lit("")), recruiters)})
    rows = rows.withColumn("_first", ~c("_missing") & (F.row_number().over(place) == 1))
    sums = rows.groupBy("keyword").agg(F.count_distinct("page").alias("pages"), F.count("*").alias("records"), F.count_if(c("_first") & ~c("_out")).alias("new"), F.count_if(~c("_first") & ~c("_missing")).alias("repeated"), F.count_if(c("_first") & c("_out")).alias("excluded"), F.count_if("_missing").alias("missing"))
    told = order.join(sums, "keyword", "left").na.fill(0).orderBy("_nth").drop("_nth")
    first = rows.where("_first").drop("_nth", "_missing", "_first")
    return first.where(~c("_out")).drop("_out"), told, first.where("_out").drop("_out")
