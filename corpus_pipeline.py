"""A corpus from raw documents to token ids, a stage an operator.

Each stage works on all rows that its predecessor kept. Its result is written as
Parquet and read back as the next one's documents. All but the last return the
columns of documents:

1. language: documents without a recognisable language go;
2. near duplicates: of each group of near-duplicate documents that of the least id stays;
   where an id repeats with other texts, each row is judged by its own text;
3. decontamination: documents that hold a passage of the benchmark go;
4. mixing: documents are dropped or repeated so that sources meet their weights;
5. token ids: the encoded documents, in ascending id order.

Rows with a null id are documents like others and come after all ids; a null source
is one source, a null text has no language and goes in the first. Rows that repeat
whole are copies, of which one stays. An empty table gives an empty result, and
further columns of any name pass through all but the last stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from postlens.llm import decontaminate, language_id, mixing, ngram_join, store, token_output
from postlens.llm.queries import END_ID, token_vocabulary

#: Documents whose two nearest languages are closer than this are rejected.
AMBIGUOUS_BELOW = 0.01


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language_id.train(language_id.training_rows(docs))
    return language_id.keep_identified(docs, model, AMBIGUOUS_BELOW)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one(docs, n=5, near=75)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_rows(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = store.new_path(spark, "token-ids")
    token_output.write_tokens(docs, path, token_vocabulary(), END_ID)
    return token_output.read_digests(spark, path)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language),
    ("ngram_join", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mix),
    ("token_ids", token_ids),
]

#: Fingerprints, a trained model and a tokeniser are not for SQL; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = store.table(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
