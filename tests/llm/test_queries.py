"""Every training-data query against its SQL on the smallest tables; those without SQL against what they promise."""

import duckdb
import pytest

from postlens.llm import queries as Q

TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_same_rows_as_sql(spark, sf, duck, name):
    df = Q.QUERIES[name](spark, sf)
    found = duck.execute(Q.ORACLES[name])
    columns = [d[0] for d in found.description]
    assert sorted(columns) == sorted(df.columns)
    assert sorted(repr(tuple(r)) for r in df.select(*columns).collect()) == sorted(map(repr, found.fetchall()))


def test_names():
    assert sorted(int(n[2:].split("_")[0]) for n in Q.QUERIES) == list(range(1, 14))


def test_language_query(spark, sf):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = [r for r in Q.op8_language_id(spark, sf).collect() if r.held_out]
    assert len(rows) > 20 and sum(truth[r.doc_id] == r.lang_pred for r in rows) >= 0.97 * len(rows)


def test_secret_query(spark, sf):
    rows = Q.op10_secrets(spark, sf).collect()
    assert rows and all(r.is_secret for r in rows if r.length == 40)


def test_search_recall_is_whole(spark, sf):
    """Exact search: each query has ten hits in falling order."""
    rows = Q.op5_topk(spark, sf).collect()
    assert {r.rank for r in rows} == set(range(1, 11)) and len(rows) == 10 * len({r.query_id for r in rows})
