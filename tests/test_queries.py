"""Every query of the base library against its SQL on the smallest tables."""

import duckdb
import pytest

from postlens import queries as Q

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


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
    want = sorted(map(repr, found.fetchall()))
    got = sorted(repr(tuple(r)) for r in df.select(*columns).collect())
    assert got == want


@pytest.mark.parametrize("name", sorted(set(Q.QUERIES) - set(Q.ORACLES)))
def test_runs(spark, sf, name):
    assert Q.QUERIES[name](spark, sf).count() >= 0


def test_entry(spark, sf):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scans_read_what_queries_need(spark, sf):
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan(Q.short_texts(spark, sf))
    assert "ReadSchema: struct<page_id:bigint,url:string>" in plan(Q.url_validity(spark, sf))
    shown = plan(Q.observation_gaps(spark, sf))
    assert "PushedFilters: []" in shown and "event_id" not in shown  # the whole table, three columns of it
    assert "PushedFilters: [IsNotNull(quality), EqualTo(quality,1)" in plan(Q.company_table(spark, sf))


@pytest.mark.parametrize("name", ["duplicate_groups", "first_occurrences", "snapshot_inventory", "lifecycle_events", "source_health", "exclusion_breakdown"])
def test_plans_stay_in_the_jvm(spark, sf, name):
    shown = plan(Q.QUERIES[name](spark, sf))
    assert "Python" not in shown and "Arrow" not in shown and "CartesianProduct" not in shown
