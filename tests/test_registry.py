"""Every registered query against its SQL, on the smallest tables, and what its plan must not contain."""

import os

import pytest

import __spark_entry__ as entry
from coursemill.registry.book import CHECKS, QUERIES
from tests.conftest import plan
from tools.check_queries import TABLES, bag

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are absent")


@pytest.fixture(scope="module")
def con():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(CHECKS)
    assert set(QUERIES) <= set(entry.queries()) and set(CHECKS) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, con, name):
    df = entry.queries()[name](spark, SF)
    got = bag([tuple(r) for r in df.collect()], df.columns)
    cur = con.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(columns)
    assert got == bag(cur.fetchall(), columns)


def test_no_plan_pairs_rows_without_an_equality(spark):
    """Without automatic broadcasts every join must still have an equality to shuffle on."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name, run in QUERIES.items():
            if name.startswith("stream_"):
                continue
            text = plan(run(spark, SF))
            assert "CartesianProduct" not in text and "NestedLoop" not in text, name
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
