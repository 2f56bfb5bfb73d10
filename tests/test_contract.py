"""Every registered query against its SQL in DuckDB on the smallest tables."""

import os
import sys

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tools")]

import __spark_entry__ as contract  # noqa: E402
import check  # noqa: E402
from haulmark.plans import registry  # noqa: E402

#: Compared with brute force in test_articles.
BRUTE_FORCE = {"similar_titles", "review_candidates", "assigned_duplicates"}

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no generated tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.sql("SET TimeZone='UTC'")
    for t in check.TABLES.split():
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def test_every_sql_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query_equals_sql(spark, duck, name):
    df = contract.queries()[name](spark, SF)
    got = check.rows(df.columns, [tuple(r) for r in df.collect()])
    sql = contract.oracle_sql().get(name)
    if sql is None:
        assert name in BRUTE_FORCE or name not in registry.load().queries, "a query without SQL needs a brute-force test"
        return
    res = duck.sql(sql)
    assert sorted(df.columns) == sorted(res.columns)
    assert got == check.rows(res.columns, res.fetchall())
