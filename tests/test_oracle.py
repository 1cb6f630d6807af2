"""Every registered query against its DuckDB oracle on the smallest driver data."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from tillroll.plans import ORACLE, QUERIES
from tests.test_plans import assert_plan_is_scalable
from tools.oracle_check import TABLES, digest

SF = os.environ.get("TILLROLL_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["transaction_id", "customer_id", "t_dat", "items", "item_count"]


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, key):
    """Same values as DuckDB, and no cross join / nested-loop join / Python
    UDF anywhere in the physical plan."""
    df = QUERIES[key](spark, SF)
    assert_plan_is_scalable(key, df)
    got = digest(df.toPandas())
    want = digest(con.execute(ORACLE[key]).df())
    assert got == want
