import duckdb
import pytest
from helpers import SF

import __spark_entry__ as entry
from check import TABLES, compare


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query_matches_its_sql(spark, con, name):
    verdict = compare(spark, con, SF, name)
    assert not verdict.startswith("FAIL"), verdict


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
