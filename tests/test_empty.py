"""Every query on tables without rows."""

import duckdb
import pytest

from larder.plans.catalog import QUERIES
from oracle_check import TABLES, compare, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def empty_dir(tmp_path_factory):
    folder = tmp_path_factory.mktemp("empty")
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"COPY (SELECT * FROM '{SF_DIR}/{table}.parquet' LIMIT 0) TO '{folder}/{table}.parquet'")
    return str(folder)


@pytest.mark.parametrize("name", QUERIES)
def test_empty_tables(spark, empty_dir, name):
    found = compare(QUERIES[name].run(spark, empty_dir), connect(empty_dir), QUERIES[name].sql)
    assert found in (None, "no rows")
