"""Queries on tables in which one key holds a third of the rows or more."""

import shutil

import duckdb
import pytest

from larder.plans.catalog import QUERIES
from oracle_check import compare, connect

SF_DIR = "/root/testdata/sf0.001"
SPLIT_SOON = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2.0",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
    # a skewed partition is split by the tasks that wrote it, so there must be several
    "spark.sql.files.maxPartitionBytes": "64k",
    "spark.sql.files.openCostInBytes": "1k",
}
NAMES = [
    "daily_sales", "daily_customers", "daily_channel_pivot", "daily_sales_summary", "daily_cogs",
    "inventory_transactions", "order_pricing", "line_price_lookup", "recipe_explosion", "inventory_running_stock",
    "promo_applicability", "points_running_balance", "payroll", "member_lifetime",
    "feedback_by_store", "dq_foreign_keys", "dq_unique", "calendar_role_join", "surrogate_key",
    "payment_transactions", "store_pnl", "distinct_keys", "ledger_unpivot", "region_counts",
    "points_expiry", "rewards_redeemable", "price_as_of", "net_hours", "hierarchy_rollup", "audit_diff", "promo_stacking", "customers_rollup",
]


@pytest.fixture(scope="module")
def skewed_dir(tmp_path_factory):
    """The smallest tables, with hot orders, stores, items, members and users."""
    folder = tmp_path_factory.mktemp("skewed")
    for table in ("region", "nation", "customer", "supplier", "part"):
        shutil.copy(f"{SF_DIR}/{table}.parquet", folder / f"{table}.parquet")
    con = duckdb.connect()
    con.execute(f"""COPY (SELECT CASE WHEN row_number() OVER () % 3 = 0 THEN 5 ELSE l_orderkey END
        AS l_orderkey, CASE WHEN row_number() OVER () % 3 = 1 THEN 7 ELSE l_partkey END AS l_partkey,
        CASE WHEN row_number() OVER () % 2 = 1 THEN 3 ELSE l_suppkey END AS l_suppkey,
        * EXCLUDE (l_orderkey, l_partkey, l_suppkey)
        FROM '{SF_DIR}/lineitem.parquet', range(4))
        TO '{folder}/lineitem.parquet' (ROW_GROUP_SIZE 4096)""")
    con.execute(f"""COPY (SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 11 ELSE o_custkey END
        AS o_custkey, CASE WHEN o_orderkey % 5 < 2 THEN TIMESTAMP '1997-07-04' ELSE o_orderdate END
        AS o_orderdate) FROM '{SF_DIR}/orders.parquet')
        TO '{folder}/orders.parquet' (ROW_GROUP_SIZE 512)""")
    con.execute(f"""COPY (SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN 2 ELSE user_id END
        AS user_id) FROM '{SF_DIR}/events.parquet') TO '{folder}/events.parquet'""")
    return str(folder)


@pytest.fixture(scope="module")
def split_soon(spark):
    before = {name: spark.conf.get(name, None) for name in SPLIT_SOON}
    for name, value in SPLIT_SOON.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@pytest.mark.parametrize("name", NAMES)
def test_results_hold_under_skew(spark, skewed_dir, split_soon, name):
    df = QUERIES[name].run(spark, skewed_dir)
    assert compare(df, connect(skewed_dir), QUERIES[name].sql) is None


def test_a_hot_order_is_split_over_tasks(spark, skewed_dir, split_soon):
    df = QUERIES["daily_sales"].run(spark, skewed_dir)
    df.collect()
    assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
