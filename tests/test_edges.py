"""Queries on tables that leave the shape of the test tables: odd dates, gaps in keys, large and missing values."""

import shutil

import duckdb
import pytest

from larder.plans.catalog import QUERIES
from oracle_check import compare, connect

SF_DIR = "/root/testdata/sf0.001"
NAMES = [
    "daily_sales", "daily_sales_summary", "daily_summary_table", "daily_summary_keys", "daily_net_sales", "calendar_role_join", "calendar_dim", "calendar_iso_fiscal",
    "promo_interval_join", "promo_applicability", "daily_labor", "store_pnl", "schedule_grid", "feedback_by_store",
    "points_running_balance", "dq_foreign_keys", "dq_not_null", "dq_checks", "range_facts", "inventory_running_stock",
    "inventory_transactions", "promo_bridge", "line_price_lookup", "operating_hours_grid",
    "scan_project", "member_lifetime", "order_type_case", "global_minmax", "audit_diff", "promo_stacking",
    "points_expiry", "rewards_redeemable", "price_as_of", "net_hours", "stock_average_cost",
]


@pytest.fixture(scope="module")
def odd_dir(tmp_path_factory):
    """Orders in 1979 and 2081, store keys with gaps, a huge and a missing value, order numbers with gaps."""
    folder = tmp_path_factory.mktemp("odd")
    for table in ("region", "nation", "customer", "part"):
        shutil.copy(f"{SF_DIR}/{table}.parquet", folder / f"{table}.parquet")
    con = duckdb.connect()
    store = "{0} * 10 + 3"
    con.execute(f"""COPY (SELECT * REPLACE ({store.format('s_suppkey')} AS s_suppkey,
        CASE WHEN s_suppkey = 1 THEN 3e12 ELSE s_acctbal END AS s_acctbal) FROM '{SF_DIR}/supplier.parquet')
        TO '{folder}/supplier.parquet'""")
    con.execute(f"""COPY (SELECT * REPLACE ({store.format('l_suppkey')} AS l_suppkey,
        CASE WHEN l_partkey % 50 = 3 THEN l_shipdate - INTERVAL 20 YEAR ELSE l_shipdate END AS l_shipdate)
        FROM '{SF_DIR}/lineitem.parquet') TO '{folder}/lineitem.parquet'""")
    con.execute(f"""COPY (SELECT * REPLACE (CASE WHEN o_orderkey % 50 = 0 THEN TIMESTAMP '1979-03-04'
        WHEN o_orderkey % 50 = 1 THEN TIMESTAMP '2081-05-06' ELSE o_orderdate END AS o_orderdate,
        CASE WHEN o_orderkey = 20 THEN 2e10 ELSE o_totalprice END AS o_totalprice)
        FROM '{SF_DIR}/orders.parquet' WHERE o_orderkey % 13 <> 5) TO '{folder}/orders.parquet'""")
    con.execute(f"""COPY (SELECT * REPLACE (CASE WHEN event_id = 7 THEN 1e11 ELSE value END AS value)
        FROM '{SF_DIR}/events.parquet') TO '{folder}/events.parquet'""")
    return str(folder)


@pytest.fixture(scope="module")
def con(odd_dir):
    con = duckdb.connect()
    for table in ("region", "nation", "customer", "part", "supplier", "lineitem", "orders", "events"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{odd_dir}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_odd_tables(spark, con, odd_dir, name):
    assert compare(QUERIES[name].run(spark, odd_dir), con, QUERIES[name].sql) is None


def test_whole_calendar(spark, odd_dir):
    rows = QUERIES["calendar_dim"].run(spark, odd_dir)
    assert rows.where("CalendarID BETWEEN 1 AND 36891").count() == 36891
    assert rows.where("CalendarID < 1 OR CalendarID > 36891").count() > 400


def test_all_labour_is_kept(spark, odd_dir):
    whole = QUERIES["payroll"].run(spark, odd_dir).agg({"WorkedSeconds": "sum"}).first()[0]
    from larder.plans.sales_queries import daily_labor

    kept = daily_labor(spark, odd_dir).agg({"TotalLaborHours": "sum"}).first()[0]
    assert abs(kept * 3600 - whole) < 1
