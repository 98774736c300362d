"""Every query against its SQL, and plan properties that matter at scale."""

import re

import pytest

import __spark_entry__ as entry
from larder.plans.catalog import QUERIES
from oracle_check import compare, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_its_sql(spark, con, name):
    assert name in entry.oracle_sql()
    problem = compare(entry.queries()[name](spark, SF_DIR), con, QUERIES[name].sql)
    # nothing runs out of stock in the smallest tables
    assert problem is None or (name, problem) == ("reorder_report", "no rows"), problem


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert {"LocationID", "GrossSales", "NetSales", "CostOfGoodsSold"} <= set(df.columns)


# Windows over one partition and joins without a key do not spread over a
# cluster. A single partition that receives partial aggregates is fine.
@pytest.mark.parametrize("name", list(QUERIES))
def test_plan_spreads(spark, name):
    plan = QUERIES[name].run(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            below = re.sub(r"^[\s:+\-*()\d]*", "", lines[i + 1])
            assert below.startswith(("HashAggregate", "ObjectHashAggregate", "LocalTableScan")), plan
    assert "BatchEvalPython" not in plan and "InPandas" not in plan


def test_scans_are_pruned_and_filters_pushed(spark):
    def scans(name):
        plan = QUERIES[name].run(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
        return re.findall(r"ReadSchema: struct<([^>]*)>", plan), plan

    columns, _ = scans("daily_sales")
    assert sorted(columns) == sorted(
        ["o_orderkey:bigint,o_orderdate:timestamp_ntz",
         "l_orderkey:bigint,l_suppkey:bigint,l_extendedprice:double"]
    )
    _, plan = scans("partitioned_year_prune")
    assert re.search(r"PartitionFilters: \[isnotnull\(Year#\d+\), \(Year#\d+ = 1997\)\]", plan)
    _, plan = scans("active_only_semi")
    assert "LessThanOrEqual(p_size,40)" in plan


@pytest.mark.parametrize(
    "name",
    ["hours_worked", "payroll", "promo_applicability", "daily_sales", "points_running_balance",
     "calendar_dim", "partitioned_year_prune"],
)
def test_results_do_not_depend_on_the_time_zone(spark, con, name):
    zone = "spark.sql.session.timeZone"
    before = spark.conf.get(zone)
    spark.conf.set(zone, "America/New_York")
    try:
        assert compare(QUERIES[name].run(spark, SF_DIR), con, QUERIES[name].sql) is None
    finally:
        spark.conf.set(zone, before)
