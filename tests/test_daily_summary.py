"""The daily summary where store days are hot, and what it shuffles."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from larder.operators import ranges, sales

MONEY = "decimal(28,2)"


def store_orders(spark):
    """Two store days with most of the orders, amounts wider than 18 digits, and NULL in every column but the order."""
    plain = spark.range(4000).select(
        F.col("id").alias("OrderID"), F.when(F.col("id") % 50 > 0, F.when(F.col("id") % 3 > 0, 3).otherwise(F.col("id") % 90)).alias("LocationID"),
        F.when(F.col("id") % 70 > 0, F.when(F.col("id") % 3 > 0, 8 + F.col("id") % 2).otherwise(F.col("id") % 11)).cast("int").alias("OrderDateID"),
        F.when(F.col("id") % 5 > 0, F.col("id") % 40).alias("MemberID"),
        F.when(F.col("id") % 13 > 0, F.col("id") % 8).cast("int").alias("ChannelID"),
        F.get(F.array(*map(F.lit, ["Cash", "CreditCard", "MobileWallet", "Voucher"])), (F.col("id") % 4).cast("int")).alias("PaymentMethod"),
    )
    plain = plain.withColumn("PaymentMethod", F.when(F.col("OrderID") % 17 > 0, F.col("PaymentMethod")))
    amount = lambda k: F.when(F.col("OrderID") % 19 != k, F.when(F.col("OrderID") % 1999 == k, F.lit(Decimal("12345678901234567890.12"))).otherwise(F.col("OrderID") * k + 0.25))
    return plain.withColumns({name: amount(k).cast(MONEY) for k, name in enumerate(["Gross", "Discount", "Refund", "Quantity", "Cost"])})


@pytest.fixture
def labor(spark):
    return spark.createDataFrame([(3, 8, 2.5, 10)], "LocationID bigint, OrderDateID int, TotalLaborHours double, TotalLaborCost int")


def rows_of(df):
    return sorted((tuple(sorted(r.asDict().items())) for r in df.collect()), key=str)


def test_hot_store_days_change_no_row(spark, labor, monkeypatch):
    orders = store_orders(spark)
    monkeypatch.setattr(ranges, "RANGE_ROWS", 100)
    hot = sales.hot_store_days(ranges.sample_of(orders), orders.select("OrderID", "OrderDateID"))
    assert {(3, 8), (3, 9)} <= {tuple(r) for r in hot.collect()}
    cold = rows_of(sales.daily_summary(orders, labor))
    assert rows_of(sales.daily_summary(orders, labor, hot)) == cold
    want = {
        (r[0], r[1]): tuple(r)[2:]
        for r in orders.groupBy("LocationID", "OrderDateID").agg(
            F.count("*"), F.count_distinct("MemberID"), F.sum("Gross"), F.sum("Discount"), F.sum("Cost"),
            F.sum(F.when(F.col("ChannelID").isin(3, 4), F.col("Gross")).otherwise(0)), F.sum(F.when(F.col("PaymentMethod") == "CreditCard", F.col("Gross")).otherwise(0)),
        ).collect()
    }
    names = ["TotalOrders", "TotalCustomers", "GrossSales", "Discounts", "CostOfGoodsSold", "OnlineSales", "CardPayments"]
    got = {(dict(r)["LocationID"], dict(r)["OrderDateID"]): tuple(dict(r)[n] for n in names) for r in cold}
    assert got == want


def test_no_hot_store_day(spark):
    orders = store_orders(spark)
    assert sales.hot_store_days(ranges.sample_of(orders.limit(10)), orders.select("OrderID", "OrderDateID")) is None


def test_store_orders_are_shuffled_once(spark, labor):
    plan = sales.daily_summary(store_orders(spark), labor.limit(0))._jdf.queryExecution().executedPlan().toString().splitlines()
    by_day = [line for line in plan if "Exchange hashpartitioning(LocationID" in line and "MemberID" in line]
    assert not by_day and sum("REPARTITION_BY_COL" in line for line in plan) == 1
