"""The driver's order, part, customer and event tables seen as franchise entities.

Stores are suppliers, menu items are parts, members are customers, and an
order's store is the supplier of its line. Amounts become DECIMAL here, before
any arithmetic.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.functions.dates import date_id
from larder.functions.money import amount, from_units, hundredths

# Shifts are dated this many years back, into the period of the orders.
SHIFT_YEARS_BACK = 27
RUN_TIME = dt.datetime(2024, 2, 1)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_type(order_id: Column) -> Column:
    """The order type cycles with the order number."""
    kind = order_id % 4
    return (
        F.when(kind == 0, "Delivery")
        .when(kind == 1, "DineIn")
        .when(kind == 2, "Takeout")
        .otherwise("DriveThru")
    )


def payment_method(order_id: Column) -> Column:
    """The payment method cycles with the order number."""
    kind = order_id % 3
    return F.when(kind == 0, "Cash").when(kind == 1, "CreditCard").otherwise("MobileWallet")


def channel_id(priority: Column) -> Column:
    """Channel of an order from the digit of its priority; the lowest goes to the last channel."""
    digit = F.substring(priority, 1, 1).try_cast("int")
    return F.when(digit == 5, 6).otherwise(digit)


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    return read(spark, sf_dir, "orders").select(
        key.alias("OrderID"),
        F.col("o_custkey").alias("MemberID"),
        date_id(F.to_date("o_orderdate")).alias("OrderDateID"),
        channel_id(F.col("o_orderpriority")).alias("ChannelID"),
        order_type(key).alias("OrderType"),
        payment_method(key).alias("PaymentMethod"),
        F.col("o_orderstatus").alias("OrderStatus"),
        (key * 37 % 86400).cast("int").alias("OrderSecond"),
        amount("o_totalprice", 18).alias("StatedTotal"),
    )


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with exact amounts; price, discount and tax hold two decimals each."""
    cents = hundredths("l_extendedprice")
    refunded = F.when(F.col("l_returnflag") == "R", cents).otherwise(0)
    return read(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("OrderID"),
        F.col("l_linenumber").alias("LineNumber"),
        F.col("l_suppkey").alias("LocationID"),
        F.col("l_partkey").alias("ItemID"),
        from_units(hundredths("l_quantity"), 2).alias("Quantity"),
        from_units(cents, 2).alias("Gross"),
        from_units(cents * hundredths("l_discount"), 4).alias("Discount"),
        from_units(cents * hundredths("l_tax"), 4).alias("LineTax"),
        from_units(refunded, 2).alias("Refund"),
        date_id(F.to_date("l_shipdate")).alias("ShipDateID"),
    )


def locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("LocationID"),
        F.col("s_name").alias("StoreName"),
        F.col("s_nationkey").alias("NationID"),
        amount("s_acctbal", 18).alias("Balance"),
    )


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("MemberID"),
        F.col("c_name").alias("MemberName"),
        F.col("c_nationkey").alias("NationID"),
        F.col("c_mktsegment").alias("Segment"),
        amount("c_acctbal", 18).alias("Balance"),
    )


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("ItemID"),
        F.col("p_name").alias("ItemName"),
        F.col("p_type").alias("Category"),
        F.col("p_size").alias("Size"),
        amount("p_retailprice").alias("BasePrice"),
    )


def punches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event of a user is a reading of the time clock."""
    return read(spark, sf_dir, "events").select(
        F.col("user_id").alias("EmployeeID"), F.col("ts").alias("PunchTime")
    )


def points_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole points per event: purchases, views and sign-ups earn, the rest redeems."""
    points = F.floor(amount("value", 18)).cast("bigint")
    earns = F.col("event_type").isin("purchase", "view", "signup")
    return read(spark, sf_dir, "events").select(
        F.col("event_id").alias("TransactionID"),
        F.col("user_id").alias("MemberID"),
        F.col("ts").alias("TransactionTime"),
        date_id(F.to_date("ts")).alias("TransactionDateID"),
        F.when(earns, "Earned").otherwise("Redeemed").alias("TransactionType"),
        F.when(earns, points).otherwise(-points).alias("Points"),
    )


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The views among the events, whose value is what the member thinks of the order."""
    return read(spark, sf_dir, "events").where(F.col("event_type") == "view").select(
        F.col("event_id").alias("FeedbackID"), F.col("user_id").alias("MemberID"), F.col("value").alias("Value")
    )


def store_expenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a store owes: its account balance, where that is positive."""
    return locations(spark, sf_dir).select(
        "LocationID", F.greatest(F.col("Balance"), amount(F.lit(0))).alias("Amount")
    )
