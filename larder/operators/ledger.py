"""Ledger entries and store profit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Entry type, account, and the priced-order column it books.
ENTRIES = [
    ("Revenue", "4000", "SubtotalAmount"),
    ("Tax", "2200", "TaxAmount"),
    ("Discount", "4900", "DiscountAmount"),
    ("Payment", "1000", "TotalAmount"),
    ("Refund", "4950", "RefundAmount"),
]


def ledger(priced: DataFrame) -> DataFrame:
    """One entry per order and entry type; amounts of zero are not booked."""
    entries = F.array(
        *[
            F.struct(
                F.lit(kind).alias("EntryType"),
                F.lit(account).alias("GLAccount"),
                F.col(column).cast("decimal(24,2)").alias("Amount"),
            )
            for kind, account, column in ENTRIES
        ]
    )
    return priced.select(
        "OrderID", F.col("OrderDateID").alias("LedgerDateID"), F.inline(entries)
    ).where(F.col("Amount") != 0)


def store_profit(lines: DataFrame, labor: DataFrame, expenses: DataFrame) -> DataFrame:
    """Net sales less cost of goods, labour and expenses, per store.

    Every input is summed per store before the joins, so they meet one row per
    store each. Pass the lines of known orders, which the daily reports count.
    """
    sales = lines.groupBy("LocationID").agg(
        F.sum(F.col("Gross") - F.col("Discount") - F.col("Refund")).alias("NetSales"),
        F.sum("Cost").alias("CostOfGoodsSold"),
    )
    wages = labor.groupBy("LocationID").agg(F.sum("TotalLaborCost").alias("TotalLaborCost"))
    costs = expenses.groupBy("LocationID").agg(F.sum("Amount").alias("Expenses"))
    return (
        sales.join(wages, "LocationID", "left")
        .join(costs, "LocationID", "left")
        .withColumns({c: F.coalesce(c, F.lit(0)) for c in ("TotalLaborCost", "Expenses")})
        .withColumn(
            "Profit",
            F.col("NetSales")
            - F.col("CostOfGoodsSold")
            - F.col("TotalLaborCost")
            - F.col("Expenses"),
        )
    )
