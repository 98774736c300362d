"""Queries on orders, lines and the daily store summary."""

from __future__ import annotations

from pyspark.sql import functions as F

from larder.catalog.constraints import UNIQUE_PAIRS
from larder.operators import inventory, labor, quality, sales
from larder.operators.ranges import sample_of
from larder.operators.surrogate import assign_round_robin
from larder.plans import oracle as o
from larder.plans.registry import query
from larder.sources import retail


def costed_lines(spark, sf_dir):
    costs = inventory.item_costs(retail.items(spark, sf_dir))
    return sales.with_cost(retail.order_lines(spark, sf_dir), costs)


def _dated_orders(spark, sf_dir, attributes):
    return retail.orders(spark, sf_dir).select("OrderID", "OrderDateID", *attributes)


def store_orders(spark, sf_dir, *attributes):
    """Store orders with the date and the named attributes of their order."""
    lines = retail.order_lines(spark, sf_dir)
    return sales.store_orders(lines, _dated_orders(spark, sf_dir, attributes))


def dated_lines(spark, sf_dir, *attributes, cost=False):
    """Lines with the date and the named attributes of their order."""
    lines = costed_lines(spark, sf_dir) if cost else retail.order_lines(spark, sf_dir)
    return sales.dated_lines(lines, _dated_orders(spark, sf_dir, attributes))


def employees(spark, sf_dir):
    """The users of the time clock, dealt to the stores by position, and a rate."""
    people = retail.punches(spark, sf_dir).select("EmployeeID").distinct()
    stores = retail.locations(spark, sf_dir)
    dealt = assign_round_robin(people, F.col("EmployeeID"), stores, "LocationID", "LocationID")
    return labor.with_rates(dealt)


def shifts(spark, sf_dir, years_back=retail.SHIFT_YEARS_BACK):
    return labor.shifts(retail.punches(spark, sf_dir), years_back)


def daily_labor(spark, sf_dir):
    return labor.daily_labor(shifts(spark, sf_dir), employees(spark, sf_dir))


def daily_customers(spark, sf_dir):
    return sales.daily_customers(store_orders(spark, sf_dir, "MemberID"))


@query(
    "daily_sales",
    f"""WITH {o.STORE_ORDERS}
    SELECT LocationID, OrderDateID, CAST(OrderDate AS VARCHAR) AS CalendarDate,
           CAST(year(OrderDate) AS INTEGER) AS Year, count(*) AS TotalOrders,
           CAST(sum(Gross) AS DOUBLE) AS GrossSales,
           CAST(round(sum(Gross) * CAST(0.07 AS DECIMAL(3,2)), 2) AS DOUBLE) AS TaxCollected,
           CAST(sum(Gross) AS DOUBLE) / count(*) AS AverageOrderValue
    FROM store_orders GROUP BY LocationID, OrderDateID, OrderDate""",
)
def _daily_sales(spark, sf_dir):
    return sales.daily_sales(store_orders(spark, sf_dir))


@query(
    "daily_customers",
    f"""WITH {o.STORE_ORDERS}
    SELECT LocationID, OrderDateID, count(*) AS TotalOrders,
           count(DISTINCT MemberID) AS TotalCustomers
    FROM store_orders GROUP BY LocationID, OrderDateID""",
)
def _daily_customers(spark, sf_dir):
    return daily_customers(spark, sf_dir)


_PIVOT = """
    CAST(sum(CASE WHEN ChannelID IN (1, 5) THEN Gross ELSE 0 END) AS DOUBLE) AS InStoreSales,
    CAST(sum(CASE WHEN ChannelID = 2 THEN Gross ELSE 0 END) AS DOUBLE) AS DriveThruSales,
    CAST(sum(CASE WHEN ChannelID IN (3, 4) THEN Gross ELSE 0 END) AS DOUBLE) AS OnlineSales,
    CAST(sum(CASE WHEN ChannelID = 6 THEN Gross ELSE 0 END) AS DOUBLE) AS DeliverySales,
    CAST(sum(CASE WHEN PaymentMethod = 'Cash' THEN Gross ELSE 0 END) AS DOUBLE) AS CashPayments,
    CAST(sum(CASE WHEN PaymentMethod = 'CreditCard' THEN Gross ELSE 0 END) AS DOUBLE)
      AS CardPayments,
    CAST(sum(CASE WHEN PaymentMethod = 'MobileWallet' THEN Gross ELSE 0 END) AS DOUBLE)
      AS MobilePayments"""


@query(
    "daily_channel_pivot",
    f"""WITH {o.STORE_ORDERS}
    SELECT LocationID, OrderDateID, {_PIVOT}
    FROM store_orders GROUP BY LocationID, OrderDateID""",
)
def _daily_channel_pivot(spark, sf_dir):
    return sales.daily_channel_pivot(dated_lines(spark, sf_dir, "ChannelID", "PaymentMethod"))


@query(
    "daily_net_sales",
    f"""WITH {o.STORE_ORDERS}
    SELECT LocationID, OrderDateID, CAST(sum(Gross) AS DOUBLE) AS GrossSales,
           CAST(sum(Discount) AS DOUBLE) AS Discounts, CAST(sum(Refund) AS DOUBLE) AS Refunds,
           CAST(sum(Gross) - sum(Discount) - sum(Refund) AS DOUBLE) AS NetSales
    FROM store_orders GROUP BY LocationID, OrderDateID""",
)
def _daily_net_sales(spark, sf_dir):
    return sales.daily_net_sales(dated_lines(spark, sf_dir))


@query(
    "daily_basket_size",
    f"""WITH {o.STORE_ORDERS}
    SELECT LocationID, OrderDateID, count(*) AS TotalOrders,
           CAST(sum(Quantity) AS DOUBLE) AS Items,
           CAST(sum(Quantity) AS DOUBLE) / count(*) AS AverageItemsPerOrder
    FROM store_orders GROUP BY LocationID, OrderDateID""",
)
def _daily_basket_size(spark, sf_dir):
    return sales.daily_basket_size(store_orders(spark, sf_dir))


_LABOR_JOIN = f"""
    coalesce(CAST(b.Seconds AS DOUBLE) / 3600.0, 0) AS TotalLaborHours,
    coalesce({o.pay('b.CostSeconds', '1')}, 0) AS TotalLaborCost"""


@query(
    "daily_labor",
    f"""WITH {o.STORE_ORDERS}, {o.LABOR}, days AS (
      SELECT DISTINCT LocationID, OrderDateID FROM store_orders)
    SELECT d.LocationID, d.OrderDateID, {_LABOR_JOIN}
    FROM days d LEFT JOIN labor b USING (LocationID, OrderDateID)""",
)
def _daily_labor(spark, sf_dir):
    days = store_orders(spark, sf_dir).select(*sales.STORE_DAY).distinct()
    return (
        days.join(daily_labor(spark, sf_dir), sales.STORE_DAY, "left")
        .withColumn("TotalLaborHours", F.coalesce("TotalLaborHours", F.lit(0.0)))
        .withColumn("TotalLaborCost", F.coalesce("TotalLaborCost", F.lit(0)))
    )


@query(
    "daily_cogs",
    f"""WITH {o.ORDERS}, {o.LINES}, {o.RECIPES}, {o.COGS}
    SELECT LocationID, OrderDateID, CAST(CostOfGoodsSold AS DOUBLE) AS CostOfGoodsSold
    FROM cogs""",
)
def _daily_cogs(spark, sf_dir):
    return sales.daily_cogs(dated_lines(spark, sf_dir, cost=True))


_SUMMARY = f"""WITH {o.STORE_ORDERS}, {o.RECIPES}, {o.COGS}, {o.LABOR}, daily AS (
  SELECT LocationID, OrderDateID, OrderDate, count(*) AS TotalOrders,
         count(DISTINCT MemberID) AS TotalCustomers, sum(Gross) AS Gross,
         sum(Discount) AS Discounts, sum(Refund) AS Refunds, sum(Quantity) AS Items, {_PIVOT}
  FROM store_orders GROUP BY LocationID, OrderDateID, OrderDate)
SELECT LocationID, OrderDateID, CAST(OrderDate AS VARCHAR) AS CalendarDate,
       CAST(year(OrderDate) AS INTEGER) AS Year, TotalOrders, TotalCustomers,
       CAST(Gross AS DOUBLE) AS GrossSales, CAST(Discounts AS DOUBLE) AS Discounts,
       CAST(Refunds AS DOUBLE) AS Refunds,
       CAST(Gross - Discounts - Refunds AS DOUBLE) AS NetSales,
       CAST(round(Gross * CAST(0.07 AS DECIMAL(3,2)), 2) AS DOUBLE) AS TaxCollected,
       InStoreSales, DriveThruSales, OnlineSales, DeliverySales, CashPayments, CardPayments,
       MobilePayments, {_LABOR_JOIN},
       CAST(coalesce(c.CostOfGoodsSold, 0) AS DOUBLE) AS CostOfGoodsSold,
       CAST(Gross AS DOUBLE) / TotalOrders AS AverageOrderValue,
       CAST(Items AS DOUBLE) / TotalOrders AS AverageItemsPerOrder, 0 AS IsReconciled
FROM daily LEFT JOIN labor b USING (LocationID, OrderDateID)
LEFT JOIN cogs c USING (LocationID, OrderDateID)"""


@query("daily_sales_summary", _SUMMARY)
def daily_sales_summary(spark, sf_dir):
    orders = _dated_orders(spark, sf_dir, ("MemberID", "ChannelID", "PaymentMethod"))
    hot = sales.hot_store_days(sample_of(retail.order_lines(spark, sf_dir).select("OrderID", "LocationID")), orders)
    lines = sales.with_unit_cost(retail.order_lines(spark, sf_dir), inventory.item_costs(retail.items(spark, sf_dir)))
    return sales.daily_summary(sales.store_orders(lines, orders, sales.line_cost()), daily_labor(spark, sf_dir), hot)


@query(
    "daily_summary_table",
    f"""SELECT CAST(OrderDateID AS BIGINT) * {sales.LOCATIONS} + LocationID AS SummaryID, OrderDateID AS SalesDateID,
      * EXCLUDE (OrderDateID, CalendarDate, Year) FROM ({_SUMMARY})""",
)
def _daily_summary_table(spark, sf_dir):
    return sales.summary_rows(daily_sales_summary(spark, sf_dir))


@query(
    "daily_summary_keys",
    f"""WITH summary AS (SELECT LocationID, OrderDateID FROM ({_SUMMARY}))
    SELECT 'finance.DailySalesSummary' AS TableName, KeyColumns, count(Key) AS CheckedRows, count(DISTINCT Key) AS DistinctKeys,
           count(DISTINCT CASE WHEN Copies > 1 THEN Key END) AS DuplicatedKeys
    FROM (VALUES ('LocationID,SalesDateID'), ('SummaryID')) k(KeyColumns) LEFT JOIN (
      SELECT KeyColumns, Key, count(*) OVER (PARTITION BY KeyColumns, Key) AS Copies FROM (
        SELECT 'LocationID,SalesDateID' AS KeyColumns, concat(LocationID, ' ', OrderDateID) AS Key FROM summary
        UNION ALL SELECT 'SummaryID', CAST(CAST(OrderDateID AS BIGINT) * {sales.LOCATIONS} + LocationID AS VARCHAR) FROM summary)) USING (KeyColumns)
    GROUP BY KeyColumns""",
)
def _daily_summary_keys(spark, sf_dir):
    """Whether the stored summary keeps its declared keys, from the rows it is made of."""
    table = "finance.DailySalesSummary"
    rows = sales.summary_rows(daily_sales_summary(spark, sf_dir))
    return quality.union_all([quality.check_unique(rows, table, key) for key in (list(UNIQUE_PAIRS[table]), ["SummaryID"])])
