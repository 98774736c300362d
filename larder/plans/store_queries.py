"""Queries on order details, staff, stock, promotions and loyalty."""

from __future__ import annotations

from pyspark.sql import functions as F

from larder.functions.money import amount
from larder.functions.recipes import INGREDIENTS
from larder.operators import hierarchy, inventory, labor, ledger, loyalty, promo, sales
from larder.operators.ranges import sample_of
from larder.plans import campaigns as c
from larder.plans import oracle as o
from larder.plans.registry import query
from larder.plans.sales_queries import (
    daily_labor,
    dated_lines,
    employees,
    shifts,
    store_orders,
)
from larder.sources import retail

# --- orders and lines ---------------------------------------------------------


@query(
    "order_type_case",
    f"""WITH {o.ORDERS}
    SELECT OrderType, PaymentMethod, count(*) AS Orders,
           CAST(sum(StatedTotal) AS DOUBLE) AS TotalAmount
    FROM ord GROUP BY OrderType, PaymentMethod""",
)
def _order_type_case(spark, sf_dir):
    return (
        retail.orders(spark, sf_dir)
        .groupBy("OrderType", "PaymentMethod")
        .agg(F.count("*").alias("Orders"), F.sum("StatedTotal").alias("TotalAmount"))
    )


PRICED = f"""{o.ORDERS}, {o.LINES}, sums AS (
  SELECT OrderID, sum(Gross) AS g, sum(Discount) AS d, sum(Refund) AS r
  FROM lines GROUP BY OrderID),
priced AS (
  SELECT o.OrderID, o.OrderDateID, o.OrderType, o.PaymentMethod, o.MemberID,
         coalesce(g, 0) AS SubtotalAmount, round(coalesce(d, 0), 2) AS DiscountAmount,
         coalesce(r, 0) AS RefundAmount,
         round(coalesce(g, 0) * CAST(0.07 AS DECIMAL(3,2)), 2) AS TaxAmount,
         CASE WHEN o.OrderType = 'Delivery' THEN CAST(3.99 AS DECIMAL(3,2)) ELSE 0 END
           AS DeliveryFee,
         CAST(o.OrderID % 10 AS DECIMAL(4,0)) * CAST(0.5 AS DECIMAL(2,1)) AS TipAmount
  FROM ord o LEFT JOIN sums s USING (OrderID)),
totals AS (
  SELECT *, SubtotalAmount + TaxAmount + DeliveryFee + TipAmount - DiscountAmount AS TotalAmount
  FROM priced)"""


def priced_orders(spark, sf_dir):
    return sales.order_pricing(retail.orders(spark, sf_dir), retail.order_lines(spark, sf_dir))


@query(
    "order_pricing",
    f"""WITH {PRICED}
    SELECT OrderID, OrderDateID, MemberID, CAST(SubtotalAmount AS DOUBLE) AS SubtotalAmount,
           CAST(DiscountAmount AS DOUBLE) AS DiscountAmount, CAST(TaxAmount AS DOUBLE) AS TaxAmount,
           CAST(DeliveryFee AS DOUBLE) AS DeliveryFee, CAST(TipAmount AS DOUBLE) AS TipAmount,
           CAST(TotalAmount AS DOUBLE) AS TotalAmount,
           CAST(floor(SubtotalAmount) AS BIGINT) AS LoyaltyPointsEarned, 'Paid' AS PaymentStatus,
           CAST(NULL AS INTEGER) AS PromotionID
    FROM totals""",
)
def _order_pricing(spark, sf_dir):
    return priced_orders(spark, sf_dir).select(
        "OrderID", "OrderDateID", "MemberID", "SubtotalAmount", "DiscountAmount", "TaxAmount",
        "DeliveryFee", "TipAmount", "TotalAmount", "LoyaltyPointsEarned", "PaymentStatus",
        "PromotionID",
    )


@query(
    "order_items_explode",
    f"""WITH {o.LINES}
    SELECT OrderID, LineNumber, LocationID, ItemID, 'Sale' AS Movement,
           CAST(-Quantity AS DOUBLE) AS Units FROM lines
    UNION ALL SELECT OrderID, LineNumber, LocationID, ItemID, 'Return', CAST(Quantity AS DOUBLE)
      FROM lines WHERE Refund > 0""",
)
def _order_items_explode(spark, sf_dir):
    return sales.line_movements(retail.order_lines(spark, sf_dir))


_ACTIVE_SIZE = 40


def active_items(spark, sf_dir):
    """Items on the current menu; the larger sizes have been taken off it."""
    return retail.items(spark, sf_dir).where(F.col("Size") <= _ACTIVE_SIZE)


@query(
    "line_price_lookup",
    f"""WITH {o.LINES}
    SELECT OrderID, LineNumber, ItemID, CAST(Quantity AS DOUBLE) AS Quantity,
           CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS DOUBLE) AS UnitPrice,
           CAST(round(Quantity * CAST(p_retailprice AS DECIMAL(12,2)), 2) AS DOUBLE) AS LineTotal
    FROM lines LEFT JOIN part ON ItemID = p_partkey""",
)
def _line_price_lookup(spark, sf_dir):
    lines = retail.order_lines(spark, sf_dir).select("OrderID", "LineNumber", "ItemID", "Quantity")
    return sales.price_lines(lines, retail.items(spark, sf_dir))


@query(
    "active_only_semi",
    f"""WITH {o.LINES}
    SELECT LocationID, count(*) AS ActiveLines, CAST(sum(Gross) AS DOUBLE) AS ActiveGross
    FROM lines
    WHERE ItemID IN (SELECT p_partkey FROM part WHERE p_size <= {_ACTIVE_SIZE})
      AND LocationID IN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0)
    GROUP BY LocationID""",
)
def _active_only_semi(spark, sf_dir):
    active_stores = retail.locations(spark, sf_dir).where(F.col("Balance") >= 0)
    return (
        retail.order_lines(spark, sf_dir)
        .join(active_stores, "LocationID", "left_semi")
        .join(active_items(spark, sf_dir), "ItemID", "left_semi")
        .groupBy("LocationID")
        .agg(F.count("*").alias("ActiveLines"), F.sum("Gross").alias("ActiveGross"))
    )


@query(
    "payment_transactions",
    f"""WITH {PRICED}
    SELECT row_number() OVER (ORDER BY OrderID) AS PaymentTransactionID, OrderID,
           OrderDateID AS PaymentDateID, PaymentMethod, CAST(TotalAmount AS DOUBLE) AS Amount,
           'Payment' AS TransactionType, 'Success' AS TransactionStatus
    FROM totals""",
)
def _payment_transactions(spark, sf_dir):
    return sales.payments(priced_orders(spark, sf_dir))


@query(
    "order_receipts",
    f"""WITH {o.ORDERS}
    SELECT row_number() OVER (ORDER BY OrderID) AS ReceiptID, OrderID,
           OrderDateID AS ReceiptDateID, 0 AS IsReprint FROM ord""",
)
def _order_receipts(spark, sf_dir):
    return sales.receipts(retail.orders(spark, sf_dir))


@query(
    "ledger_unpivot",
    f"""WITH {PRICED}, entries AS (
      SELECT OrderID, OrderDateID AS LedgerDateID, 'Revenue' AS EntryType, '4000' AS GLAccount,
             CAST(SubtotalAmount AS DOUBLE) AS Amount FROM totals
      UNION ALL SELECT OrderID, OrderDateID, 'Tax', '2200', CAST(TaxAmount AS DOUBLE) FROM totals
      UNION ALL SELECT OrderID, OrderDateID, 'Discount', '4900', CAST(DiscountAmount AS DOUBLE)
        FROM totals
      UNION ALL SELECT OrderID, OrderDateID, 'Payment', '1000', CAST(TotalAmount AS DOUBLE)
        FROM totals
      UNION ALL SELECT OrderID, OrderDateID, 'Refund', '4950', CAST(RefundAmount AS DOUBLE)
        FROM totals)
    SELECT * FROM entries WHERE Amount <> 0""",
)
def _ledger_unpivot(spark, sf_dir):
    return ledger.ledger(priced_orders(spark, sf_dir))


# --- staff --------------------------------------------------------------------


@query(
    "hours_worked",
    f"""WITH {o.SHIFTS}
    SELECT EmployeeID, ClockInDateID, CAST(ClockOutTime IS NULL AS INTEGER) AS IsOpen,
           date_diff('minute', ClockInTime, coalesce(ClockOutTime, {o.RUN_TIMESTAMP}))
             AS TotalMinutes,
           CAST(date_diff('minute', ClockInTime, coalesce(ClockOutTime, {o.RUN_TIMESTAMP}))
                AS DOUBLE) / 60.0 AS TotalHoursWorked
    FROM shifts""",
)
def _hours_worked(spark, sf_dir):
    worked = labor.hours_worked(shifts(spark, sf_dir), retail.RUN_TIME)
    return worked.select(
        "EmployeeID",
        "ClockInDateID",
        F.col("ClockOutTime").isNull().cast("int").alias("IsOpen"),
        "TotalMinutes",
        "TotalHoursWorked",
    )


@query(
    "payroll",
    f"""WITH {o.SHIFTS}, worked AS (
      SELECT EmployeeID, count(*) AS Shifts,
             CAST(sum(coalesce(date_diff('second', ClockInTime, ClockOutTime), 0)) AS BIGINT)
               AS WorkedSeconds
      FROM shifts GROUP BY EmployeeID)
    SELECT EmployeeID, Shifts, WorkedSeconds, WorkedSeconds / 3600.0 AS HoursWorked,
           {o.pay('WorkedSeconds')} AS GrossPay
    FROM worked""",
)
def _payroll(spark, sf_dir):
    return labor.payroll(shifts(spark, sf_dir))


@query(
    "schedule_grid",
    f"""WITH {o.SHIFTS}, {o.SEATS}, people AS (SELECT DISTINCT user_id AS EmployeeID FROM events),
    days AS (SELECT CAST(unnest(range((SELECT min(ClockInDateID) FROM shifts),
                                      (SELECT max(ClockInDateID) FROM shifts) + 1)) AS INTEGER) AS d)
    SELECT p.EmployeeID, LocationID, d AS ShiftDateID,
           CAST(s.EmployeeID IS NOT NULL AS INTEGER) AS IsPresent,
           coalesce(date_diff('minute', ClockInTime, coalesce(ClockOutTime, {o.RUN_TIMESTAMP})), 0)
             AS TotalMinutes
    FROM people p JOIN seats ON Seat = p.EmployeeID % (SELECT count(*) FROM supplier)
    CROSS JOIN days LEFT JOIN shifts s ON s.EmployeeID = p.EmployeeID AND ClockInDateID = d""",
)
def _schedule_grid(spark, sf_dir):
    worked = labor.hours_worked(shifts(spark, sf_dir), retail.RUN_TIME)
    span = worked.agg(F.min("ClockInDateID").alias("first"), F.max("ClockInDateID").alias("last")).first()
    return labor.attendance(employees(spark, sf_dir), worked, span["first"], span["last"])


@query(
    "operating_hours_grid",
    """SELECT s_suppkey * 7 + k AS OperatingHoursID, s_suppkey AS LocationID,
           CAST(k AS INTEGER) AS DayOfWeek, coalesce(n, 0) AS Lines,
           CAST(coalesce(n, 0) > 0 AS INTEGER) AS IsOpen
    FROM (SELECT s_suppkey, unnest(range(1, 8)) AS k FROM supplier) LEFT JOIN (
      SELECT l_suppkey, isodow(l_shipdate) AS day, count(*) AS n FROM lineitem GROUP BY ALL)
      ON l_suppkey = s_suppkey AND day = k""",
)
def _operating_hours_grid(spark, sf_dir):
    return sales.store_weekdays(retail.locations(spark, sf_dir), retail.order_lines(spark, sf_dir))


@query(
    "hierarchy_closure",
    """WITH RECURSIVE tree AS (
      SELECT s_suppkey AS EmployeeID, CAST(NULL AS BIGINT) AS SupervisorEmployeeID,
             s_suppkey AS RootID, CAST(0 AS BIGINT) AS Level FROM supplier WHERE s_suppkey = 0
      UNION ALL
      SELECT s.s_suppkey, t.EmployeeID, t.RootID, t.Level + 1
      FROM supplier s JOIN tree t ON s.s_suppkey > 0 AND (s.s_suppkey - 1) // 3 = t.EmployeeID)
    SELECT * FROM tree""",
)
def _hierarchy_closure(spark, sf_dir):
    key = F.col("EmployeeID")
    boss = F.when(key > 0, F.floor((key - 1) / 3)).alias("SupervisorEmployeeID")
    staff = retail.locations(spark, sf_dir).select(F.col("LocationID").alias("EmployeeID"))
    return hierarchy.levels(staff.select("EmployeeID", boss), "EmployeeID", "SupervisorEmployeeID")


# --- stock --------------------------------------------------------------------


def daily_usage(spark, sf_dir):
    return inventory.daily_usage(
        retail.order_lines(spark, sf_dir),
        retail.orders(spark, sf_dir),
        retail.items(spark, sf_dir),
    )


def total_usage(spark, sf_dir):
    return inventory.total_usage(retail.order_lines(spark, sf_dir), retail.items(spark, sf_dir))


_TOTALS = f"""{o.LINES}, {o.RECIPES}, usage AS (
  SELECT l.LocationID, r.IngredientID, sum(l.Quantity * r.RecipeQuantity) AS Used
  FROM lines l JOIN recipes r USING (ItemID) GROUP BY ALL)"""

_USAGE = f"""{o.ORDERS}, {o.LINES}, {o.RECIPES}, usage AS (
  SELECT l.LocationID, r.IngredientID, o.OrderDateID, sum(l.Quantity * r.RecipeQuantity) AS Used
  FROM lines l JOIN ord o USING (OrderID) JOIN recipes r USING (ItemID) GROUP BY ALL)"""

_OPENING = "CAST(5000 + (LocationID * 37 + IngredientID * 101) % 4000 AS DECIMAL(14,4))"


@query(
    "recipe_explosion",
    f"""WITH {o.LINES}, {o.RECIPES},
    units AS (SELECT ItemID, sum(Quantity) AS Units FROM lines GROUP BY ItemID)
    SELECT ItemID, IngredientID, CAST(Units * RecipeQuantity AS DOUBLE) AS ConsumedQuantity
    FROM units LEFT JOIN recipes USING (ItemID)""",
)
def _recipe_explosion(spark, sf_dir):
    recipes = inventory.recipe_items(retail.items(spark, sf_dir))
    return inventory.recipe_explosion(retail.order_lines(spark, sf_dir), recipes)


@query(
    "inventory_running_stock",
    f"""WITH {_USAGE}, running AS (
      SELECT *, {_OPENING} - sum(Used) OVER (PARTITION BY LocationID, IngredientID
                                             ORDER BY OrderDateID) AS After FROM usage)
    SELECT LocationID, IngredientID, OrderDateID, CAST(Used AS DOUBLE) AS UsedQuantity,
           CAST(After AS DOUBLE) AS QuantityAfter, CAST(After + Used AS DOUBLE) AS QuantityBefore,
           'Usage' AS TransactionType, 'Sale' AS ReasonCode
    FROM running""",
)
def _inventory_running_stock(spark, sf_dir):
    opening = amount((F.col("LocationID") * 37 + F.col("IngredientID") * 101) % 4000 + 5000, 14, 4)
    return inventory.running_stock(daily_usage(spark, sf_dir), opening)


@query(
    "inventory_transactions",
    f"""WITH {o.ORDERS}, {o.LINES}, {o.RECIPES}, used AS (
      SELECT l.LocationID, r.IngredientID, l.OrderID, l.LineNumber, l.ItemID, o.OrderDateID,
             l.Quantity * r.RecipeQuantity AS Used
      FROM lines l JOIN ord o USING (OrderID) JOIN recipes r USING (ItemID)),
    running AS (
      SELECT *, {_OPENING} - sum(Used) OVER (
               PARTITION BY LocationID, IngredientID
               ORDER BY OrderDateID, OrderID, LineNumber, ItemID, Used ROWS UNBOUNDED PRECEDING)
             AS After FROM used)
    SELECT LocationID, IngredientID, OrderID, LineNumber, ItemID, OrderDateID,
           CAST(Used AS DOUBLE) AS Quantity, CAST(After + Used AS DOUBLE) AS QuantityBefore,
           CAST(After AS DOUBLE) AS QuantityAfter FROM running""",
)
def _inventory_transactions(spark, sf_dir):
    opening = amount((F.col("LocationID") * 37 + F.col("IngredientID") * 101) % 4000 + 5000, 14, 4)
    lines = retail.order_lines(spark, sf_dir).select(
        "OrderID", "LineNumber", "LocationID", "ItemID", "Quantity"
    )
    orders = retail.orders(spark, sf_dir).select("OrderID", "OrderDateID")
    return inventory.stock_movements(
        inventory.line_usage(lines.join(orders, "OrderID"), retail.items(spark, sf_dir)),
        ["OrderDateID", "OrderID", "LineNumber", "ItemID", "Quantity"],
        opening,
        orders.join(F.broadcast(sample_of(lines)), "OrderID"),
    )


_INGREDIENT_VALUES = o.values(
    [(key, name) for key, (_, name, _) in enumerate(INGREDIENTS, 1)], ["INTEGER", "VARCHAR"]
)


@query(
    "store_inventory_grid",
    f"""WITH {_USAGE}, used AS (
      SELECT LocationID, IngredientID, sum(Used) AS Used, count(*) AS Days FROM usage GROUP BY ALL)
    SELECT s_suppkey * 7 + k AS StoreInventoryID, s_suppkey AS LocationID, k AS InventoryItemID,
           name AS ItemName, CAST(coalesce(Used, 0) AS DOUBLE) AS UsedQuantity,
           coalesce(Days, 0) AS DaysUsed
    FROM supplier CROSS JOIN (VALUES {_INGREDIENT_VALUES}) AS i(k, name)
    LEFT JOIN used ON LocationID = s_suppkey AND IngredientID = k""",
)
def _store_inventory_grid(spark, sf_dir):
    return inventory.store_stock(retail.locations(spark, sf_dir), daily_usage(spark, sf_dir))


_PURCHASES = f"""{_TOTALS}, poi AS (
  SELECT LocationID AS PurchaseOrderID, printf('PO-%06d', LocationID) AS PurchaseOrderNumber,
         LocationID, IngredientID AS InventoryItemID, sum(Used) AS UsedQuantity,
         CAST(ceil(sum(Used)) AS BIGINT) AS QuantityOrdered
  FROM usage GROUP BY LocationID, IngredientID)"""


@query(
    "purchase_orders",
    f"""WITH {_PURCHASES}
    SELECT PurchaseOrderID, PurchaseOrderNumber, LocationID, InventoryItemID,
           CAST(UsedQuantity AS DOUBLE) AS UsedQuantity, QuantityOrdered,
           CAST(1 AS DOUBLE) AS UnitPrice, CAST(QuantityOrdered AS DOUBLE) AS LineTotal
    FROM poi""",
)
def _purchase_orders(spark, sf_dir):
    return inventory.purchase_order_items(total_usage(spark, sf_dir))


@query(
    "po_totals",
    f"""WITH {_PURCHASES}
    SELECT PurchaseOrderID, count(*) AS Lines, CAST(sum(QuantityOrdered) AS DOUBLE) AS LinesTotal,
           CAST(sum(UsedQuantity) AS DOUBLE) AS UsedCost,
           CAST(sum(QuantityOrdered - UsedQuantity) AS DOUBLE) AS Variance
    FROM poi GROUP BY PurchaseOrderID""",
)
def _po_totals(spark, sf_dir):
    return inventory.purchase_totals(inventory.purchase_order_items(total_usage(spark, sf_dir)))


@query(
    "reorder_report",
    f"""WITH {_TOTALS}, stock AS (
      SELECT s_suppkey AS LocationID, k AS IngredientID, name AS ItemName
      FROM supplier, (VALUES {_INGREDIENT_VALUES}) AS i(k, name)),
    used AS (SELECT LocationID, IngredientID, sum(Used) AS Used FROM usage GROUP BY ALL),
    rest AS (SELECT *, {_OPENING} AS OnHand, coalesce(Used, 0) AS U
             FROM stock LEFT JOIN used USING (LocationID, IngredientID))
    SELECT LocationID, IngredientID, ItemName, CAST(OnHand AS DOUBLE) AS QuantityOnHand,
           CAST(U AS DOUBLE) AS UsedQuantity, CAST(OnHand - U AS DOUBLE) AS RemainingQuantity,
           CAST(10 AS DOUBLE) AS MinimumQuantity, 50 AS ReorderQuantity
    FROM rest WHERE OnHand - U < 10""",
)
def _reorder_report(spark, sf_dir):
    opening = amount(
        (F.col("LocationID") * 37 + F.col("InventoryItemID") * 101) % 4000 + 5000, 14, 4
    )
    stock = inventory.store_items(retail.locations(spark, sf_dir)).withColumn("QuantityOnHand", opening)
    return inventory.reorder_report(stock, total_usage(spark, sf_dir)).drop("StoreInventoryID")


# --- finance ------------------------------------------------------------------


@query(
    "store_pnl",
    f"""WITH {o.STORE_ORDERS}, {o.RECIPES}, {o.COGS}, {o.LABOR},
    net AS (SELECT LocationID, sum(Gross) - sum(Discount) - sum(Refund) AS n
            FROM store_orders GROUP BY LocationID),
    goods AS (SELECT LocationID, sum(CostOfGoodsSold) AS g FROM cogs GROUP BY LocationID),
    staff AS (SELECT LocationID, CAST(sum((CostSeconds + 1800) // 3600) AS DECIMAL(18,2))
                * CAST(0.01 AS DECIMAL(3,2)) AS s FROM labor GROUP BY LocationID),
    owed AS (SELECT s_suppkey AS LocationID, greatest(CAST(s_acctbal AS DECIMAL(18,2)), 0) AS x FROM supplier)
    SELECT LocationID, CAST(n AS DOUBLE) AS NetSales, CAST(coalesce(g, 0) AS DOUBLE)
           AS CostOfGoodsSold, CAST(coalesce(s, 0) AS DOUBLE) AS TotalLaborCost,
           CAST(coalesce(x, 0) AS DOUBLE) AS Expenses,
           CAST(n - coalesce(g, 0) - coalesce(s, 0) - coalesce(x, 0) AS DOUBLE) AS Profit
    FROM net LEFT JOIN goods USING (LocationID) LEFT JOIN staff USING (LocationID)
    LEFT JOIN owed USING (LocationID)""",
)
def _store_pnl(spark, sf_dir):
    return ledger.store_profit(
        dated_lines(spark, sf_dir, cost=True),
        daily_labor(spark, sf_dir),
        retail.store_expenses(spark, sf_dir),
    )


# --- promotions ---------------------------------------------------------------

CAMPAIGN_VALUES = f"""promos(PromotionID, PromotionCode, Pct, Amt, StartDateID, EndDateID,
    Channels, Days, TimeStart, TimeEnd, MinPurchase, Active, MembersOnly, PerMember, InTotal) AS (VALUES {o.values(
        c.CAMPAIGNS,
        ['BIGINT', 'VARCHAR', 'DECIMAL(5,2)', 'DECIMAL(8,2)', 'INTEGER', 'INTEGER', 'VARCHAR',
         'VARCHAR', 'VARCHAR', 'VARCHAR', 'DECIMAL(8,2)', 'INTEGER', 'INTEGER', 'INTEGER', 'INTEGER'])})"""
_TARGET_VALUES = f"""targets(PromotionID, ItemID, Category, ComboID) AS (VALUES {o.values(
    c.TARGETS, ['BIGINT', 'BIGINT', 'VARCHAR', 'BIGINT'])})"""
_COMBO_ITEMS = """combo_items AS (
  SELECT p_partkey // 50 AS ComboID, p_partkey AS ItemID,
         CAST(p_partkey % 3 + 1 AS INTEGER) AS ComponentQuantity
  FROM part WHERE p_partkey % 50 IN (0, 7, 21))"""
TARGET_ITEMS = f"""{_TARGET_VALUES}, {_COMBO_ITEMS}, target_items AS (
  SELECT PromotionID, ItemID FROM targets WHERE ItemID IS NOT NULL
  UNION SELECT PromotionID, p_partkey FROM targets JOIN part ON Category = p_type
  UNION SELECT PromotionID, c.ItemID FROM targets t JOIN combo_items c USING (ComboID))"""


@query(
    "promo_interval_join",
    f"""WITH {o.ORDERS}, {CAMPAIGN_VALUES}
    SELECT OrderID, OrderDateID, PromotionID, PromotionCode
    FROM ord JOIN promos ON OrderDateID >= StartDateID
      AND (EndDateID IS NULL OR OrderDateID <= EndDateID)""",
)
def _promo_interval_join(spark, sf_dir):
    orders = retail.orders(spark, sf_dir).select("OrderID", "OrderDateID")
    promotions = c.campaigns(spark).select(
        "PromotionID", "PromotionCode", "StartDateID", "EndDateID"
    )
    return promo.running_promotions(orders, promotions).drop("StartDateID", "EndDateID")


def targeted_items(spark, sf_dir):
    items = retail.items(spark, sf_dir)
    return promo.promotion_items(c.targets(spark), items, c.combo_items(items))


@query(
    "promo_targets_expand",
    f"WITH {TARGET_ITEMS} SELECT * FROM target_items",
)
def _promo_targets_expand(spark, sf_dir):
    return targeted_items(spark, sf_dir)


APPLICABLE = f"""{o.STORE_ORDERS}, {CAMPAIGN_VALUES}, {TARGET_ITEMS},
    eligible AS (SELECT OrderID, LocationID, PromotionID, sum(Gross) AS Eligible
                 FROM lines JOIN target_items USING (ItemID) GROUP BY ALL),
    clock AS (SELECT *, strftime(TIMESTAMP '1970-01-01' + to_seconds(OrderID * 37 % 86400),
                                 '%H:%M:%S') AS ClockTime,
              CASE ChannelID WHEN 1 THEN 'INSTORE' WHEN 2 THEN 'DRIVETHRU' WHEN 3 THEN 'MOBILE'
                WHEN 4 THEN 'WEB' WHEN 5 THEN 'KIOSK' ELSE 'THIRDPARTY' END AS Channel
              FROM store_orders),
    based AS (
      SELECT s.OrderID, s.LocationID, s.OrderDateID, s.MemberID, s.Gross, p.PromotionID, p.Pct, p.Amt,
             p.PerMember, p.InTotal,
             CASE WHEN p.PromotionID IN (SELECT PromotionID FROM targets) THEN coalesce(Eligible, 0)
                  ELSE s.Gross END AS Base
      FROM clock s JOIN promos p ON s.OrderDateID >= StartDateID
        AND (EndDateID IS NULL OR s.OrderDateID <= EndDateID)
      LEFT JOIN eligible e ON e.OrderID = s.OrderID AND e.LocationID = s.LocationID
        AND e.PromotionID = p.PromotionID
      WHERE (Channels = 'All' OR list_contains(string_split(Channels, ','), Channel))
        AND (Days = 'All' OR (Days = 'Weekends') = (isodow(OrderDate) >= 6))
        AND (TimeStart IS NULL OR ClockTime >= TimeStart)
        AND (TimeEnd IS NULL OR ClockTime <= TimeEnd)
        AND s.Gross >= coalesce(MinPurchase, 0) AND Active = 1
        AND (MembersOnly = 0 OR s.MemberID IS NOT NULL)
        AND (p.PromotionID NOT IN ({', '.join(map(str, c.LOCAL_CAMPAIGNS))})
             OR s.LocationID % 2 = 1)),
    priced AS (
      SELECT OrderID, LocationID, PromotionID, OrderDateID, MemberID, Gross, Pct, PerMember, InTotal,
             CASE WHEN Pct IS NOT NULL THEN round(Base * Pct * CAST(0.01 AS DECIMAL(3,2)), 2)
                  ELSE least(Amt, Base) END AS Discount FROM based),
    owned AS (
      SELECT *, row_number() OVER (PARTITION BY PromotionID, MemberID
                                   ORDER BY OrderDateID, OrderID, LocationID) AS own
      FROM priced WHERE Discount > 0),
    used AS (
      SELECT *, row_number() OVER (PARTITION BY PromotionID ORDER BY OrderDateID, OrderID, LocationID) AS nth
      FROM owned WHERE PerMember IS NULL OR MemberID IS NULL OR own <= PerMember)"""


@query(
    "promo_applicability",
    f"""WITH {APPLICABLE}
    SELECT OrderID, LocationID, PromotionID, CAST(Discount AS DOUBLE) AS Discount, Promotions
    FROM (SELECT *, count(*) OVER w AS Promotions,
                 row_number() OVER (PARTITION BY OrderID, LocationID
                                    ORDER BY Discount DESC, PromotionID) AS pick
          FROM used WHERE InTotal IS NULL OR nth <= InTotal
          WINDOW w AS (PARTITION BY OrderID, LocationID))
    WHERE pick = 1""",
)
def _promo_applicability(spark, sf_dir):
    return promo.best_discount(applicable_promotions(spark, sf_dir))


def applicable_promotions(spark, sf_dir):
    return promo.applicable_promotions(
        store_orders(spark, sf_dir, "ChannelID", "OrderSecond", "MemberID"),
        retail.order_lines(spark, sf_dir),
        c.campaigns(spark),
        c.targets(spark),
        targeted_items(spark, sf_dir),
        c.campaign_stores(retail.locations(spark, sf_dir)),
        retail.orders(spark, sf_dir).agg(F.max("OrderDateID")).first()[0],
    )


@query(
    "promo_stacking",
    f"""WITH {APPLICABLE}, valid AS (
      SELECT *, PromotionID IN ({', '.join(map(str, c.STACKABLE))}) AS stacks FROM used WHERE InTotal IS NULL OR nth <= InTotal),
    sums AS (
      SELECT OrderID, LocationID, max(struct_pack(d := Discount, r := -PromotionID)) AS single,
             max(CASE WHEN stacks AND Pct IS NOT NULL THEN struct_pack(d := Discount, r := -PromotionID) END) AS best,
             coalesce(sum(CASE WHEN stacks AND Pct IS NULL THEN Discount END), 0) AS amounts,
             list(PromotionID) FILTER (WHERE stacks AND Pct IS NULL) AS ids, max(Gross) AS gross
      FROM valid GROUP BY ALL),
    options AS (SELECT *, least(coalesce(best.d, 0) + amounts, gross) AS together FROM sums),
    picked AS (
      SELECT OrderID, LocationID, CASE WHEN single.d >= together THEN [-single.r]
               ELSE list_sort(list_concat(CASE WHEN best IS NULL THEN [] ELSE [-best.r] END, coalesce(ids, []))) END AS chosen,
             CAST(greatest(single.d, together) AS DOUBLE) AS Discount
      FROM options)
    SELECT OrderID, LocationID, array_to_string(chosen, ',') AS PromotionIDs, CAST(len(chosen) AS INTEGER) AS Promotions, Discount
    FROM picked""",
)
def _promo_stacking(spark, sf_dir):
    return promo.best_stack(applicable_promotions(spark, sf_dir), c.stackable_campaigns(spark))


@query(
    "promo_bridge",
    """SELECT 'item' AS Kind, CAST(1 AS BIGINT) AS PromotionID, p_partkey AS TargetID
      FROM part
    UNION ALL SELECT 'store', 1, s_suppkey FROM supplier""",
)
def _promo_bridge(spark, sf_dir):
    promotions = c.campaigns(spark)
    items = promo.promotion_bridge(retail.items(spark, sf_dir), promotions, "ItemID")
    stores = promo.promotion_bridge(retail.locations(spark, sf_dir), promotions, "LocationID")
    return items.select(
        F.lit("item").alias("Kind"), "PromotionID", F.col("ItemID").alias("TargetID")
    ).unionByName(
        stores.select(
            F.lit("store").alias("Kind"), "PromotionID", F.col("LocationID").alias("TargetID")
        )
    )


@query(
    "combo_expand",
    f"""WITH {o.LINES}, {_COMBO_ITEMS},
    sold AS (SELECT ItemID // 50 AS ComboID, sum(Quantity) AS Units
             FROM lines WHERE ItemID % 50 = 0 GROUP BY ALL)
    SELECT ComboID, ItemID, ComponentQuantity, CAST(Units AS DOUBLE) AS UnitsSold,
           CAST(Units * ComponentQuantity AS DOUBLE) AS UnitsNeeded
    FROM sold JOIN combo_items USING (ComboID)""",
)
def _combo_expand(spark, sf_dir):
    items = retail.items(spark, sf_dir)
    return promo.combo_units(
        retail.order_lines(spark, sf_dir), c.combo_items(items), c.combos(items)
    )


# --- loyalty ------------------------------------------------------------------


@query(
    "points_running_balance",
    f"""WITH points AS (
      SELECT event_id AS TransactionID, user_id AS MemberID, ts, event_type,
             {o.date_id('ts')} AS TransactionDateID,
             CAST(floor(CAST(value AS DECIMAL(18,2))) AS BIGINT)
               * CASE WHEN event_type IN ('purchase', 'view', 'signup') THEN 1 ELSE -1 END AS Points
      FROM events)
    SELECT TransactionID, MemberID, TransactionDateID,
           CASE WHEN event_type IN ('purchase', 'view', 'signup') THEN 'Earned' ELSE 'Redeemed' END
             AS TransactionType, Points,
           CAST(sum(Points) OVER (PARTITION BY MemberID ORDER BY ts, TransactionID
                                  ROWS UNBOUNDED PRECEDING) AS BIGINT) AS BalanceAfter
    FROM points""",
)
def _points_running_balance(spark, sf_dir):
    balance = loyalty.points_balance(retail.points_transactions(spark, sf_dir))
    return balance.drop("TransactionTime")


@query(
    "member_lifetime",
    f"""WITH {o.ORDERS}, spent AS (
      SELECT MemberID, count(*) AS Orders, sum(StatedTotal) AS Total,
             CAST(sum(floor(StatedTotal)) AS BIGINT) AS Points, max(OrderDateID) AS LastOrderDateID
      FROM ord GROUP BY MemberID)
    SELECT c_custkey AS MemberID, coalesce(Orders, 0) AS Orders,
           CAST(coalesce(Total, 0) AS DOUBLE) AS TotalSpent, coalesce(Points, 0) AS LifetimePoints,
           LastOrderDateID,
           CASE WHEN Total >= 3000000 THEN 'Platinum' WHEN Total >= 2000000 THEN 'Gold'
                WHEN Total >= 1000000 THEN 'Silver' ELSE 'Bronze' END AS MembershipTier
    FROM customer LEFT JOIN spent ON MemberID = c_custkey""",
)
def _member_lifetime(spark, sf_dir):
    return loyalty.member_lifetime(retail.members(spark, sf_dir), retail.orders(spark, sf_dir))


FEEDBACK = """feedback AS (
  SELECT event_id AS FeedbackID, user_id AS MemberID,
         CASE WHEN value IS NOT NULL THEN CAST(greatest(least(floor(value / 25.0), 4), 0) + 1 AS INTEGER) END
           AS OverallRating
  FROM events WHERE event_type = 'view')"""


@query("order_feedback", f"WITH {FEEDBACK} SELECT * FROM feedback")
def _order_feedback(spark, sf_dir):
    return loyalty.feedback(retail.ratings(spark, sf_dir))


@query(
    "feedback_by_store",
    f"""WITH {FEEDBACK}, {o.SEATS}
    SELECT LocationID, count(*) AS Responses,
           CAST(sum(OverallRating) AS DOUBLE) / count(*) AS AverageRating
    FROM feedback JOIN seats ON Seat = MemberID % (SELECT count(*) FROM supplier)
    GROUP BY LocationID""",
)
def _feedback_by_store(spark, sf_dir):
    return loyalty.feedback_by_store(
        loyalty.feedback(retail.ratings(spark, sf_dir)), retail.locations(spark, sf_dir)
    )
