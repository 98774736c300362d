"""SQL fragments the oracle queries share: the driver's tables as franchise entities."""

from __future__ import annotations

from larder.sources.retail import RUN_TIME, SHIFT_YEARS_BACK

DATE_ID = "CAST(date_diff('day', DATE '1980-01-01', {date}) + 1 AS INTEGER)"


def date_id(date: str) -> str:
    return DATE_ID.format(date=f"CAST({date} AS DATE)")


ORDERS = f"""ord AS (
  SELECT o_orderkey AS OrderID, o_custkey AS MemberID,
         {date_id('o_orderdate')} AS OrderDateID,
         CAST(o_orderdate AS DATE) AS OrderDate,
         CASE WHEN o_orderpriority LIKE '5%' THEN 6
              ELSE CAST(substr(o_orderpriority, 1, 1) AS INTEGER) END AS ChannelID,
         CASE o_orderkey % 4 WHEN 0 THEN 'Delivery' WHEN 1 THEN 'DineIn'
              WHEN 2 THEN 'Takeout' ELSE 'DriveThru' END AS OrderType,
         CASE o_orderkey % 3 WHEN 0 THEN 'Cash' WHEN 1 THEN 'CreditCard'
              ELSE 'MobileWallet' END AS PaymentMethod,
         o_orderkey * 37 % 86400 AS OrderSecond,
         CAST(o_totalprice AS DECIMAL(18,2)) AS StatedTotal
  FROM orders)"""

LINES = f"""lines AS (
  SELECT l_orderkey AS OrderID, l_linenumber AS LineNumber, l_suppkey AS LocationID,
         l_partkey AS ItemID, CAST(l_quantity AS DECIMAL(12,2)) AS Quantity,
         CAST(l_extendedprice AS DECIMAL(12,2)) AS Gross,
         CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)) AS Discount,
         CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)) AS LineTax,
         CASE WHEN l_returnflag = 'R' THEN CAST(l_extendedprice AS DECIMAL(12,2))
              ELSE CAST(0 AS DECIMAL(12,2)) END AS Refund,
         {date_id('l_shipdate')} AS ShipDateID
  FROM lineitem)"""

STORE_ORDERS = f"""{ORDERS}, {LINES}, store_orders AS (
  SELECT l.OrderID, l.LocationID, o.OrderDateID, o.OrderDate, o.MemberID, o.ChannelID,
         o.PaymentMethod, sum(l.Quantity) AS Quantity, sum(l.Gross) AS Gross,
         sum(l.Discount) AS Discount, sum(l.Refund) AS Refund, count(*) AS Lines
  FROM lines l JOIN ord o USING (OrderID)
  GROUP BY ALL)"""

# The recipe of every item: the first 2 + item mod 3 of the seven ingredients by
# a hash of item and ingredient, 0.05 to 2.00 units each.
RECIPES = """recipes AS (
  SELECT ItemID, IngredientID,
         CAST((ItemID * 7 + IngredientID * 13) % 196 + 5 AS DECIMAL(6,2))
           * CAST(0.01 AS DECIMAL(3,2)) AS RecipeQuantity
  FROM (SELECT p_partkey AS ItemID, IngredientID,
               row_number() OVER (PARTITION BY p_partkey
                 ORDER BY md5(CAST(p_partkey AS VARCHAR) || '-' || CAST(IngredientID AS VARCHAR)),
                          IngredientID) AS pick
        FROM part, (SELECT unnest([1, 2, 3, 4, 5, 6, 7]) AS IngredientID))
  WHERE pick <= 2 + ItemID % 3)"""

SHIFTS = f"""shifts AS (
  SELECT user_id AS EmployeeID, CAST(ts AS DATE) AS ShiftDate,
         {date_id(f"CAST(ts AS DATE) - INTERVAL {SHIFT_YEARS_BACK} YEAR")} AS ClockInDateID,
         min(ts) AS ClockInTime,
         CASE WHEN max(ts) > min(ts) THEN max(ts) END AS ClockOutTime
  FROM events GROUP BY ALL)"""

# Employee numbers deal people to the stores in the order of the store keys.
SEATS = """seats AS (
  SELECT s_suppkey AS LocationID, row_number() OVER (ORDER BY s_suppkey) - 1 AS Seat FROM supplier)"""

LABOR = f"""{SHIFTS}, {SEATS}, labor AS (
  SELECT LocationID, ClockInDateID AS OrderDateID,
         sum(coalesce(date_diff('second', ClockInTime, ClockOutTime), 0)) AS Seconds,
         sum(coalesce(date_diff('second', ClockInTime, ClockOutTime), 0)
             * (1500 + EmployeeID % 4 * 250)) AS CostSeconds
  FROM shifts JOIN seats ON Seat = EmployeeID % (SELECT count(*) FROM supplier) GROUP BY ALL)"""

COGS = """item_cost AS (
  SELECT ItemID, sum(RecipeQuantity * CAST(1 AS DECIMAL(4,2))) AS UnitCost
  FROM recipes GROUP BY ItemID), cogs AS (
  SELECT l.LocationID, o.OrderDateID, sum(l.Quantity * c.UnitCost) AS CostOfGoodsSold
  FROM lines l JOIN ord o USING (OrderID) JOIN item_cost c USING (ItemID) GROUP BY ALL)"""

RUN_TIMESTAMP = f"TIMESTAMP '{RUN_TIME}'"


def pay(seconds: str, cents: str = "1500") -> str:
    """Gross pay in cents rounded half up, as DOUBLE."""
    return (
        f"CAST(CAST(({seconds} * {cents} + 1800) // 3600 AS DECIMAL(18,0))"
        " / 100 AS DOUBLE)"
    )


def values(rows: list[tuple], types: list[str]) -> str:
    """Rows as a VALUES list with typed entries."""

    def literal(value, kind: str) -> str:
        text = "NULL" if value is None else "'" + str(value).replace("'", "''") + "'"
        return f"CAST({text} AS {kind})"

    return ", ".join(
        "(" + ", ".join(literal(v, t) for v, t in zip(row, types, strict=True)) + ")" for row in rows
    )
