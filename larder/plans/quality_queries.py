"""Data-quality queries: the catalogue's rules over the driver's tables as they are."""

from __future__ import annotations

from pyspark.sql import functions as F

from larder.catalog import constraints
from larder.functions import keys
from larder.functions.dates import CALENDAR_END, CALENDAR_START, date_id, date_of_id, iso_weekday
from larder.operators import audit, dimensions, labor, loyalty, quality, sales
from larder.operators.calendar import days
from larder.plans import campaigns as c
from larder.plans import oracle as o
from larder.plans.registry import query
from larder.plans.sales_queries import shifts, store_orders
from larder.plans.store_queries import (
    CAMPAIGN_VALUES,
    FEEDBACK,
    PRICED,
    TARGET_ITEMS,
    priced_orders,
)
from larder.sources import retail

# --- row rules ----------------------------------------------------------------


def _employees(spark, sf_dir):
    """Staff as the time clock knows them: rate, first and last day."""
    days = shifts(spark, sf_dir).groupBy("EmployeeID").agg(
        F.min("ClockInDateID").alias("HireDateID"), F.max("ClockInDateID").alias("TerminationDateID")
    )
    return labor.with_rates(days)


def _checked_tables(spark, sf_dir):
    """Catalogued table names -> the driver's rows standing in for them."""
    stores = retail.locations(spark, sf_dir)
    lines = retail.order_lines(spark, sf_dir)
    priced = priced_orders(spark, sf_dir)
    no_combo = F.lit(None).cast("bigint").alias("ComboID")
    return {
        "emp.Employees": _employees(spark, sf_dir),
        "menu.Items": retail.items(spark, sf_dir),
        "promo.Promotions": c.campaigns(spark),
        "promo.PromotionItems": c.targets(spark).withColumnRenamed("Category", "CategoryID"),
        # orders and their payments share one pass over the priced orders
        ("ord.Orders", "ord.PaymentTransactions"): priced.select(
            "SubtotalAmount", "TotalAmount", F.col("TotalAmount").alias("Amount")
        ),
        "ord.OrderItems": lines.select("Quantity", "ItemID", no_combo),
        "ord.OrderFeedback": loyalty.feedback(retail.ratings(spark, sf_dir)),
        "finance.StoreExpenses": stores.select(F.col("Balance").alias("Amount")),
    }


# Rules beyond the declared ones: domains, ranges and relations between columns.
_DOMAIN_RULES = {
    "Year": "year(OrderDate) BETWEEN 1995 AND 2000",
    "Month": "month(OrderDate) BETWEEN 1 AND 12",
    "Weekday": "DayOfWeek BETWEEN 1 AND 5",
    "Channel": "ChannelID IN (1, 2, 3, 4)",
    "PaymentMethod": "PaymentMethod IN ('Cash', 'CreditCard', 'MobileWallet')",
    "DiscountBelowSales": "Discount * 10 < Gross",
    "RefundWithinSales": "Refund <= Gross",
}

_CHECK_SOURCES = {
    "emp.Employees": """SELECT (1500 + EmployeeID % 4 * 250) / 100.0 AS HourlyRate,
        min(ClockInDateID) AS HireDateID, max(ClockInDateID) AS TerminationDateID
        FROM shifts GROUP BY EmployeeID""",
    "menu.Items": "SELECT CAST(p_retailprice AS DECIMAL(12,2)) AS BasePrice FROM part",
    "promo.Promotions": """SELECT StartDateID, EndDateID, Pct AS DiscountPercentage,
        Amt AS DiscountAmount FROM promos""",
    "promo.PromotionItems": "SELECT ItemID, Category AS CategoryID, ComboID FROM targets",
    "ord.Orders": "SELECT SubtotalAmount, TotalAmount FROM totals",
    "ord.OrderItems": "SELECT Quantity, ItemID, NULL AS ComboID FROM lines",
    "ord.PaymentTransactions": "SELECT TotalAmount AS Amount FROM totals",
    "ord.OrderFeedback": "SELECT OverallRating FROM feedback",
    "finance.StoreExpenses": "SELECT CAST(s_acctbal AS DECIMAL(18,2)) AS Amount FROM supplier",
    "ord.StoreOrders": "SELECT *, isodow(OrderDate) AS DayOfWeek FROM store_orders",
}


def _checks_sql() -> str:
    rules = {table: constraints.checks(table) for table in _CHECK_SOURCES}
    rules["ord.StoreOrders"] = _DOMAIN_RULES
    parts = [
        f"""SELECT '{table}' AS TableName, '{name}' AS Rule, count(*) AS CheckedRows,
            count(*) FILTER (NOT ({rule})) AS Violations FROM ({_CHECK_SOURCES[table]})"""
        for table, named in rules.items()
        for name, rule in named.items()
    ]
    ctes = f"""{PRICED}, store_orders AS (
      SELECT l.OrderID, l.LocationID, o.OrderDate, o.ChannelID, o.PaymentMethod,
             sum(l.Gross) AS Gross, sum(l.Discount) AS Discount, sum(l.Refund) AS Refund
      FROM lines l JOIN ord o USING (OrderID) GROUP BY ALL),
    {CAMPAIGN_VALUES}, {TARGET_ITEMS}, {FEEDBACK}, {o.SHIFTS}"""
    return f"WITH {ctes} " + " UNION ALL ".join(parts)


@query("dq_checks", _checks_sql())
def _dq_checks(spark, sf_dir):
    parts = [
        quality.check_rule_sets(
            df, {t: constraints.checks(t) for t in ([tables] if isinstance(tables, str) else tables)}
        )
        for tables, df in _checked_tables(spark, sf_dir).items()
    ]
    dated = store_orders(spark, sf_dir, "ChannelID", "PaymentMethod")
    dated = dated.withColumn("OrderDate", date_of_id(F.col("OrderDateID")))
    dated = dated.withColumn("DayOfWeek", iso_weekday(F.col("OrderDate")))
    parts.append(quality.check_rules(dated, "ord.StoreOrders", _DOMAIN_RULES))
    return quality.union_all(parts)


# --- uniqueness ---------------------------------------------------------------

_UNIQUE_KEYS = [
    ("lineitem", ["OrderID", "LineNumber"], "l_orderkey, l_linenumber"),
    ("lineitem", ["LocationID", "ItemID"], "l_suppkey, l_partkey"),
    ("orders", ["OrderID"], "o_orderkey"),
    ("orders", ["MemberID", "OrderDateID"], "o_custkey, CAST(o_orderdate AS DATE)"),
    ("supplier", ["LocationID"], "s_suppkey"),
    ("supplier", ["StoreName"], "s_name"),
    ("customer", ["MemberID"], "c_custkey"),
    ("part", ["ItemName"], "p_name"),
    ("events", ["TransactionID"], "event_id"),
]


@query(
    "dq_unique",
    " UNION ALL ".join(
        f"""SELECT '{table}' AS TableName, '{','.join(key)}' AS KeyColumns,
        CAST(coalesce(sum(n), 0) AS BIGINT) AS CheckedRows, count(*) AS DistinctKeys,
        count(*) FILTER (n > 1) AS DuplicatedKeys
        FROM (SELECT count(*) AS n FROM {table} GROUP BY {columns})"""
        for table, key, columns in _UNIQUE_KEYS
    ),
)
def _dq_unique(spark, sf_dir):
    tables = _tables(spark, sf_dir)
    return quality.union_all(
        [quality.check_unique(tables[table], table, key) for table, key, _ in _UNIQUE_KEYS]
    )


def _tables(spark, sf_dir):
    return {
        "lineitem": retail.order_lines(spark, sf_dir),
        "orders": retail.orders(spark, sf_dir),
        "supplier": retail.locations(spark, sf_dir),
        "customer": retail.members(spark, sf_dir),
        "part": retail.items(spark, sf_dir),
        "events": retail.points_transactions(spark, sf_dir),
    }


# --- mandatory columns --------------------------------------------------------


# The columns of the driver's tables.
_COLUMNS = {
    "region": ["r_regionkey", "r_name"],
    "nation": ["n_nationkey", "n_name", "n_regionkey"],
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    "supplier": ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"],
    "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
    "lineitem": [
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
        "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
    ],
    "events": ["event_id", "ts", "user_id", "event_type", "value", "props"],
}


@query(
    "dq_not_null",
    f"""WITH {o.ORDERS}, {o.SHIFTS},
    spent AS (SELECT c_custkey AS MemberID, max(OrderDateID) AS LastOrderDateID
      FROM customer LEFT JOIN ord ON MemberID = c_custkey GROUP BY c_custkey) """
    + " UNION ALL ".join(
        f"""SELECT '{table}' AS TableName, '{column}' AS ColumnName, count(*) AS CheckedRows,
        count(*) - count({column}) AS Nulls FROM {table}"""
        for table, names in [
            *_COLUMNS.items(), ("shifts", ["ClockInTime", "ClockOutTime"]), ("spent", ["LastOrderDateID"])
        ]
        for column in names
    ),
)
def _dq_not_null(spark, sf_dir):
    """Every column of every table, one scan per table, and two derived tables that do have NULLs."""
    members = loyalty.member_lifetime(retail.members(spark, sf_dir), retail.orders(spark, sf_dir))
    parts = [
        quality.check_not_null(retail.read(spark, sf_dir, table), table, names)
        for table, names in _COLUMNS.items()
    ]
    parts.append(quality.check_not_null(shifts(spark, sf_dir), "shifts", ["ClockInTime", "ClockOutTime"]))
    parts.append(quality.check_not_null(members, "spent", ["LastOrderDateID"]))
    return quality.union_all(parts)


# --- references ---------------------------------------------------------------

# child, column, parent, key
_REFERENCES = [
    ("lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("lineitem", "l_partkey", "part", "p_partkey"),
    ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
    ("orders", "o_custkey", "customer", "c_custkey"),
    ("events", "user_id", "customer", "c_custkey"),
    ("customer", "c_nationkey", "nation", "n_nationkey"),
    ("supplier", "s_nationkey", "nation", "n_nationkey"),
    ("nation", "n_regionkey", "region", "r_regionkey"),
    # the other way round: what is never referred to
    ("orders", "o_orderkey", "lineitem", "l_orderkey"),
    ("part", "p_partkey", "lineitem", "l_partkey"),
    ("supplier", "s_suppkey", "lineitem", "l_suppkey"),
    ("customer", "c_custkey", "orders", "o_custkey"),
]
_DATES = [("orders", "o_orderdate"), ("lineitem", "l_shipdate")]


@query(
    "dq_foreign_keys",
    " UNION ALL ".join(
        [
            f"""SELECT '{child}.{column}' AS Child, '{parent}.{key}' AS Parent,
            count(DISTINCT {column}) AS OrphanKeys, count(*) AS OrphanRows
            FROM {child} WHERE {column} IS NOT NULL AND NOT EXISTS (
              SELECT 1 FROM {parent} WHERE {key} = {column})"""
            for child, column, parent, key in _REFERENCES
        ]
        + [
            f"""SELECT '{child}.{column}', 'dim.Calendar.CalendarID', count(DISTINCT CAST({column} AS DATE)), count(*)
            FROM {child} WHERE CAST({column} AS DATE) NOT BETWEEN DATE '{CALENDAR_START}' AND DATE '{CALENDAR_END}'"""
            for child, column in _DATES
        ]
    ),
)
def _dq_foreign_keys(spark, sf_dir):
    tables = {name: retail.read(spark, sf_dir, name) for name in _COLUMNS}
    parts = [
        quality.check_reference(tables[child], child, column, tables[parent], parent, key)
        for child, column, parent, key in _REFERENCES
    ]
    for child, column in _DATES:
        dated = tables[child].select(date_id(F.to_date(column)).alias(column))
        parts.append(quality.check_reference(dated, child, column, days(spark), "dim.Calendar", "CalendarID"))
    return quality.union_all(parts)


# --- formats ------------------------------------------------------------------


@query(
    "dq_formats",
    r"""WITH stores AS (SELECT printf('SF-%05d', s_suppkey) AS StoreNumber, s_name AS StoreName,
        CAST(s_suppkey * 1000 + 90000 AS VARCHAR) AS ZipCode FROM supplier),
    members AS (SELECT CASE WHEN c_custkey % 7 = 0 THEN c_name ELSE
        'member' || CAST(c_custkey AS VARCHAR) || '@example.com' END AS Email,
        upper(substr(c_mktsegment, 1, c_nationkey % 4)) AS StateCode FROM customer)
    SELECT 'stores' AS TableName, 'StoreNumber' AS Rule, count(*) AS CheckedRows,
      count(*) FILTER (NOT regexp_matches(StoreNumber, '^SF-\d{5,}$')) AS Violations FROM stores
    UNION ALL SELECT 'stores', 'ZipCode', count(*),
      count(*) FILTER (NOT regexp_matches(ZipCode, '^\d{5}$')) FROM stores
    UNION ALL SELECT 'stores', 'StoreName', count(*),
      count(*) FILTER (NOT regexp_matches(StoreName, '^Supplier#\d{9}$')) FROM stores
    UNION ALL SELECT 'members', 'Email', count(*),
      count(*) FILTER (NOT regexp_matches(Email, '^[^@\s]+@[^@\s]+\.[^@\s]+$')) FROM members
    UNION ALL SELECT 'members', 'StateCode', count(*),
      count(*) FILTER (NOT regexp_matches(StateCode, '^[A-Z]{2}$')) FROM members
    UNION ALL SELECT 'items', 'Brand', count(*),
      count(*) FILTER (NOT regexp_matches(p_brand, '^Brand#\d$')) FROM part""",
)
def _dq_formats(spark, sf_dir):
    store, member = F.col("LocationID"), F.col("MemberID")
    stores = retail.locations(spark, sf_dir).select(
        keys.business_key(keys.STORE_NUMBER, store).alias("StoreNumber"),
        "StoreName",
        (store * 1000 + 90000).cast("string").alias("ZipCode"),
    )
    email = F.concat(F.lit("member"), member.cast("string"), F.lit("@example.com"))
    members = retail.members(spark, sf_dir).select(
        F.when(member % 7 == 0, F.col("MemberName")).otherwise(email).alias("Email"),
        F.upper(F.substring("Segment", F.lit(1), F.col("NationID") % 4)).alias("StateCode"),
    )
    brands = retail.read(spark, sf_dir, "part").select(F.col("p_brand").alias("Brand"))
    formats = quality.FORMATS
    return quality.union_all(
        [
            quality.check_formats(
                stores,
                "stores",
                {
                    "StoreNumber": formats["StoreNumber"],
                    "ZipCode": formats["ZipCode"],
                    "StoreName": r"^Supplier#\d{9}$",
                },
            ),
            quality.check_formats(
                members, "members", {n: formats[n] for n in ("Email", "StateCode")}
            ),
            quality.check_formats(brands, "items", {"Brand": r"^Brand#\d$"}),
        ]
    )


# --- completeness -------------------------------------------------------------


@query(
    "dq_completeness",
    f"""WITH {o.SHIFTS},
    per_order AS (SELECT o_orderkey, count(l_orderkey) AS n, count(DISTINCT l_linenumber) AS d,
                         max(l_linenumber) AS top
                  FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey),
    per_user AS (SELECT EmployeeID, count(*) AS n FROM shifts GROUP BY EmployeeID),
    per_year AS (SELECT year(o_orderdate) AS y, count(DISTINCT CAST(o_orderdate AS DATE)) AS n
                 FROM orders GROUP BY y)
    SELECT 'every store ships on every weekday' AS Rule, count(*) AS Groups,
      count(*) FILTER (n <> 7) AS WrongGroups FROM (
        SELECT s_suppkey, count(DISTINCT isodow(l_shipdate)) AS n
        FROM supplier LEFT JOIN lineitem ON l_suppkey = s_suppkey GROUP BY s_suppkey)
    UNION ALL SELECT 'lines are numbered 1..n', count(*), count(*) FILTER (d <> top OR n <> d)
      FROM per_order WHERE n > 0
    UNION ALL SELECT 'shifts on each of 30 days', count(*), count(*) FILTER (n <> 30) FROM per_user
    UNION ALL SELECT 'orders on every day of the year', count(*),
      count(*) FILTER (n <> CASE WHEN (y % 4 = 0 AND y % 100 <> 0) OR y % 400 = 0
                                 THEN 366 ELSE 365 END) FROM per_year""",
)
def _dq_completeness(spark, sf_dir):
    lines = retail.order_lines(spark, sf_dir)
    weekdays = sales.store_weekdays(retail.locations(spark, sf_dir), lines)
    # one row per order and line number, with how often it occurs
    numbered = lines.groupBy("OrderID", "LineNumber").agg(F.count("*").alias("_n"))
    ordered = retail.orders(spark, sf_dir).select(date_of_id(F.col("OrderDateID")).alias("day"))
    days_in_year = F.dayofyear(F.make_date(F.any_value("Year"), F.lit(12), F.lit(31)))
    return quality.union_all(
        [
            quality.check_group_size(
                weekdays,
                "every store ships on every weekday",
                ["LocationID"],
                F.sum("IsOpen"),
                F.lit(dimensions.DAYS_PER_WEEK),
            ),
            quality.check_group_size(
                numbered,
                "lines are numbered 1..n",
                ["OrderID"],
                F.sum("_n"),
                F.when(F.count("*") == F.max("LineNumber"), F.count("*")),
            ),
            quality.check_group_size(
                shifts(spark, sf_dir),
                "shifts on each of 30 days",
                ["EmployeeID"],
                F.count("*"),
                F.lit(labor.SCHEDULE_DAYS),
            ),
            quality.check_group_size(
                ordered.distinct().withColumn("Year", F.year("day")),
                "orders on every day of the year",
                ["Year"],
                F.count("*"),
                days_in_year,
            ),
        ]
    )


# --- defaults -----------------------------------------------------------------


@query(
    "fill_defaults",
    """SELECT c_custkey AS MemberID,
           coalesce(CASE WHEN c_acctbal > 5000 THEN 'Gold' END, 'Bronze') AS MembershipTier,
           coalesce(CASE WHEN c_acctbal > 0 THEN CAST(floor(c_acctbal) AS INTEGER) END, 0)
             AS TotalPoints,
           0 AS LifetimePoints, CAST(0 AS DOUBLE) AS TotalSpent,
           coalesce(nullif(c_mktsegment, 'MACHINERY'), 'Email') AS PreferredContactMethod,
           1 AS MarketingOptIn, 1 AS IsActive
    FROM customer""",
)
def _fill_defaults(spark, sf_dir):
    balance = F.col("Balance")
    members = retail.members(spark, sf_dir).select(
        "MemberID",
        F.when(balance > 5000, "Gold").alias("MembershipTier"),
        F.when(balance > 0, F.floor(balance).cast("int")).alias("TotalPoints"),
        F.nullif(F.col("Segment"), F.lit("MACHINERY")).alias("PreferredContactMethod"),
    )
    return quality.fill_defaults(members, "loyalty.Members").drop(
        "MemberGUID", "CreatedDate", "ModifiedDate"
    )


# --- audit --------------------------------------------------------------------

_CHANCE = "CAST('0x' || substr(md5('audit-' || CAST(OrderID AS VARCHAR)), 1, 8) AS BIGINT) % 10"
_AUDITED = ["MemberID", "OrderDateID", "OrderStatus", "StatedTotal"]


def _json(side: str, other: str) -> str:
    parts = ", ".join(
        f"""CASE WHEN {side}.{c} IS DISTINCT FROM {other}.{c} OR {other}.OrderID IS NULL
          THEN '"{c}":' || coalesce('"' || CAST({side}.{c} AS VARCHAR) || '"', 'null') END"""
        for c in _AUDITED
    )
    return f"CASE WHEN {side}.OrderID IS NOT NULL THEN '{{' || array_to_string(list_filter([{parts}], lambda x: x IS NOT NULL), ',') || '}}' END"


def earlier_orders(orders):
    """The orders as they may have been: some missing, some open, some cheaper and of guests, some since removed."""
    chance = keys.hash_number(F.lit("audit"), F.col("OrderID")) % 10
    given = orders.select("OrderID", *_AUDITED).withColumn("_chance", chance).where(F.col("_chance") != 0)
    removed = given.where(F.col("_chance") == 3).withColumn("OrderID", -F.col("OrderID") - 1)
    open_, cheap = F.col("_chance") == 1, F.col("_chance") == 2
    return given.unionByName(removed).withColumns({
        "OrderStatus": F.when(open_, "O").otherwise(F.col("OrderStatus")),
        "MemberID": F.when(~cheap, F.col("MemberID")),
        "StatedTotal": F.when(cheap, F.col("StatedTotal") - 1).otherwise(F.col("StatedTotal")),
    }).drop("_chance")


@query(
    "audit_diff",
    f"""WITH ord AS (
      SELECT o_orderkey AS OrderID, o_custkey AS MemberID, {o.date_id('o_orderdate')} AS OrderDateID, o_orderstatus AS OrderStatus,
             CAST(o_totalprice AS DECIMAL(18,2)) AS StatedTotal FROM orders),
    given AS (SELECT *, {_CHANCE} AS chance FROM ord),
    earlier AS (
      SELECT g.id AS OrderID, CASE WHEN chance <> 2 THEN g.MemberID END AS MemberID, g.OrderDateID,
             CASE WHEN chance = 1 THEN 'O' ELSE g.OrderStatus END AS OrderStatus,
             CASE WHEN chance = 2 THEN g.StatedTotal - 1 ELSE g.StatedTotal END AS StatedTotal
      FROM (SELECT OrderID AS id, * FROM given WHERE chance <> 0 UNION ALL SELECT -OrderID - 1, * FROM given WHERE chance = 3) g)
    SELECT 'ord.Orders' AS TableName, coalesce(n.OrderID, e.OrderID) AS RecordID,
           CASE WHEN e.OrderID IS NULL THEN 'INSERT' WHEN n.OrderID IS NULL THEN 'DELETE' ELSE 'UPDATE' END AS Action,
           {_json('e', 'n')} AS OldValues, {_json('n', 'e')} AS NewValues
    FROM ord n FULL OUTER JOIN earlier e ON n.OrderID = e.OrderID
    WHERE n.OrderID IS NULL OR e.OrderID IS NULL OR {' OR '.join(f'n.{c} IS DISTINCT FROM e.{c}' for c in _AUDITED)}""",
)
def _audit_diff(spark, sf_dir):
    orders = retail.orders(spark, sf_dir)
    return audit.audit_diff(earlier_orders(orders), orders.select("OrderID", *_AUDITED), "OrderID", "ord.Orders")
