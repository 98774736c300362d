"""Queries on dates, keys and table mechanics."""

from __future__ import annotations

from pyspark.sql import functions as F

from larder.functions import keys
from larder.functions.dates import CALENDAR_END, CALENDAR_START, date_of_id
from larder.functions.money import amount
from larder.operators import dimensions
from larder.operators.calendar import calendar, with_calendar
from larder.operators.surrogate import assign_round_robin, dense_ids
from larder.plans import oracle as o
from larder.plans.registry import query
from larder.sources import retail
from larder.sources.scratch import fresh_path, materialize
from larder.sources.tables import write_parquet


def _order_dates(spark, sf_dir):
    return retail.read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("OrderID"),
        F.col("o_custkey").alias("MemberID"),
        F.to_date("o_orderdate").alias("OrderDate"),
        amount("o_totalprice", 18).alias("TotalAmount"),
    )


_ORDER_COLUMNS = """o_orderkey AS OrderID, o_custkey AS MemberID,
    CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS OrderDate,
    CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS TotalAmount"""


@query("scan_project", f"SELECT {_ORDER_COLUMNS} FROM orders")
def _scan_project(spark, sf_dir):
    return _order_dates(spark, sf_dir)


@query("roundtrip_parquet", f"SELECT {_ORDER_COLUMNS} FROM orders")
def _roundtrip_parquet(spark, sf_dir):
    path = fresh_path(spark, "roundtrip")
    orders = _order_dates(spark, sf_dir)
    write_parquet(orders, path, allow_empty=True)
    return spark.read.schema(orders.schema).parquet(path)


_PRUNED_YEAR = 1997


@query(
    "partitioned_year_prune",
    f"""SELECT {_ORDER_COLUMNS}, CAST(year(o_orderdate) AS INTEGER) AS Year
    FROM orders WHERE year(o_orderdate) = {_PRUNED_YEAR}""",
)
def _partitioned_year_prune(spark, sf_dir):
    path = fresh_path(spark, "orders-by-year")
    orders = _order_dates(spark, sf_dir).withColumn("Year", F.year("OrderDate"))
    write_parquet(orders, path, partition_by="Year", allow_empty=True)
    # an empty table leaves no folder to read the columns from
    return spark.read.schema(orders.schema).parquet(path).where(F.col("Year") == _PRUNED_YEAR)


_NUMBER_BLOCK = 1000


@query(
    "range_facts",
    f"""WITH present AS (SELECT DISTINCT o_orderkey AS n FROM orders),
    numbers AS (SELECT unnest(range((SELECT min(n) FROM present), (SELECT max(n) FROM present) + 1)) AS n)
    SELECT numbers.n // {_NUMBER_BLOCK} AS Block, count(*) AS Numbers, count(present.n) AS Orders,
           count(*) - count(present.n) AS MissingNumbers
    FROM numbers LEFT JOIN present USING (n) GROUP BY ALL""",
)
def _range_facts(spark, sf_dir):
    """Order numbers in use and missing, by blocks of numbers between the first and the last."""
    present = retail.orders(spark, sf_dir).select(F.col("OrderID").alias("id")).distinct()
    ends = present.agg(F.min("id").alias("first"), F.max("id").alias("last")).first()
    first, last = (0, -1) if ends["first"] is None else (ends["first"], ends["last"])
    numbers = spark.range(first, last + 1)
    return (
        numbers.join(present.withColumn("_used", F.lit(1)), "id", "left")
        .groupBy(F.floor(F.col("id") / _NUMBER_BLOCK).alias("Block"))
        .agg(F.count("*").alias("Numbers"), F.count("_used").alias("Orders"))
        .withColumn("MissingNumbers", F.col("Numbers") - F.col("Orders"))
    )


def _dated_calendar(spark, facts, id_column, counted, corrected):
    """The whole calendar, longer where facts lie outside, with the number of facts per day.

    The facts are read once: the counts per day, at most one row per day, are
    stored and also give the span.
    """
    per_day = materialize(
        facts.groupBy(F.col(id_column).alias("CalendarID")).agg(F.count("*").alias(counted)),
        "per-day",
    )
    span = per_day.agg(
        F.least(date_of_id(F.min("CalendarID")), F.lit(CALENDAR_START)).alias("first"),
        F.greatest(date_of_id(F.max("CalendarID")), F.lit(CALENDAR_END)).alias("last"),
    ).first()
    days = calendar(spark, span["first"], span["last"], corrected).drop("CreatedDate")
    return days.join(F.broadcast(per_day), "CalendarID", "left").withColumn(
        counted, F.coalesce(counted, F.lit(0).cast("bigint"))
    )


def _calendar_sql(dates: str, counted: str, corrected: bool) -> str:
    def integer(sql: str, name: str) -> str:
        return f"CAST({sql} AS INTEGER) AS {name}"

    shift = "d - INTERVAL 3 MONTH" if corrected else "d + INTERVAL 3 MONTH"
    quarter_start = "d = date_trunc('quarter', d)" if corrected else "0"
    quarter_end = "d = last_day(date_trunc('quarter', d) + INTERVAL 2 MONTH)" if corrected else "0"
    columns = [
        "CAST(d AS VARCHAR) AS CalendarDate",
        integer("date_diff('day', DATE '1980-01-01', d) + 1", "CalendarID"),
        integer("year(d)", "Year"),
        integer("quarter(d)", "Quarter"),
        integer("month(d)", "Month"),
        "monthname(d) AS MonthName",
        integer("day(d)", "Day"),
        integer("isodow(d)", "DayOfWeek"),
        "dayname(d) AS DayName",
        integer("weekofyear(d)", "WeekOfYear"),
        integer("isoyear(d)" if corrected else "year(d)", "ISOYear"),
        integer("weekofyear(d)", "ISOWeek"),
        integer("isodow(d) >= 6", "IsWeekend"),
        integer("0", "IsHoliday"),
        "CAST(NULL AS VARCHAR) AS HolidayName",
        integer("day(d) = 1", "IsMonthStart"),
        integer("d = last_day(d)", "IsMonthEnd"),
        integer(quarter_start, "IsQuarterStart"),
        integer(quarter_end, "IsQuarterEnd"),
        integer("day(d) = 1 AND month(d) = 1", "IsYearStart"),
        integer("day(d) = 31 AND month(d) = 12", "IsYearEnd"),
        integer("CASE WHEN month(d) >= 4 THEN year(d) + 1 ELSE year(d) END", "FiscalYear"),
        integer(f"month({shift})", "FiscalMonth"),
        integer(f"quarter({shift})", "FiscalQuarter"),
        integer("dayofyear(d)", "DayOfYear"),
        f"count(f.day) AS {counted}",
    ]
    return f"""WITH facts AS ({dates}),
    days AS (SELECT CAST(unnest(generate_series(least((SELECT min(day) FROM facts), DATE '{CALENDAR_START}')::TIMESTAMP,
               greatest((SELECT max(day) FROM facts), DATE '{CALENDAR_END}')::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS d)
    SELECT {', '.join(columns)}
    FROM days LEFT JOIN facts f ON f.day = days.d GROUP BY d"""


@query(
    "calendar_dim",
    _calendar_sql("SELECT CAST(o_orderdate AS DATE) AS day FROM orders", "Orders", False),
)
def _calendar_dim(spark, sf_dir):
    return _dated_calendar(spark, retail.orders(spark, sf_dir), "OrderDateID", "Orders", False)


@query(
    "calendar_iso_fiscal",
    _calendar_sql("SELECT CAST(l_shipdate AS DATE) AS day FROM lineitem", "Lines", True),
)
def _calendar_iso_fiscal(spark, sf_dir):
    return _dated_calendar(spark, retail.order_lines(spark, sf_dir), "ShipDateID", "Lines", True)


@query(
    "calendar_role_join",
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS OrderYear,
              CAST(quarter(o_orderdate) AS INTEGER) AS OrderQuarter,
              CAST(year(l_shipdate) AS INTEGER) AS ShipYear, dayname(l_shipdate) AS ShipDayName,
              count(*) AS Lines
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL""",
)
def _calendar_role_join(spark, sf_dir):
    # both date ids are in the joined row, so one count per pair of days comes
    # before the calendar joins
    pairs = (
        retail.order_lines(spark, sf_dir)
        .join(retail.orders(spark, sf_dir), "OrderID")
        .groupBy("OrderDateID", "ShipDateID")
        .agg(F.count("*").alias("_lines"))
    )
    dated = with_calendar(pairs, "OrderDateID", "Order", "Year", "Quarter")
    dated = with_calendar(dated, "ShipDateID", "Ship", "Year", "DayName")
    return dated.groupBy("OrderYear", "OrderQuarter", "ShipYear", "ShipDayName").agg(
        F.sum("_lines").alias("Lines")
    )


@query(
    "round_robin_fk",
    """WITH stores AS (SELECT s_suppkey, row_number() OVER (ORDER BY s_suppkey) - 1 AS position
                      FROM supplier)
    SELECT c_custkey AS MemberID, c_custkey % 51 + 1 AS StateID, s_suppkey AS FavoriteLocationID
    FROM customer JOIN stores ON position = c_custkey % (SELECT count(*) FROM supplier)""",
)
def _round_robin_fk(spark, sf_dir):
    members = retail.members(spark, sf_dir).select(
        "MemberID",
        keys.round_robin(F.col("MemberID"), len(dimensions.STATES)).alias("StateID"),
    )
    return assign_round_robin(
        members,
        F.col("MemberID"),
        retail.locations(spark, sf_dir),
        "LocationID",
        "FavoriteLocationID",
    )


@query(
    "surrogate_key",
    """SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS OrderSeq,
              o_orderkey AS OrderID FROM orders""",
)
def _surrogate_key(spark, sf_dir):
    dated = retail.orders(spark, sf_dir).select("OrderDateID", "OrderID")
    return dense_ids(dated, ["OrderDateID", "OrderID"], "OrderSeq").select("OrderSeq", "OrderID")


_GUID_SQL = """concat_ws('-', substr(h, 1, 8), substr(h, 9, 4), substr(h, 13, 4),
                         substr(h, 17, 4), substr(h, 21, 12))"""


@query(
    "stable_guid",
    f"""SELECT c_custkey AS MemberID, {_GUID_SQL} AS MemberGUID
    FROM (SELECT c_custkey, md5('member:' || CAST(c_custkey AS VARCHAR)) AS h FROM customer)""",
)
def _stable_guid(spark, sf_dir):
    return retail.members(spark, sf_dir).select(
        "MemberID", keys.stable_guid("member", F.col("MemberID")).alias("MemberGUID")
    )


@query(
    "format_business_keys",
    """SELECT 'store' AS Kind, s_suppkey AS Number, printf('SF-%05d', s_suppkey) AS BusinessKey,
              printf('(555)%03d-%04d', s_suppkey % 1000, s_suppkey % 10000) AS Phone FROM supplier
    UNION ALL SELECT 'item', p_partkey, printf('ITM-%04d', p_partkey), NULL FROM part
    UNION ALL SELECT 'member', c_custkey, printf('MBR-%07d', c_custkey),
              printf('(555)%03d-%04d', c_custkey % 1000, c_custkey % 10000) FROM customer
    UNION ALL SELECT DISTINCT 'employee', user_id, printf('EMP-%06d', user_id), NULL FROM events
    UNION ALL SELECT 'purchase', o_orderkey, printf('PO-%06d', o_orderkey), NULL FROM orders""",
)
def _format_business_keys(spark, sf_dir):
    kinds = [
        ("store", retail.locations(spark, sf_dir), "LocationID", keys.STORE_NUMBER, True),
        ("item", retail.items(spark, sf_dir), "ItemID", keys.ITEM_CODE, False),
        ("member", retail.members(spark, sf_dir), "MemberID", keys.MEMBER_NUMBER, True),
        (
            "employee",
            retail.punches(spark, sf_dir).select("EmployeeID").distinct(),
            "EmployeeID",
            keys.EMPLOYEE_NUMBER,
            False,
        ),
        ("purchase", retail.orders(spark, sf_dir), "OrderID", keys.PURCHASE_ORDER_NUMBER, False),
    ]
    parts = [
        df.select(
            F.lit(kind).alias("Kind"),
            F.col(key).alias("Number"),
            keys.business_key(pattern, F.col(key)).alias("BusinessKey"),
            (keys.phone_number(F.col(key)) if phone else F.lit(None).cast("string")).alias("Phone"),
        )
        for kind, df, key, pattern, phone in kinds
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


_SAMPLED = "CAST('0x' || substr(md5('{salt}-' || CAST({key} AS VARCHAR)), 1, 8) AS BIGINT)"


@query(
    "hash_sample",
    f"""SELECT o_orderkey AS OrderID, o_custkey AS MemberID FROM orders
    WHERE {_SAMPLED.format(salt='feedback', key='o_orderkey')} % 1000 < 10""",
)
def _hash_sample(spark, sf_dir):
    return (
        retail.orders(spark, sf_dir)
        .where(keys.sampled(F.col("OrderID"), 10, "feedback"))
        .select("OrderID", "MemberID")
    )


@query(
    "limit_first_n",
    """SELECT 'first 50 orders' AS Pick, o_orderkey AS Key FROM
         (SELECT o_orderkey FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 50)
    UNION ALL SELECT 'top 5 orders', o_orderkey FROM
         (SELECT o_orderkey FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5)""",
)
def _limit_first_n(spark, sf_dir):
    orders = retail.orders(spark, sf_dir)
    first = orders.orderBy("OrderDateID", "OrderID").limit(50)
    top = orders.orderBy(F.desc("StatedTotal"), "OrderID").limit(5)
    return first.select(F.lit("first 50 orders").alias("Pick"), F.col("OrderID").alias("Key")).union(
        top.select(F.lit("top 5 orders").alias("Pick"), F.col("OrderID").alias("Key"))
    )


@query("distinct_keys", "SELECT DISTINCT l_suppkey AS LocationID, l_partkey AS ItemID FROM lineitem")
def _distinct_keys(spark, sf_dir):
    return retail.order_lines(spark, sf_dir).select("LocationID", "ItemID").distinct()


@query(
    "global_minmax",
    f"""SELECT count(*) AS Orders, count(DISTINCT o_custkey) AS Members,
           min({o.date_id('o_orderdate')}) AS FirstDateID,
           max({o.date_id('o_orderdate')}) AS LastDateID,
           CAST(max(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS LargestTotal FROM orders""",
)
def _global_minmax(spark, sf_dir):
    return retail.orders(spark, sf_dir).agg(
        F.count("*").alias("Orders"),
        F.count_distinct("MemberID").alias("Members"),
        F.min("OrderDateID").alias("FirstDateID"),
        F.max("OrderDateID").alias("LastDateID"),
        F.max("StatedTotal").alias("LargestTotal"),
    )


@query(
    "region_counts",
    """SELECT r_name AS Region, count(*) AS Orders, count(DISTINCT c_custkey) AS Members
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey GROUP BY r_name""",
)
def _region_counts(spark, sf_dir):
    per_member = (
        retail.orders(spark, sf_dir).groupBy("MemberID").agg(F.count("*").alias("_orders"))
    )
    per_nation = (
        per_member.join(retail.members(spark, sf_dir), "MemberID")
        .groupBy("NationID")
        .agg(F.sum("_orders").alias("_orders"), F.count("*").alias("_members"))
    )
    nation = retail.read(spark, sf_dir, "nation")
    region = retail.read(spark, sf_dir, "region")
    return (
        per_nation.join(nation, F.col("NationID") == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
        .groupBy(F.col("r_name").alias("Region"))
        .agg(F.sum("_orders").alias("Orders"), F.sum("_members").alias("Members"))
    )


@query(
    "audit_json_extract",
    """SELECT event_type AS Action, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS Field,
           count(*) AS Changes, min(event_id) AS FirstAuditID
    FROM events GROUP BY ALL""",
)
def _audit_json_extract(spark, sf_dir):
    field = F.get_json_object("props", "$.k").try_cast("int")
    return (
        retail.read(spark, sf_dir, "events")
        .groupBy(F.col("event_type").alias("Action"), field.alias("Field"))
        .agg(F.count("*").alias("Changes"), F.min("event_id").alias("FirstAuditID"))
    )


@query(
    "state_tax_lookup",
    f"""WITH states(StateID, StateCode, TaxRate) AS (VALUES {o.values(
        [(k, code, rate) for k, code, _, _, rate in dimensions.state_rows()],
        ['BIGINT', 'VARCHAR', 'DECIMAL(6,5)'])}),
    {o.LINES}
    SELECT StateCode, count(*) AS Lines, CAST(sum(Gross) AS DOUBLE) AS Gross,
           CAST(round(sum(Gross) * TaxRate, 2) AS DOUBLE) AS StateTax
    FROM lines JOIN states ON StateID = LocationID % 51 + 1 GROUP BY StateCode, TaxRate""",
)
def _state_tax_lookup(spark, sf_dir):
    per_store = retail.order_lines(spark, sf_dir).groupBy("LocationID").agg(
        F.count("*").alias("Lines"), F.sum("Gross").alias("Gross")
    )
    state_id = keys.round_robin(F.col("LocationID"), len(dimensions.STATES)).cast("int")
    return (
        per_store.withColumn("StateID", state_id)
        .join(F.broadcast(dimensions.states(spark)), "StateID")
        .groupBy("StateCode", "TaxRate")
        .agg(F.sum("Lines").alias("Lines"), F.sum("Gross").alias("Gross"))
        .select(
            "StateCode",
            "Lines",
            "Gross",
            F.round(F.col("Gross") * F.col("TaxRate"), 2).alias("StateTax"),
        )
    )


