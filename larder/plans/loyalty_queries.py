"""Queries on loyalty points."""

from __future__ import annotations

from pyspark.sql import functions as F

from larder.functions.dates import date_of_id
from larder.operators import customers, points
from larder.operators.dimensions import REWARD_START_DATE_ID, REWARDS
from larder.plans import oracle as o
from larder.plans.registry import query
from larder.plans.sales_queries import store_orders
from larder.sources import retail
from larder.sources.scratch import materialize

# Points of the given month lapse after this many days.
POINTS_LIFE_DAYS = 10

STATEMENT = f"""moves AS (
      SELECT event_id AS TransactionID, user_id AS MemberID, ts,
             CASE WHEN event_type IN ('purchase', 'view', 'signup') THEN 'Earned' ELSE 'Redeemed' END AS TransactionType,
             CAST(floor(CAST(value AS DECIMAL(18,2))) AS BIGINT)
               * CASE WHEN event_type IN ('purchase', 'view', 'signup') THEN 1 ELSE -1 END AS Points, 1 AS kind
      FROM events),
    steps AS (
      SELECT * FROM moves UNION ALL
      SELECT TransactionID, MemberID, ts + INTERVAL {POINTS_LIFE_DAYS} DAY, 'Expired', -Points, 0 FROM moves
      WHERE Points > 0 AND ts + INTERVAL {POINTS_LIFE_DAYS} DAY <= (SELECT max(ts) FROM moves)),
    placed AS (
      SELECT *, row_number() OVER (PARTITION BY MemberID ORDER BY ts NULLS FIRST, kind, TransactionID) AS nth,
             coalesce(sum(CASE WHEN kind = 0 OR Points > 0 THEN Points END) OVER (
               PARTITION BY MemberID ORDER BY ts NULLS FIRST, kind, TransactionID ROWS UNBOUNDED PRECEDING), 0) AS most
      FROM steps),
    balances AS (
      WITH RECURSIVE walk AS (
        SELECT DISTINCT MemberID, CAST(0 AS BIGINT) AS nth, CAST(0 AS BIGINT) AS before, CAST(0 AS BIGINT) AS after FROM placed
        UNION ALL
        SELECT w.MemberID, p.nth, w.after,
               CAST(least(greatest(w.after + CASE WHEN kind = 0 THEN 0 ELSE coalesce(Points, 0) END, 0), most) AS BIGINT)
        FROM walk w JOIN placed p ON p.MemberID IS NOT DISTINCT FROM w.MemberID AND p.nth = w.nth + 1)
      SELECT * FROM walk WHERE nth > 0)"""


@query(
    "points_expiry",
    f"""WITH {STATEMENT}
    SELECT TransactionID, p.MemberID, {o.date_id('ts')} AS TransactionDateID, TransactionType,
           CASE WHEN kind = 1 THEN Points END AS RequestedPoints, after - before AS Points, after AS BalanceAfter
    FROM placed p JOIN balances b ON b.MemberID IS NOT DISTINCT FROM p.MemberID AND b.nth = p.nth
    WHERE kind = 1 OR after <> before""",
)
def _points_expiry(spark, sf_dir):
    return points.points_expiry(retail.points_transactions(spark, sf_dir), POINTS_LIFE_DAYS)


@query(
    "rewards_redeemable",
    f"""WITH {STATEMENT},
    lasts AS (
      SELECT p.MemberID, after AS Balance, {o.date_id('ts')} AS LastDateID
      FROM placed p JOIN balances b ON b.MemberID IS NOT DISTINCT FROM p.MemberID AND b.nth = p.nth
      QUALIFY row_number() OVER (PARTITION BY p.MemberID ORDER BY p.nth DESC) = 1),
    rewards(RewardID, RewardCode, PointsCost) AS (
      VALUES {o.values([(key, code, cost) for key, (code, _, cost) in enumerate(REWARDS, 1)], ['BIGINT', 'VARCHAR', 'BIGINT'])}),
    dearer AS (SELECT r.*, (SELECT min(x.PointsCost) FROM rewards x WHERE x.PointsCost > r.PointsCost) AS following FROM rewards r)
    SELECT MemberID, Balance, RewardID, RewardCode, PointsCost, Balance // PointsCost AS Times, Balance - PointsCost AS PointsLeft,
           CASE WHEN following IS NOT NULL THEN greatest(following - Balance, 0) END AS PointsToNext,
           coalesce(LastDateID >= {REWARD_START_DATE_ID}, FALSE) AS OnOffer
    FROM lasts JOIN dearer ON PointsCost <= Balance""",
)
def _rewards_redeemable(spark, sf_dir):
    statement = points.points_statement(retail.points_transactions(spark, sf_dir), POINTS_LIFE_DAYS)
    offers = [(key, code, cost) for key, (code, _, cost) in enumerate(REWARDS, 1)]
    return points.redeemable(statement, offers, REWARD_START_DATE_ID)


@query(
    "customers_rollup",
    f"""WITH {o.STORE_ORDERS}, visits AS (
      SELECT LocationID, OrderDateID, MemberID, CAST(year(OrderDate) AS VARCHAR) AS y, r_name AS r
      FROM store_orders LEFT JOIN supplier ON s_suppkey = LocationID LEFT JOIN nation ON n_nationkey = s_nationkey
      LEFT JOIN region ON r_regionkey = n_regionkey)
    SELECT 'Year' AS Level, y AS Span, count(DISTINCT MemberID) AS Customers,
           count(DISTINCT (LocationID, OrderDateID)) AS StoreDays, TRUE AS WithinError
    FROM visits WHERE y IS NOT NULL GROUP BY y
    UNION ALL SELECT 'Region', r, count(DISTINCT MemberID), count(DISTINCT (LocationID, OrderDateID)), TRUE
    FROM visits WHERE r IS NOT NULL GROUP BY r""",
)
def _customers_rollup(spark, sf_dir):
    visits = store_orders(spark, sf_dir, "MemberID").select("LocationID", "OrderDateID", "MemberID")
    sketches = materialize(customers.store_day_sketches(visits), "customers")
    years = sketches.select("OrderDateID").distinct().select("OrderDateID", F.year(date_of_id(F.col("OrderDateID"))).cast("string").alias("Span"))
    nations = retail.read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("NationID"), F.col("n_regionkey").alias("RegionID"))
    regions = retail.read(spark, sf_dir, "region").select(F.col("r_regionkey").alias("RegionID"), F.col("r_name").alias("Span"))
    places = retail.locations(spark, sf_dir).join(nations, "NationID").join(regions, "RegionID").select("LocationID", "Span")
    by_year = customers.rollup(visits, sketches, years, "OrderDateID", "Span").withColumn("Level", F.lit("Year"))
    by_region = customers.rollup(visits, sketches, places, "LocationID", "Span").withColumn("Level", F.lit("Region"))
    return by_year.unionByName(by_region).where(F.col("Span").isNotNull()).select("Level", "Span", "Customers", "StoreDays", "WithinError")
