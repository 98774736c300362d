"""Members: points balance, lifetime value, feedback."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.functions.money import ratio
from larder.operators.running import running_sum
from larder.operators.surrogate import assign_round_robin

# Tier and the lifetime spend it starts at.
TIERS = [("Platinum", 3_000_000), ("Gold", 2_000_000), ("Silver", 1_000_000)]
LOWEST_TIER = "Bronze"
RATING_STEP = 25.0


def points_balance(transactions: DataFrame) -> DataFrame:
    """Balance after each points transaction of a member."""
    return running_sum(
        transactions,
        ["MemberID"],
        ["TransactionTime", "TransactionID"],
        "Points",
        "BalanceAfter",
    )


def member_lifetime(members: DataFrame, orders: DataFrame) -> DataFrame:
    """Orders, spend, points and tier per member, also of those who never ordered."""
    spent = orders.groupBy("MemberID").agg(
        F.count("*").alias("Orders"),
        F.sum("StatedTotal").alias("TotalSpent"),
        F.sum(F.floor("StatedTotal").cast("bigint")).alias("LifetimePoints"),
        F.max("OrderDateID").alias("LastOrderDateID"),
    )
    tier = F.lit(LOWEST_TIER)
    for name, floor in reversed(TIERS):
        tier = F.when(F.col("TotalSpent") >= floor, name).otherwise(tier)
    return (
        members.select("MemberID")
        .join(spent, "MemberID", "left")
        .withColumn("Orders", F.coalesce("Orders", F.lit(0).cast("bigint")))
        .withColumn("TotalSpent", F.coalesce("TotalSpent", F.lit(0)).cast("decimal(28,2)"))
        .withColumn("LifetimePoints", F.coalesce("LifetimePoints", F.lit(0).cast("bigint")))
        .withColumn("MembershipTier", tier)
    )


def feedback(ratings: DataFrame) -> DataFrame:
    """A rating of 1 to 5 from the value of each event: one step per ``RATING_STEP``."""
    step = F.floor(F.col("Value") / RATING_STEP)
    rating = (F.greatest(F.least(step, F.lit(4)), F.lit(0)) + 1).cast("int")
    return ratings.select(
        "FeedbackID", "MemberID", F.when(F.col("Value").isNotNull(), rating).alias("OverallRating")
    )


def feedback_by_store(given: DataFrame, stores: DataFrame) -> DataFrame:
    """Average rating per store, members being dealt to the stores by position."""
    rated = assign_round_robin(
        given.where(F.col("OverallRating").isNotNull()), F.col("MemberID"), stores, "LocationID", "LocationID"
    )
    return (
        rated.groupBy("LocationID")
        .agg(F.count("*").alias("Responses"), F.sum("OverallRating").alias("_sum"))
        .select("LocationID", "Responses", ratio(F.col("_sum"), F.col("Responses")).alias("AverageRating"))
    )
