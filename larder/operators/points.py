"""Loyalty points that lapse: balances first in first out, and the lots behind each use."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.functions.dates import date_id
from larder.operators.running import running_sum
from larder.operators.scan import apply_clamped, clamped, scan_before, then_clamped

ORDER = ["TransactionTime", "_kind", "TransactionID"]


def with_expiries(transactions: DataFrame, life_days: int) -> DataFrame:
    """The transactions, and for each lot of earned points the moment it lapses, up to the last transaction.

    A lot earned at t lapses at t + ``life_days``, before anything else of that moment.
    """
    last = transactions.agg(F.max("TransactionTime")).first()[0]
    moves = transactions.select(
        "TransactionID", "MemberID", "TransactionTime", "TransactionType", F.col("Points").cast("bigint").alias("Points"), F.lit(1).alias("_kind"),
    )
    lapse = (F.col("TransactionTime") + F.expr(f"INTERVAL {int(life_days)} DAYS")).cast(moves.schema["TransactionTime"].dataType)
    expiries = moves.where(F.col("Points") > 0).withColumns(
        {"TransactionTime": lapse, "TransactionType": F.lit("Expired"), "Points": -F.col("Points"), "_kind": F.lit(0)}
    )
    return moves.unionByName(expiries.where(F.col("TransactionTime") <= F.lit(last)))


def points_statement(transactions: DataFrame, life_days: int) -> DataFrame:
    """Every transaction and lapse with the points it moved and the balance after it, never below zero.

    Uses take the oldest points that have not lapsed, and no more than there are;
    ``RequestedPoints`` says what was asked for. As lots have one life, they lapse in
    the order in which they were earned, so a balance never exceeds the points earned
    and not yet lapsed, and what a lapse leaves in excess of them is what is left of
    the lot. A step thus is a bounded addition, and steps in a row are one again
    (``scan``), so the balances of one member are computed over ranges.

    A NULL number of points moves nothing; rows without a time come first and never lapse.
    """
    moves = with_expiries(transactions, life_days)
    points = F.coalesce("Points", F.lit(0).cast("bigint"))
    live = moves.withColumn("_live", F.when((F.col("_kind") == 0) | (points > 0), points).otherwise(F.lit(0).cast("bigint")))
    ceiling = running_sum(live, ["MemberID"], ORDER, "_live", "_most")
    zero = F.lit(0).cast("bigint")
    step = clamped(F.when(F.col("_kind") == 0, zero).otherwise(points), zero, F.col("_most"))
    earlier = scan_before(ceiling, ["MemberID"], ORDER, step, then_clamped, "_earlier")
    before = apply_clamped(F.col("_earlier"), zero)
    return (
        earlier.withColumn("_before", before)
        .withColumn("BalanceAfter", F.least(F.greatest(F.col("_before") + F.when(F.col("_kind") == 0, zero).otherwise(points), zero), F.col("_most")))
        .select(
            "TransactionID", "MemberID", "TransactionTime", date_id(F.to_date("TransactionTime")).alias("TransactionDateID"), "TransactionType",
            F.when(F.col("_kind") == 1, F.col("Points")).alias("RequestedPoints"),
            (F.col("BalanceAfter") - F.col("_before")).alias("Points"), "BalanceAfter", "_kind",
        )
    )


def points_expiry(transactions: DataFrame, life_days: int) -> DataFrame:
    """The statement without lapses of lots that were used up before."""
    statement = points_statement(transactions, life_days)
    return statement.where((F.col("_kind") == 1) | (F.col("Points") != 0)).drop("_kind", "TransactionTime")


def redeemable(statement: DataFrame, rewards: Sequence[tuple[int, str, int]], start_date_id: int) -> DataFrame:
    """One row per member and reward that the points left after the member's last step can pay for.

    ``rewards`` holds (RewardID, RewardCode, PointsCost), costs above zero. ``OnOffer`` says whether
    they are on offer, from ``start_date_id`` on, by the day of that step (not if it has none). ``Times`` says how often the reward could be taken and ``PointsLeft`` what taking it
    once leaves; ``PointsToNext`` is what is missing for the next dearer reward, NULL
    behind the dearest. The last step of a member is found by a combining aggregate, and the rewards are
    held by each row, so a hot member is no hot task. NULL is a member like any other.
    """
    order = F.struct(*ORDER)
    last = statement.groupBy("MemberID").agg(
        F.max_by(F.struct("BalanceAfter", "TransactionDateID"), order).alias("_last")
    ).select("MemberID", F.col("_last.BalanceAfter").alias("Balance"), F.col("_last.TransactionDateID").alias("LastDateID"))
    costs = sorted({cost for _, _, cost in rewards})
    following = dict(zip(costs, costs[1:], strict=False))
    offers = [
        F.struct(
            F.lit(key).cast("bigint").alias("RewardID"), F.lit(code).alias("RewardCode"), F.lit(cost).cast("bigint").alias("PointsCost"),
            F.lit(following.get(cost)).cast("bigint").alias("_next"),
        )
        for key, code, cost in rewards
    ]
    if not offers:
        raise ValueError("no rewards")
    paid = F.filter(F.array(*offers), lambda r: r["PointsCost"] <= F.col("Balance"))
    on_offer = F.coalesce(F.col("LastDateID") >= start_date_id, F.lit(False)).alias("OnOffer")
    return last.select("MemberID", "Balance", on_offer, F.inline(paid)).select(
        "MemberID", "Balance", "RewardID", "RewardCode", "PointsCost", F.expr("Balance div PointsCost").alias("Times"),
        (F.col("Balance") - F.col("PointsCost")).alias("PointsLeft"),
        F.greatest(F.col("_next") - F.col("Balance"), F.when(F.col("_next").isNotNull(), F.lit(0))).cast("bigint").alias("PointsToNext"), "OnOffer",
    )
