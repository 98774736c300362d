"""Promotions: validity in time, targets, applicability and best discount."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions.dates import date_of_id, iso_weekday
from larder.functions.money import amount
from larder.operators.running import running_sum
from larder.operators.sales import CHANNELS
from larder.sources.scratch import materialize


def promotion_days(promotions: DataFrame, last: int) -> DataFrame:
    """One row per promotion and day it runs, up to the day ``last``, where those without an end stop."""
    end = F.least(F.coalesce(F.col("EndDateID"), F.lit(last)), F.lit(last))
    return (
        promotions.withColumn("_end", end)
        .where(F.col("StartDateID") <= F.col("_end"))
        .withColumn("OrderDateID", F.explode(F.sequence(F.col("StartDateID"), F.col("_end"))))
        .drop("_end")
    )


def running_promotions(facts: DataFrame, promotions: DataFrame, last: int | None = None) -> DataFrame:
    """Join every fact to the promotions that run on its date.

    Intervals become days and the interval join an equi join, which hashes. The
    days end with the last fact; pass its date where it is cheaper to find.
    """
    if last is None:
        last = facts.agg(F.max("OrderDateID")).first()[0]
    days = promotion_days(promotions, 0 if last is None else last)
    return facts.join(days, "OrderDateID")


def promotion_items(targets: DataFrame, items: DataFrame, combo_items: DataFrame) -> DataFrame:
    """The items each promotion targets.

    A target row names an item, a category or a combo; each kind is expanded to
    items by its own join. An item reached twice counts once.
    """
    by_item = targets.where(F.col("ItemID").isNotNull()).select("PromotionID", "ItemID")
    by_category = items.select("ItemID", "Category").join(
        targets.where(F.col("Category").isNotNull()).select("PromotionID", "Category"),
        "Category",
    )
    by_combo = combo_items.select("ComboID", "ItemID").join(
        targets.where(F.col("ComboID").isNotNull()).select("PromotionID", "ComboID"),
        "ComboID",
    )
    parts = [df.select("PromotionID", "ItemID") for df in (by_item, by_category, by_combo)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).distinct()


def _channel_applies(channel_id: Column) -> Column:
    code = F.get(F.array(*[F.lit(c) for _, c, _, _ in CHANNELS]), channel_id - 1)
    allowed = F.col("ApplicableChannels")
    return (allowed == "All") | F.coalesce(F.find_in_set(code, allowed) > 0, F.lit(False))


def _day_applies(date: Column) -> Column:
    days = F.coalesce(F.col("ApplicableDays"), F.lit("All"))
    weekend = iso_weekday(date) >= 6
    return (days == "All") | ((days == "Weekends") & weekend) | ((days == "Weekdays") & ~weekend)


def _clock_seconds(time: Column) -> Column:
    part = lambda n: F.split_part(time, F.lit(":"), F.lit(n)).cast("int")
    return part(1) * 3600 + part(2) * 60 + part(3)


def _time_applies(second: Column) -> Column:
    start, end = F.col("_from"), F.col("_to")
    return (start.isNull() | (second >= start)) & (end.isNull() | (second <= end))


def applicable_promotions(
    by_store: DataFrame,
    lines: DataFrame,
    promotions: DataFrame,
    targets: DataFrame,
    targeted_items: DataFrame,
    promotion_stores: DataFrame,
    last: int | None = None,
) -> DataFrame:
    """Store orders with each promotion that applies to them, their gross amount and the discount.

    A promotion applies by date, channel, weekday class, time of day and minimum
    purchase, and in its stores if it lists any, while it is active, for members
    where it demands that, and up to its limits of uses. It discounts the items
    its ``targets`` expand to if it has any, else the whole store order.
    What applies is stored once, before uses are counted.
    """
    ids = ["OrderID", "LocationID", "PromotionID"]
    promotions = promotions.where(F.col("IsActive") == 1)
    targeted = targets.select("PromotionID").distinct()
    stores = promotion_stores.select("PromotionID", "LocationID").distinct()
    restricted = stores.select("PromotionID").distinct()
    flagged = (
        promotions.join(targeted.withColumn("_targeted", F.lit(True)), "PromotionID", "left")
        .join(restricted.withColumn("_restricted", F.lit(True)), "PromotionID", "left")
        # clock times are parsed once per promotion and compared as numbers
        .withColumns({"_from": _clock_seconds(F.col("ApplicableTimeStart")), "_to": _clock_seconds(F.col("ApplicableTimeEnd"))})
    )
    eligible = (
        lines.join(targeted_items, "ItemID").groupBy(*ids).agg(F.sum("Gross").alias("_targets"))
    )
    candidates = running_promotions(by_store, flagged, last).where(
        _channel_applies(F.col("ChannelID"))
        & _day_applies(date_of_id(F.col("OrderDateID")))
        & _time_applies(F.col("OrderSecond"))
        & (F.col("Gross") >= F.coalesce("MinimumPurchaseAmount", F.lit(0)))
        & ((F.col("RequiresLoyaltyMembership") == 0) | F.col("MemberID").isNotNull())
    )
    base = F.when(F.col("_targeted"), F.coalesce("_targets", F.lit(0))).otherwise(F.col("Gross"))
    discount = F.coalesce(
        F.round(F.col("_base") * F.col("DiscountPercentage") / 100, 2).cast("decimal(22,2)"),
        F.least(F.col("DiscountAmount"), F.col("_base")).cast("decimal(22,2)"),
    )
    applied = (
        candidates.join(
            stores.withColumn("_in_store", F.lit(True)), ["PromotionID", "LocationID"], "left"
        )
        .where(F.col("_restricted").isNull() | F.col("_in_store"))
        .join(eligible, ids, "left")
        .withColumn("_base", base.cast("decimal(22,2)"))
        .withColumn("Discount", discount)
        .where(F.col("Discount") > 0)
        .select(*ids, "OrderDateID", "MemberID", "Gross", "Discount", *LIMITS)
    )
    limited = F.col("MaxUsagePerCustomer").isNotNull() | F.col("MaxTotalUsage").isNotNull()
    stored = materialize(applied, "uses")
    free = stored.where(~limited).select(*ids, "Gross", "Discount")
    return free.unionByName(within_limits(stored.where(limited)).select(*ids, "Gross", "Discount"))


LIMITS = ["MaxUsagePerCustomer", "MaxTotalUsage"]
_USE_ORDER = ["OrderDateID", "OrderID", "LocationID"]


def within_limits(uses: DataFrame) -> DataFrame:
    """The uses that come early enough, counted per promotion and member, then per promotion.

    A use that the member's limit denies does not count against the promotion's
    limit, and guests, who have no member, have no limit of their own. Both counts
    are running totals over ranges, so no task holds all uses of a promotion.
    """
    counted = ["_nth", "_own", "_one"]
    one = uses.withColumn("_one", F.lit(1).cast("bigint"))
    personal = F.col("MaxUsagePerCustomer").isNotNull() & F.col("MemberID").isNotNull()
    own = running_sum(one.where(personal), ["PromotionID", "MemberID"], _USE_ORDER, "_one", "_own")
    allowed = one.where(~personal).unionByName(own.where(F.col("_own") <= F.col("MaxUsagePerCustomer")).drop("_own"))
    total = F.col("MaxTotalUsage").isNotNull()
    nth = running_sum(allowed.where(total), ["PromotionID"], _USE_ORDER, "_one", "_nth")
    return allowed.where(~total).unionByName(nth.where(F.col("_nth") <= F.col("MaxTotalUsage")).drop("_nth")).drop(*counted)


def best_discount(applicable: DataFrame) -> DataFrame:
    """The largest discount per store order; the lowest promotion id wins a tie.

    A maximum rather than a ranking: it combines before the shuffle.
    """
    best = F.max(F.struct("Discount", (-F.col("PromotionID")).alias("_rank")))
    return (
        applicable.groupBy("OrderID", "LocationID")
        .agg(best.alias("_best"), F.count("*").alias("Promotions"))
        .select(
            "OrderID",
            "LocationID",
            (-F.col("_best._rank")).alias("PromotionID"),
            F.col("_best.Discount").alias("Discount"),
            "Promotions",
        )
    )


def best_stack(applicable: DataFrame, promotions: DataFrame) -> DataFrame:
    """The best set of promotions that a store order may combine, and its discount.

    A promotion that is not stackable stands alone. Stackable ones add up, but of
    those that take a percentage only one counts, the best. The set is the larger of
    both, never more than the order's gross amount; a single promotion wins a tie, and
    the lowest id among equals. The choice is made from sums and maxima per
    order, which combine before the shuffle; the sets themselves hold at most the
    promotions that run at the same time.
    """
    kinds = promotions.select("PromotionID", F.col("IsStackable") == 1, F.col("DiscountPercentage").isNotNull()).toDF("PromotionID", "_stacks", "_percent")
    entry = F.struct("Discount", (-F.col("PromotionID")).alias("_rank"))
    stacks, percent = F.col("_stacks"), F.col("_percent")
    sums = applicable.join(kinds, "PromotionID").groupBy("OrderID", "LocationID").agg(
        F.max(entry).alias("_single"),
        F.max(F.when(stacks & percent, entry)).alias("_best"),
        F.coalesce(F.sum(F.when(stacks & ~percent, F.col("Discount"))), F.lit(0)).alias("_amounts"),
        F.collect_list(F.when(stacks & ~percent, F.col("PromotionID"))).alias("_ids"),
        F.max("Gross").alias("_gross"),
    )
    single = F.col("_single.Discount")
    together = F.least(F.coalesce(F.col("_best.Discount"), F.lit(0)) + F.col("_amounts"), F.col("_gross")).cast("decimal(22,2)")
    alone = single >= together
    ids = F.when(F.col("_best").isNotNull(), F.concat(F.array(-F.col("_best._rank")), "_ids")).otherwise(F.col("_ids"))
    chosen = F.when(alone, F.array(-F.col("_single._rank"))).otherwise(F.array_sort(ids))
    return sums.select(
        "OrderID", "LocationID", F.array_join(chosen.cast("array<string>"), ",").alias("PromotionIDs"),
        F.size(chosen).alias("Promotions"), F.when(alone, single).otherwise(together).alias("Discount"),
    )


def promotion_bridge(parents: DataFrame, promotions: DataFrame, key: str) -> DataFrame:
    """Attach the first promotion to every row of ``parents``."""
    first = promotions.agg(F.min("PromotionID")).first()[0]
    return parents.select(key).withColumn("PromotionID", F.lit(first).cast("bigint"))


def combo_units(lines: DataFrame, combo_items: DataFrame, combos: DataFrame) -> DataFrame:
    """Units of each component needed for the combos sold.

    ``combos`` names the item a combo is sold as. Sales are summed per item
    first, so the expansion works on one row per combo.
    """
    sold = lines.groupBy("ItemID").agg(F.sum("Quantity").alias("UnitsSold"))
    return (
        combos.select("ComboID", "ItemID")
        .join(sold, "ItemID")
        .select("ComboID", "UnitsSold")
        .join(combo_items, "ComboID")
        .select(
            "ComboID",
            "ItemID",
            "ComponentQuantity",
            "UnitsSold",
            (F.col("UnitsSold") * amount("ComponentQuantity", 6, 0)).alias("UnitsNeeded"),
        )
    )
