"""Promotions, targets and combos used by the queries, in the period of the orders."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.functions.dates import calendar_id
from larder.sources.inline import inline_rows


def _day(year: int, month: int, day: int) -> int:
    return calendar_id(dt.date(year, month, day))


# id, code, percentage, amount, first day, last day (None: open), channels,
# weekday class, from, to, minimum purchase, active, members only, uses per
# member, uses in total
CAMPAIGNS = [
    (1, "YEAR-97", "10.00", None, _day(1997, 1, 1), _day(1997, 12, 31), "All", "All", None, None, None, 1, 1, 2, None),
    (2, "FIVE-OFF", None, "5.00", _day(1998, 6, 1), None, "All", "Weekdays", None, None, "25.00", 1, 0, None, None),
    (3, "WEB-15", "15.00", None, _day(1996, 3, 1), _day(1999, 3, 1), "WEB", "All", None, None, "1000.00", 1, 0, None, 400),
    (4, "WEEKEND-20", "20.00", None, _day(1995, 1, 1), _day(1996, 12, 31), "All", "Weekends", None, None, None, 1, 0, 1, 300),
    (5, "LUNCH", None, "500.00", _day(1995, 6, 1), _day(2000, 6, 1), "MOBILE,WEB", "All", "11:00:00", "14:00:00", "50000.00", 1, 0, None, None),
    (6, "LOCAL-12", "12.00", None, _day(1996, 1, 1), None, "INSTORE", "Weekdays", None, None, None, 1, 0, None, None),
    (7, "ITEM-25", "25.00", None, _day(1999, 1, 1), _day(2000, 12, 31), "All", "All", None, None, None, 1, 0, None, None),
    (8, "WITHDRAWN", "90.00", None, _day(1995, 1, 1), None, "All", "All", None, None, None, 0, 0, None, None),
]
# the campaigns that may be combined with others
STACKABLE = (2, 3, 4, 5, 6, 7)
CAMPAIGN_TYPES = (
    "PromotionID bigint, PromotionCode string, DiscountPercentage decimal(5,2),"
    " DiscountAmount decimal(8,2), StartDateID int, EndDateID int, ApplicableChannels string,"
    " ApplicableDays string, ApplicableTimeStart string, ApplicableTimeEnd string,"
    " MinimumPurchaseAmount decimal(8,2), IsActive int, RequiresLoyaltyMembership int,"
    " MaxUsagePerCustomer int, MaxTotalUsage int"
)

# promotion, item, category, combo: exactly one of the last three
TARGETS = [
    (7, None, "ECONOMY", None),
    (7, 4, None, None),
    (7, None, None, 1),
    (3, None, None, 0),
    (3, 51, None, None),
    (3, 107, None, None),
    (3, None, "SMALL", None),
]
TARGET_TYPES = "PromotionID bigint, ItemID bigint, Category string, ComboID bigint"

LOCAL_CAMPAIGNS = [6]
COMBO_SPAN = 50
COMBO_OFFSETS = (0, 7, 21)


def campaigns(spark: SparkSession) -> DataFrame:
    return inline_rows(spark, CAMPAIGNS, CAMPAIGN_TYPES)


def stackable_campaigns(spark: SparkSession) -> DataFrame:
    return campaigns(spark).withColumn("IsStackable", F.col("PromotionID").isin(*STACKABLE).cast("int"))


def targets(spark: SparkSession) -> DataFrame:
    return inline_rows(spark, TARGETS, TARGET_TYPES)


def campaign_stores(locations: DataFrame) -> DataFrame:
    """Local campaigns run in the stores with an odd number."""
    local = F.explode(F.array(*[F.lit(key).cast("bigint") for key in LOCAL_CAMPAIGNS]))
    return locations.where(F.col("LocationID") % 2 == 1).select(
        local.alias("PromotionID"), "LocationID"
    )


def combo_items(items: DataFrame) -> DataFrame:
    """Every run of fifty menu items makes a combo of three of them."""
    key = F.col("ItemID")
    return items.where((key % COMBO_SPAN).isin(*COMBO_OFFSETS)).select(
        F.floor(key / COMBO_SPAN).alias("ComboID"),
        "ItemID",
        (key % 3 + 1).cast("int").alias("ComponentQuantity"),
    )


def combos(items: DataFrame) -> DataFrame:
    """A combo is sold under the number of its first item."""
    key = F.col("ItemID")
    return items.where(key % COMBO_SPAN == 0).select(
        F.floor(key / COMBO_SPAN).alias("ComboID"), "ItemID"
    )
