"""Orders, lines and the daily store summary."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions.dates import date_of_id, iso_weekday
from larder.functions.money import DELIVERY_FEE, amount, ratio, sales_tax, total
from larder.operators.calendar import with_calendar
from larder.operators.ranges import same_keys
from larder.operators.surrogate import dense_ids
from larder.sources.inline import inline_rows
from larder.sources.scratch import materialize

#: More than any store number.
LOCATIONS = 10**10
STORE_DAY = ["LocationID", "OrderDateID"]
LINE_AMOUNTS = ["Quantity", "Gross", "Discount", "LineTax", "Refund", "Cost"]

# Channel id, code, name, and the summary column it counts in.
CHANNELS = [
    (1, "INSTORE", "In-Store", "InStoreSales"),
    (2, "DRIVETHRU", "Drive-Thru", "DriveThruSales"),
    (3, "MOBILE", "Mobile App", "OnlineSales"),
    (4, "WEB", "Website", "OnlineSales"),
    (5, "KIOSK", "Self-Service Kiosk", "InStoreSales"),
    (6, "THIRDPARTY", "Third Party Delivery", "DeliverySales"),
]
CHANNEL_COLUMNS = ["InStoreSales", "DriveThruSales", "OnlineSales", "DeliverySales"]
PAYMENT_COLUMNS = {
    "CashPayments": "Cash",
    "CardPayments": "CreditCard",
    "MobilePayments": "MobileWallet",
}


def dated_lines(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """Lines with the date and other columns of their order.

    Enough for daily sums, which add up lines as well as orders. The next
    grouping is by store and day, so a hot order is split without extra cost.
    """
    return lines.join(orders, "OrderID")


def store_orders(lines: DataFrame, orders: DataFrame, cost: Column | None = None) -> DataFrame:
    """One row per order and store, with the sums of its lines there.

    For results that count orders. The columns of ``orders`` are kept; select the needed ones beforehand, as
    grouping columns are not pruned. The lines are shuffled once, on the order:
    the grouping reuses the partitioning of the join. Sums nobody reads are
    pruned. A ``cost`` is worked out after that shuffle, as it is wider than what it is made of.
    """
    dated = lines.join(orders, "OrderID")
    if cost is not None:
        dated = dated.withColumn("Cost", cost)
    sums = [name for name in LINE_AMOUNTS if name in dated.columns]
    return (
        dated.groupBy(*dict.fromkeys([*orders.columns, "LocationID"]))
        .agg(*total(*sums), F.count("*").alias("Lines"))
    )


def daily_sales(by_store: DataFrame) -> DataFrame:
    """Orders, gross sales, tax and average order value per store and day."""
    daily = by_store.groupBy(*STORE_DAY).agg(
        F.count("OrderID").alias("TotalOrders"), F.sum("Gross").alias("GrossSales")
    )
    return with_calendar(daily, "OrderDateID", "", "CalendarDate", "Year").select(
        *STORE_DAY,
        "CalendarDate",
        "Year",
        "TotalOrders",
        "GrossSales",
        sales_tax(F.col("GrossSales")).alias("TaxCollected"),
        ratio(F.col("GrossSales"), F.col("TotalOrders")).alias("AverageOrderValue"),
    )


def daily_customers(by_store: DataFrame) -> DataFrame:
    return by_store.groupBy(*STORE_DAY).agg(
        F.count("OrderID").alias("TotalOrders"),
        F.count_distinct("MemberID").alias("TotalCustomers"),
    )


def channel_sales(dated: DataFrame) -> DataFrame:
    """Tag each row with the summary column of its channel."""
    channels = inline_rows(
        dated.sparkSession,
        [(key, column) for key, _, _, column in CHANNELS],
        "ChannelID int, ChannelColumn string",
    )
    return dated.join(F.broadcast(channels), "ChannelID", "left")


def _sum_where(condition: Column, value: str) -> Column:
    return F.sum(F.when(condition, F.col(value)).otherwise(amount(F.lit(0))))


def channel_columns() -> list[Column]:
    return [
        _sum_where(F.col("ChannelColumn") == name, "Gross").alias(name) for name in CHANNEL_COLUMNS
    ]


def payment_columns() -> list[Column]:
    return [
        _sum_where(F.col("PaymentMethod") == method, "Gross").alias(name)
        for name, method in PAYMENT_COLUMNS.items()
    ]


def daily_channel_pivot(dated: DataFrame) -> DataFrame:
    """Sales by channel and by payment method as columns, per store and day.

    Sums are of whole hundredths, which an aggregation keeps in place, and become
    DECIMAL again at the end.
    """
    cents = channel_sales(dated).withColumn("_cents", (F.col("Gross") * 100).cast("bigint"))
    where = {name: F.col("ChannelColumn") == name for name in CHANNEL_COLUMNS}
    where |= {name: F.col("PaymentMethod") == method for name, method in PAYMENT_COLUMNS.items()}
    sums = [F.sum(F.when(condition, F.col("_cents")).otherwise(0)).alias(name) for name, condition in where.items()]
    back = [(F.col(name).cast("decimal(20,0)") * F.lit(Decimal("0.01"))).alias(name) for name in where]
    return cents.groupBy(*STORE_DAY).agg(*sums).select(*STORE_DAY, *back)


def daily_net_sales(dated: DataFrame) -> DataFrame:
    """Gross sales less discounts and refunds, per store and day."""
    return (
        dated.groupBy(*STORE_DAY)
        .agg(
            F.sum("Gross").alias("GrossSales"),
            F.sum("Discount").alias("Discounts"),
            F.sum("Refund").alias("Refunds"),
        )
        .withColumn("NetSales", F.col("GrossSales") - F.col("Discounts") - F.col("Refunds"))
    )


def daily_basket_size(by_store: DataFrame) -> DataFrame:
    return (
        by_store.groupBy(*STORE_DAY)
        .agg(F.count("OrderID").alias("TotalOrders"), F.sum("Quantity").alias("Items"))
        .withColumn("AverageItemsPerOrder", ratio(F.col("Items"), F.col("TotalOrders")))
    )


def with_unit_cost(lines: DataFrame, costs: DataFrame) -> DataFrame:
    return lines.join(costs.select("ItemID", "UnitCost"), "ItemID", "left")


def line_cost() -> Column:
    """Ingredient cost of a line with its unit cost; an item without a recipe costs nothing."""
    return F.coalesce(F.col("Quantity") * F.col("UnitCost"), F.lit(0))


def with_cost(lines: DataFrame, costs: DataFrame) -> DataFrame:
    """Add the ingredient cost of each line."""
    return with_unit_cost(lines, costs).withColumn("Cost", line_cost())


def daily_cogs(dated: DataFrame) -> DataFrame:
    """Cost of goods sold per store and day, from lines that carry their cost."""
    return dated.groupBy(*STORE_DAY).agg(F.sum("Cost").alias("CostOfGoodsSold"))


#: A store day is hot from about so many lines, as rows of their sample.
HOT_SAMPLES = 20


def hot_store_days(sample: DataFrame, orders: DataFrame) -> DataFrame | None:
    """Store days with a large part of the lines, by a sample of them (``sample_of``); None if there are none."""
    dated = orders.select("OrderID", "OrderDateID").join(F.broadcast(sample.select("OrderID", "LocationID")), "OrderID")
    counted = dated.groupBy(*STORE_DAY).agg(F.count("*").alias("_lines")).where(F.col("_lines") >= HOT_SAMPLES)
    hot = materialize(counted.select(*[F.col(c).alias(f"_of_{c}") for c in STORE_DAY]), "hot-days", files=1)
    return None if hot.isEmpty() else hot


def _narrow(rows: DataFrame, amounts: list[str]) -> list[Column]:
    """Amounts as 18 digits, which a row holds in eight bytes each, and all in full only where those are not enough."""
    few = {name: F.col(name).try_cast(f"decimal(18,{rows.schema[name].dataType.scale})") for name in amounts}
    wide = F.lit(False)
    for name in amounts:
        wide = wide | (few[name].isNull() & F.col(name).isNotNull())
    return [*[few[name].alias(f"_few_{name}") for name in amounts], F.when(wide, F.struct(*amounts)).alias("_wide")]


def daily_summary(by_store: DataFrame, labor: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """The whole daily store summary, from store orders that carry their cost and member.

    Lines meet orders once, and the sums of a store order use the partitioning
    of that join. Store orders are then shuffled once, on store and day, as few bytes each:
    they are summed per member of a store day and then per store day where they lie, so
    counting orders, counting distinct members and all sums are one pass. Those of
    the ``hot`` store days are dealt by member, too, and summed before each shuffle.
    """
    sums = ["Gross", "Discount", "Refund", "Quantity", "Cost"]
    split = [*CHANNEL_COLUMNS, *PAYMENT_COLUMNS]
    methods = F.array(*[F.lit(method) for method in PAYMENT_COLUMNS.values()])
    paid = F.array_position(methods, F.col("PaymentMethod")).cast("tinyint")
    full = lambda name: F.coalesce(f"_wide.{name}", f"_few_{name}").alias(name)

    def daily(rows: DataFrame, together: bool) -> DataFrame:
        if together:
            rows = rows.select(*STORE_DAY, "MemberID", "ChannelID", paid.alias("_paid"), *_narrow(rows, sums)).repartition(*STORE_DAY)
            rows = rows.select(*STORE_DAY, "MemberID", "ChannelID", F.get(methods, F.col("_paid") - 1).alias("PaymentMethod"), *[full(name) for name in sums])
        per_member = (
            channel_sales(rows)
            .groupBy(*STORE_DAY, "MemberID")
            .agg(F.count("*").alias("_orders"), *total(*sums), *channel_columns(), *payment_columns())
        )
        return per_member.groupBy(*STORE_DAY).agg(
            F.sum("_orders").alias("TotalOrders"),
            F.count("MemberID").alias("TotalCustomers"),
            *total(*sums, *split),
        )

    if hot is None:
        days = daily(by_store, True)
    else:
        same = same_keys(STORE_DAY)
        days = daily(by_store.join(F.broadcast(hot), same, "left_anti"), True).unionByName(
            daily(by_store.join(F.broadcast(hot), same, "left_semi"), False)
        )
    names = {"Gross": "GrossSales", "Discount": "Discounts", "Refund": "Refunds", "Quantity": "Items", "Cost": "CostOfGoodsSold"}
    gross = F.col("GrossSales")
    joined = (
        days.withColumnsRenamed(names)
        .join(labor, STORE_DAY, "left")
        .withColumns(
            {
                "TotalLaborHours": F.coalesce("TotalLaborHours", F.lit(0.0)),
                "TotalLaborCost": F.coalesce("TotalLaborCost", F.lit(0)),
                "NetSales": gross - F.col("Discounts") - F.col("Refunds"),
                "TaxCollected": sales_tax(gross),
                "AverageOrderValue": ratio(gross, F.col("TotalOrders")),
                "AverageItemsPerOrder": ratio(F.col("Items"), F.col("TotalOrders")),
                "IsReconciled": F.lit(0),
            }
        )
    )
    return with_calendar(joined, "OrderDateID", "", "CalendarDate", "Year").drop("Items")


def summary_rows(daily: DataFrame) -> DataFrame:
    """Daily sums of stores as rows of the stored summary, with its names and its key.

    The key is the day's number before the store's, so it needs no shuffle, is unique as
    the pair is, and a refreshed day gets its old keys again. Day and store are ``int``.
    """
    day = F.col("OrderDateID")
    return daily.withColumns({"SummaryID": day.cast("long") * LOCATIONS + F.col("LocationID"), "SalesDateID": day}).drop(
        "OrderDateID", "CalendarDate", "Year"
    )


def order_pricing(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Header amounts of every order from its lines.

    Lines are summed per order before the join, so the join adds no shuffle of
    its own on that side and an order with very many lines stays cheap.
    """
    sums = lines.groupBy("OrderID").agg(
        F.sum("Gross").alias("_gross"),
        F.sum("Discount").alias("_discount"),
        F.sum("Refund").alias("_refund"),
    )
    subtotal, discount = F.col("SubtotalAmount"), F.col("DiscountAmount")
    priced = (
        orders.join(sums, "OrderID", "left")
        .withColumn("SubtotalAmount", F.coalesce("_gross", F.lit(0)).cast("decimal(22,2)"))
        .withColumn("DiscountAmount", F.round(F.coalesce("_discount", F.lit(0)), 2).cast("decimal(22,2)"))
        .withColumn("RefundAmount", F.coalesce("_refund", F.lit(0)).cast("decimal(22,2)"))
        .withColumn("TaxAmount", sales_tax(subtotal))
        .withColumn(
            "DeliveryFee",
            F.when(F.col("OrderType") == "Delivery", F.lit(DELIVERY_FEE)).otherwise(
                F.lit(0).cast("decimal(3,2)")
            ),
        )
        .withColumn("TipAmount", ((F.col("OrderID") % 10) * F.lit(50) / 100).cast("decimal(8,2)"))
        .withColumn(
            "TotalAmount",
            subtotal + F.col("TaxAmount") + F.col("DeliveryFee") + F.col("TipAmount") - discount,
        )
        .withColumn("LoyaltyPointsEarned", F.floor(subtotal).cast("bigint"))
        .withColumn("PaymentStatus", F.lit("Paid"))
        .withColumn("PromotionID", F.lit(None).cast("int"))
    )
    return priced.drop("_gross", "_discount", "_refund")


def line_movements(lines: DataFrame) -> DataFrame:
    """What every line moves: the units sold, and for a refunded line the same units back.

    The movements are exploded inside the row of their line: no join, no shuffle.
    """
    sold = F.struct(F.lit("Sale").alias("Movement"), (-F.col("Quantity")).alias("Units"))
    back = F.struct(F.lit("Return").alias("Movement"), F.col("Quantity").alias("Units"))
    movements = F.when(F.col("Refund") > 0, F.array(sold, back)).otherwise(F.array(sold))
    return lines.select("OrderID", "LineNumber", "LocationID", "ItemID", F.inline(movements))


def store_weekdays(stores: DataFrame, lines: DataFrame) -> DataFrame:
    """The lines every store shipped on each weekday, also on weekdays without any.

    The weekdays are exploded inside each store's row: no cross join.
    """
    weekday = F.explode(F.sequence(F.lit(1), F.lit(7)))
    shipped = lines.groupBy("LocationID", iso_weekday(date_of_id(F.col("ShipDateID"))).alias("DayOfWeek")).agg(
        F.count("*").alias("Lines")
    )
    return (
        stores.select("LocationID", weekday.alias("DayOfWeek"))
        .join(shipped, ["LocationID", "DayOfWeek"], "left")
        .withColumn("Lines", F.coalesce("Lines", F.lit(0)))
        .withColumn("OperatingHoursID", F.col("LocationID") * 7 + F.col("DayOfWeek"))
        .withColumn("IsOpen", (F.col("Lines") > 0).cast("int"))
    )


def price_lines(lines: DataFrame, price_list: DataFrame) -> DataFrame:
    """Snapshot the current price on every line; lines off the list keep NULL."""
    return lines.join(
        price_list.select("ItemID", F.col("BasePrice").alias("UnitPrice")), "ItemID", "left"
    ).withColumn("LineTotal", F.round(F.col("Quantity") * F.col("UnitPrice"), 2))


def payments(orders: DataFrame) -> DataFrame:
    """One payment per priced order, numbered in the order of the orders."""
    paid = orders.select(
        "OrderID",
        F.col("OrderDateID").alias("PaymentDateID"),
        "PaymentMethod",
        F.col("TotalAmount").alias("Amount"),
        F.lit("Payment").alias("TransactionType"),
        F.lit("Success").alias("TransactionStatus"),
    )
    return dense_ids(paid, ["OrderID"], "PaymentTransactionID")


def receipts(orders: DataFrame) -> DataFrame:
    """One receipt per order, on the day of the order, numbered like the payments."""
    printed = orders.select(
        "OrderID", F.col("OrderDateID").alias("ReceiptDateID"), F.lit(0).alias("IsReprint")
    )
    return dense_ids(printed, ["OrderID"], "ReceiptID")
