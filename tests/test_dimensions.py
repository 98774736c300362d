import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from larder.functions.recipes import recipe, recipe_cost
from larder.operators import dimensions as dims
from larder.operators import inventory, labor, loyalty, sales

NOW = dt.datetime(2024, 1, 1)


def test_states(spark):
    states = dims.states(spark, NOW)
    dims.check_states(states)
    rows = {r.StateCode: r for r in states.collect()}
    assert len(rows) == 51 and "DC" in rows
    assert rows["CA"].TaxRate == Decimal("0.0725")
    assert {c for c, r in rows.items() if r.TaxRate == 0} == {"AK", "DE", "MT", "NH", "OR"}
    assert {r.StateRegion for r in rows.values()} == {"South", "West", "Northeast", "Midwest"}
    assert [rows[c].StateID for c in sorted(rows)] == list(range(1, 52))
    assert all(r.IsActive == 1 for r in rows.values())


def test_state_checks_reject(spark):
    states = dims.states(spark)
    with pytest.raises(ValueError, match="Expected 51"):
        dims.check_states(states.limit(50))
    with pytest.raises(ValueError, match="Duplicate"):
        dims.check_states(states.withColumn("StateCode", F.lit("AA")))
    with pytest.raises(ValueError, match="TaxRate"):
        dims.check_states(states.withColumn("TaxRate", F.lit(-1)))
    with pytest.raises(ValueError, match="SparkSession cannot be None"):
        dims.states(None)


def test_positions_and_menu(spark):
    positions = dims.positions(spark)
    assert positions.count() == 4 and positions.where("MinHourlyRate >= MaxHourlyRate").count() == 0
    assert dims.categories(spark).count() == 4
    assert dims.ingredients(spark).count() == 7


def test_small_tables(spark):
    promotions = {r.PromotionCode: r for r in dims.promotions(spark).collect()}
    assert promotions["PROMO-10"].DiscountPercentage == 10
    assert promotions["PROMO-5"].DiscountAmount == 5 and promotions["PROMO-5"].EndDateID == 40000
    assert dims.rewards(spark).where("PointsCost > 0").count() == 2
    assert dims.order_channels(spark).count() == 6
    config = dims.system_configuration(spark).first()
    assert (config.ConfigKey, config.ConfigValue) == ("default.tax.rate", "0.07")


def test_recipes(spark):
    items = spark.range(300).withColumnRenamed("id", "ItemID")
    rows = items.select("ItemID", recipe(F.col("ItemID")).alias("r")).collect()
    for row in rows:
        assert len(row.r) == row.ItemID % 3 + 2
        assert len({x.IngredientID for x in row.r}) == len(row.r)
        assert all(Decimal("0.05") <= x.Quantity <= 2 for x in row.r)
    cost = items.select(recipe_cost(recipe(F.col("ItemID")), F.lit(Decimal("1.00"))).alias("c"))
    assert [c.c for c in cost.collect()] == [sum(x.Quantity for x in row.r) for row in rows]


def test_restocking_replaces_the_use(spark):
    usage = spark.createDataFrame(
        [(1, 1, 10, Decimal("2.5000")), (1, 1, 11, Decimal("1.2000")), (1, 2, 10, Decimal("4.0000")), (7, 3, 10, Decimal("0.1000"))],
        "LocationID bigint, IngredientID int, OrderDateID int, UsedQuantity decimal(14,4)",
    )
    lines = inventory.purchase_order_items(usage)
    got = {(r.LocationID, r.InventoryItemID): (r.QuantityOrdered, r.LineTotal) for r in lines.collect()}
    assert got == {(1, 1): (4, Decimal(4)), (1, 2): (4, Decimal(4)), (7, 3): (1, Decimal(1))}
    totals = {r.PurchaseOrderID: (r.Lines, r.LinesTotal, r.Variance) for r in inventory.purchase_totals(lines).collect()}
    assert totals == {1: (2, Decimal(8), Decimal("0.3")), 7: (1, Decimal(1), Decimal("0.9"))}
    stores = spark.createDataFrame([(1,), (7,), (9,)], "LocationID bigint")
    stock = inventory.store_stock(stores, usage)
    assert stock.count() == 21
    assert {(r.LocationID, r.InventoryItemID): (r.UsedQuantity, r.DaysUsed) for r in stock.where("DaysUsed > 0").collect()} == {
        (1, 1): (Decimal("3.7"), 2), (1, 2): (Decimal(4), 1), (7, 3): (Decimal("0.1"), 1)
    }


def test_use_by_hand(spark):
    items = spark.createDataFrame([(4,), (5,)], "ItemID bigint")
    recipes = {r.ItemID: {x.IngredientID: x.Quantity for x in r.r} for r in items.select("ItemID", recipe(F.col("ItemID")).alias("r")).collect()}
    lines = spark.createDataFrame(
        [(1, 3, 4, Decimal(2)), (1, 3, 5, Decimal(1)), (2, 3, 4, Decimal(5))],
        "OrderID bigint, LocationID bigint, ItemID bigint, Quantity decimal(18,2)",
    )
    orders = spark.createDataFrame([(1, 8), (2, 8)], "OrderID bigint, OrderDateID int")
    want = {}
    for item, units in ((4, 7), (5, 1)):
        for k, quantity in recipes[item].items():
            want[k] = want.get(k, 0) + units * quantity
    got = {r.IngredientID: r.UsedQuantity for r in inventory.daily_usage(lines, orders, items).collect()}
    assert got == want


def test_pay_rounds_half_up(spark):
    seconds = [0, 1, 2, 11, 12, 13, 3599, 3600, 28620]
    df = spark.createDataFrame([(s,) for s in seconds], "s bigint")
    got = {r.s: r.p for r in df.select("s", labor.pay(F.col("s"), F.lit(1500)).alias("p")).collect()}
    for s in seconds:
        exact = Decimal(s) * 15 / 3600
        assert got[s] == exact.quantize(Decimal("0.01"), "ROUND_HALF_UP")


def test_shifts_and_hours(spark):
    at = lambda *clock: dt.datetime(2024, 1, 1, *clock)
    punches = spark.createDataFrame(
        [(1, at(9, 5)), (1, at(12)), (1, at(17, 2)), (2, at(8, 30, 30))],
        "EmployeeID int, PunchTime timestamp_ntz",
    )
    worked = labor.shifts(punches)
    rows = {r.EmployeeID: r for r in labor.hours_worked(worked, at(10)).collect()}
    assert (rows[1].TotalMinutes, rows[1].TotalHoursWorked) == (477, 7.95)
    assert rows[2].ClockOutTime is None and rows[2].TotalMinutes == 90
    paid = {r.EmployeeID: r for r in labor.payroll(worked).collect()}
    assert paid[1].GrossPay == Decimal("119.25") and paid[2].GrossPay == 0


def test_attendance(spark):
    people = spark.createDataFrame([(1, 5), (2, 5)], "EmployeeID int, LocationID bigint")
    worked = spark.createDataFrame([(1, 100, 30), (1, 102, 60)], "EmployeeID int, ClockInDateID int, TotalMinutes bigint")
    got = {(r.EmployeeID, r.ShiftDateID): (r.IsPresent, r.TotalMinutes) for r in labor.attendance(people, worked, 100, 102).collect()}
    assert got == {(1, 100): (1, 30), (1, 101): (0, 0), (1, 102): (1, 60), (2, 100): (0, 0), (2, 101): (0, 0), (2, 102): (0, 0)}


def test_weekdays_and_movements(spark):
    stores = spark.createDataFrame([(1,), (2,)], "LocationID bigint")
    # date 1 is a Tuesday
    lines = spark.createDataFrame(
        [(1, 1, 1, 9, 1, Decimal(3), Decimal(0)), (1, 2, 1, 9, 8, Decimal(4), Decimal(7))],
        "OrderID bigint, LineNumber int, LocationID bigint, ItemID bigint, ShipDateID int, Quantity decimal(18,2), Refund decimal(18,2)",
    )
    days = {(r.LocationID, r.DayOfWeek): (r.Lines, r.IsOpen) for r in sales.store_weekdays(stores, lines).collect()}
    assert len(days) == 14 and days[1, 2] == (2, 1) and sum(n for n, _ in days.values()) == 2
    moved = [(r.LineNumber, r.Movement, r.Units) for r in sales.line_movements(lines).collect()]
    assert sorted(moved) == [(1, "Sale", -3), (2, "Return", 4), (2, "Sale", -4)]


def test_ratings(spark):
    given = spark.createDataFrame(
        [(1, 0, -3.0), (2, 1, 24.9), (3, 2, 25.0), (4, 3, 1e9), (5, 4, None)], "FeedbackID bigint, MemberID bigint, Value double"
    )
    rated = loyalty.feedback(given)
    assert [r.OverallRating for r in rated.orderBy("FeedbackID").collect()] == [1, 1, 2, 5, None]
    stores = spark.createDataFrame([(10,), (20,), (40,)], "LocationID bigint")
    got = {r.LocationID: (r.Responses, r.AverageRating) for r in loyalty.feedback_by_store(rated, stores).collect()}
    assert got == {10: (2, 3.0), 20: (1, 1.0), 40: (1, 2.0)}
