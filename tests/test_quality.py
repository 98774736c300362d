import pytest
from pyspark.sql import functions as F

from larder.catalog import constraints
from larder.operators import quality
from larder.sources.inline import inline_rows

# One row that keeps and one that breaks each declared rule.
GOOD_AND_BAD = {
    "CHK_Employees_HourlyRate": ("HourlyRate int", (1,), (0,)),
    "CHK_Employees_TerminationDate": ("HireDateID int, TerminationDateID int", (5, 5), (5, 4)),
    "CHK_Items_BasePrice": ("BasePrice int", (0,), (-1,)),
    "CHK_Promotions_EndDate": ("StartDateID int, EndDateID int", (1, 2), (2, 2)),
    "CHK_Promotions_Discount": (
        "DiscountPercentage int, DiscountAmount int", (100, None), (101, 5),
    ),
    "CHK_PromotionItems_OneReference": (
        "ItemID int, CategoryID int, ComboID int", (None, 3, None), (1, None, 2),
    ),
    "CHK_Orders_TotalAmount": ("TotalAmount int", (0,), (-1,)),
    "CHK_Orders_SubtotalAmount": ("SubtotalAmount int", (7,), (-7,)),
    "CHK_OrderItems_Quantity": ("Quantity int", (1,), (0,)),
    "CHK_OrderItems_OneReference": ("ItemID int, ComboID int", (1, None), (None, None)),
    "CHK_PaymentTransactions_Amount": ("Amount int", (0,), (-1,)),
    "CHK_OrderFeedback_OverallRating": ("OverallRating int", (5,), (6,)),
    "CHK_StoreExpenses_Amount": ("Amount int", (1,), (-1,)),
}


def test_all_rules_are_covered():
    assert set(GOOD_AND_BAD) == {name for _, name in constraints.CHECKS}


@pytest.mark.parametrize("table,name", list(constraints.CHECKS))
def test_check_constraints(spark, table, name):
    columns, good, bad = GOOD_AND_BAD[name]
    df = inline_rows(spark, [good, bad, bad], columns)
    row = quality.check_rules(df, table, {name: constraints.CHECKS[table, name]}).first()
    assert tuple(row) == (table, name, 3, 2)


def test_unknown_is_no_violation(spark):
    df = inline_rows(spark, [(None,), (-1,)], "Amount int")
    assert quality.check_rules(df, "t", {"r": "Amount >= 0"}).first().Violations == 1


def test_unique_reference_null_and_size(spark):
    df = inline_rows(spark, [(1, 1), (1, 1), (1, 2), (2, None), (3, 9)], "a int, b int")
    assert tuple(quality.check_unique(df, "t", ["a", "b"]).first()) == ("t", "a,b", 5, 4, 1)
    parent = inline_rows(spark, [(1,), (2,)], "k int")
    found = quality.check_reference(df, "t", "b", parent, "p", "k").first()
    assert tuple(found) == ("t.b", "p.k", 1, 1)
    nulls = {r.ColumnName: r.Nulls for r in quality.check_not_null(df, "t", ["a", "b"]).collect()}
    assert nulls == {"a": 0, "b": 1}
    sizes = quality.check_group_size(df, "three each", ["a"], F.count("*"), F.lit(3)).first()
    assert tuple(sizes) == ("three each", 3, 2)


def test_reference_counts_a_hot_key_before_the_join(spark):
    hot = F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id"))
    child = spark.range(100_000).select(hot.alias("k"))
    parent = spark.range(50_000).withColumnRenamed("id", "k")
    expected = len([i for i in range(50_000, 100_000) if i % 3 == 0])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = quality.check_reference(child, "c", "k", parent, "p", "k")
        assert df.first().OrphanRows == expected
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.index("LeftAnti") < plan.rindex("Aggregate")  # aggregate below the join
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_formats(spark):
    df = inline_rows(
        spark,
        [("SF-00001", "12345", "CA", "a@b.com"), ("SF-1", "1234", "ca", "a.b.com")],
        "StoreNumber string, ZipCode string, StateCode string, Email string",
    )
    found = quality.check_formats(df, "t", quality.FORMATS).collect()
    assert {r.Rule: r.Violations for r in found} == dict.fromkeys(quality.FORMATS, 1)


def test_fill_defaults(spark):
    df = inline_rows(
        spark, [(1, None, 5), (2, "Gold", None)],
        "MemberID int, MembershipTier string, TotalPoints int",
    )
    rows = {r.MemberID: r for r in quality.fill_defaults(df, "loyalty.Members").collect()}
    assert rows[1].MembershipTier == "Bronze" and rows[2].MembershipTier == "Gold"
    assert rows[2].TotalPoints == 0 and rows[1].PreferredContactMethod == "Email"
    assert rows[1].CreatedDate is not None and len(rows[1].MemberGUID) == 36


def test_require(spark):
    df = inline_rows(spark, [(1,), (2,)], "a int")
    quality.require(df, 2, ["a"], {"positive": "a > 0"})
    with pytest.raises(ValueError, match="Expected 3"):
        quality.require(df, 3)
    with pytest.raises(ValueError, match="positive"):
        quality.require(df, rules={"positive": "a > 1"})


def test_table_report_names_absent_columns(spark):
    df = inline_rows(spark, [(1, 1, "4.00"), (1, 2, "-1.00")], "OrderID bigint, LocationID int, TotalAmount decimal(12,2)")
    stores = inline_rows(spark, [(1,)], "LocationID int")
    found = quality.table_report(df, "ord.Orders", {"store.Locations": stores}).collect()
    wrong = {(r.Kind, r.Subject) for r in found if r.Violations}
    present = {pair for pair in wrong if pair[0] != "absent column"}
    assert present == {
        ("check", "CHK_Orders_TotalAmount"),
        ("unique", "OrderID"),
        ("reference", "LocationID -> store.Locations"),
    }
    absent = {subject for kind, subject in wrong if kind == "absent column"}
    assert {"OrderNumber", "OrderDateID", "SubtotalAmount", "ChannelID"} <= absent
    assert not absent & {"OrderID", "LocationID", "TotalAmount"}
