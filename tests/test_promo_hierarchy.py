import random

import pytest

from larder.operators import hierarchy, promo
from larder.sources.inline import inline_rows

PROMOS = [(1, 10, 20), (2, 15, None), (3, 20, 20), (4, 30, 25), (5, 36890, 40000), (6, 1, 36891)]


@pytest.fixture(scope="module")
def facts(spark):
    rng = random.Random(3)
    # a third of the facts fall on one day
    days = [20 if i % 3 == 0 else rng.choice([-400, 1, 9, 10, 15, 21, 36889, 36890, 36891, 37000]) for i in range(900)]
    return days, spark.createDataFrame(list(enumerate(days)), "OrderID int, OrderDateID int")


def test_interval_join_matches_brute_force(spark, facts):
    days, df = facts
    promotions = inline_rows(spark, PROMOS, "PromotionID int, StartDateID int, EndDateID int")
    joined = promo.running_promotions(df, promotions)
    plan = joined._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    expected = {
        (i, p)
        for i, day in enumerate(days)
        for p, start, end in PROMOS
        if start <= day and (end is None or day <= end)
    }
    assert {(r.OrderID, r.PromotionID) for r in joined.collect()} == expected
    assert joined.count() == len(expected)


def test_targets_expand_once_per_item(spark):
    items = inline_rows(
        spark, [(1, "a"), (2, "a"), (3, "b"), (4, "b")], "ItemID int, Category string"
    )
    combos = inline_rows(spark, [(9, 1), (9, 4), (8, 2)], "ComboID int, ItemID int")
    targets = inline_rows(
        spark,
        [(1, None, "a", None), (1, 2, None, None), (1, None, None, 9), (2, 3, None, None)],
        "PromotionID int, ItemID int, Category string, ComboID int",
    )
    got = promo.promotion_items(targets, items, combos).collect()
    assert sorted((r.PromotionID, r.ItemID) for r in got) == [(1, 1), (1, 2), (1, 4), (2, 3)]


def walk(parents):
    """Root and level of each node by following parents one by one."""
    found = {}
    for node in parents:
        at, level = node, 0
        while parents.get(at) is not None and parents[at] != at:
            at, level = parents[at], level + 1
        found[node] = (at, level)
    return found


def levels_of(spark, parents):
    df = spark.createDataFrame(list(parents.items()), "id int, up int")
    return {r.id: (r.RootID, r.Level) for r in hierarchy.levels(df, "id", "up").collect()}


def test_levels_of_a_deep_chain(spark):
    chain = {i: (i - 1 if i else None) for i in range(100)}
    assert levels_of(spark, chain) == walk(chain)


def test_levels_of_a_random_forest_with_a_hot_parent(spark):
    rng = random.Random(5)
    forest = {0: None, 1: 1}
    for i in range(2, 400):
        forest[i] = 7 if i > 20 and i % 3 else rng.randrange(i)
    assert levels_of(spark, forest) == walk(forest)


def test_missing_parent_ends_the_chain(spark):
    assert levels_of(spark, {1: 99, 2: 1}) == {1: (99, 1), 2: (99, 2)}


def test_cycle_is_reported(spark):
    with pytest.raises(ValueError, match="cycle"):
        levels_of(spark, {1: 2, 2: 3, 3: 1, 4: None})


def test_best_discount_prefers_the_lower_id(spark):
    rows = [(1, 1, 5, 2.0), (1, 1, 3, 2.0), (1, 1, 9, 1.0), (2, 1, 9, 1.0)]
    df = spark.createDataFrame(rows, "OrderID int, LocationID int, PromotionID int, Discount double")
    got = promo.best_discount(df).orderBy("OrderID").collect()
    assert [(r.PromotionID, r.Discount, r.Promotions) for r in got] == [(3, 2.0, 3), (9, 1.0, 1)]


def test_applicability_rules_one_by_one(spark):
    from larder.plans.campaigns import CAMPAIGN_TYPES, TARGET_TYPES

    # date 2 is a Wednesday, date 5 a Saturday; channel 4 is WEB, second 43200 is noon
    orders = inline_rows(
        spark,
        [(1, 1, 2, 4, 43200, None, "100.00"), (2, 2, 5, 1, 3600, 7, "40.00")],
        "OrderID bigint, LocationID bigint, OrderDateID int, ChannelID int, OrderSecond int,"
        " MemberID bigint, Gross decimal(12,2)",
    )
    lines = inline_rows(
        spark, [(1, 1, 7, "60.00"), (1, 1, 8, "40.00"), (2, 2, 8, "40.00")],
        "OrderID bigint, LocationID bigint, ItemID bigint, Gross decimal(12,2)",
    )

    def applied(promotion, targets=(), stores=()):
        base = {
            "pct": "10.00", "amount": None, "start": 1, "end": None, "channels": "All",
            "days": "All", "from": None, "to": None, "minimum": None, "active": 1, "members": 0,
            "own": None, "total": None,
        } | promotion
        row = (1, "P", base["pct"], base["amount"], base["start"], base["end"], base["channels"],
               base["days"], base["from"], base["to"], base["minimum"], base["active"],
               base["members"], base["own"], base["total"])
        target_rows = inline_rows(spark, list(targets) or [(0, 0, None, None)], TARGET_TYPES)
        wanted = target_rows.where("PromotionID > 0")
        store_rows = inline_rows(
            spark, list(stores) or [(0, 0)], "PromotionID bigint, LocationID bigint"
        ).where("PromotionID > 0")
        got = promo.applicable_promotions(
            orders, lines, inline_rows(spark, [row], CAMPAIGN_TYPES), wanted,
            wanted.select("PromotionID", "ItemID"), store_rows,
        )
        return {r.OrderID: float(r.Discount) for r in got.collect()}

    assert applied({}) == {1: 10.0, 2: 4.0}
    assert applied({"start": 3}) == {2: 4.0}
    assert applied({"end": 4}) == {1: 10.0}
    assert applied({"channels": "MOBILE,WEB"}) == {1: 10.0}
    assert applied({"days": "Weekdays"}) == {1: 10.0}
    assert applied({"days": "Weekends"}) == {2: 4.0}
    assert applied({"from": "11:00:00", "to": "14:00:00"}) == {1: 10.0}
    assert applied({"minimum": "50.00"}) == {1: 10.0}
    assert applied({"pct": None, "amount": "50.00"}) == {1: 50.0, 2: 40.0}
    assert applied({}, stores=[(1, 2)]) == {2: 4.0}
    assert applied({"active": 0}) == {}
    assert applied({"members": 1}) == {2: 4.0}
    assert applied({"total": 1}) == {1: 10.0}
    assert applied({"own": 1}) == {1: 10.0, 2: 4.0}
    # order 1 is a guest's, whom no member's limit binds
    assert applied({"own": 0}) == {1: 10.0}
    assert applied({"total": 2, "own": 5}) == {1: 10.0, 2: 4.0}
    assert applied({}, targets=[(1, 7, None, None)]) == {1: 6.0}


def test_limits_count_only_what_they_allow(spark):
    """Member 1 may use a promotion twice; guests have no limit of their own; what is denied does not use up the total."""
    uses = [(order, 1, 9, order, member) for order, member in enumerate([1, 1, 1, None, None, None, 1, 2, 2, 2, 3], 1)]
    df = spark.createDataFrame(
        [(*u, 1.0, 2, 6) for u in uses] + [(1, 1, 8, 1, 1, 1.0, None, 1), (2, 1, 8, 2, 2, 1.0, None, 1), (1, 1, 7, 1, 1, 1.0, 1, None), (2, 1, 7, 2, 1, 1.0, 1, None)],
        "OrderID int, LocationID int, PromotionID int, OrderDateID int, MemberID int, Discount double, MaxUsagePerCustomer int, MaxTotalUsage int",
    )
    kept = promo.within_limits(df)
    got = sorted((r.PromotionID, r.OrderID) for r in kept.collect())
    # promotion 9: orders 3 and 7 are denied to member 1; then the first six of 1 2 4 5 6 8 9 11
    assert got == [(7, 1), (8, 1), (9, 1), (9, 2), (9, 4), (9, 5), (9, 6), (9, 8)]
    assert kept.columns == df.columns


def test_best_stack_of_each_order(spark):
    """Promotions 1 and 2 stand alone, 3 and 4 take percentages, 5 and 6 amounts."""
    kinds = spark.createDataFrame([(i, int(i > 2), 10.0 if i in (1, 3, 4) else None) for i in range(1, 7)], "PromotionID bigint, IsStackable int, DiscountPercentage double")
    given = {
        1: [(1, 50), (3, 20), (4, 20), (5, 10)],  # alone 50 beats 20 + 10
        2: [(1, 30), (3, 20), (4, 25), (5, 10), (6, 5)],  # 25 + 10 + 5 beats 30; only one percentage
        3: [(2, 40), (3, 20), (5, 20)],  # a tie goes to the single promotion
        4: [(5, 80), (6, 70)],  # no more than the order's 100
        5: [(3, 20), (4, 20)],  # the lower id of equals
    }
    rows = [(order, 1, p, 100.0, float(d)) for order, listed in given.items() for p, d in listed]
    df = spark.createDataFrame(rows, "OrderID int, LocationID int, PromotionID bigint, Gross double, Discount double")
    money = df.withColumns({"Gross": df["Gross"].cast("decimal(22,2)"), "Discount": df["Discount"].cast("decimal(22,2)")})
    got = {r.OrderID: (r.PromotionIDs, r.Promotions, float(r.Discount)) for r in promo.best_stack(money, kinds).collect()}
    assert got == {1: ("1", 1, 50), 2: ("4,5,6", 3, 40), 3: ("2", 1, 40), 4: ("5,6", 2, 100), 5: ("3", 1, 20)}
    assert promo.best_stack(money.limit(0), kinds).count() == 0
