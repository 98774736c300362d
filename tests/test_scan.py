"""Scans over ranges against a loop over each key."""

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from larder.operators import asof, costing, hierarchy, points, scan, spells


def by_key(rows):
    out = defaultdict(list)
    for row in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        out[row[0]].append(row)
    return out


@pytest.fixture(params=[(30, 5), (3000, 3), (70_000, 1)], ids=["one block", "two levels", "three levels"])
def steps(request):
    """Rows (key, place, number); one key holds two thirds of them, and NULL is a key."""
    n, keys = request.param
    rng = random.Random(n)
    return [(None if rng.random() < 0.1 else (0 if rng.random() < 0.66 else rng.randrange(keys * 10)), i, rng.randrange(-9, 10)) for i in range(n)]


def test_clamped_steps(spark, steps):
    df = spark.createDataFrame(steps, "k int, i int, x int").repartition(7)
    zero = F.lit(0).cast("bigint")
    step = scan.clamped(F.col("x").cast("bigint"), zero, F.lit(20).cast("bigint"))
    got = scan.scan_before(df, ["k"], ["i"], step, scan.then_clamped, "before").withColumn("before", scan.apply_clamped(F.col("before"), zero))
    want = {}
    for rows in by_key(steps).values():
        value = 0
        for k, i, x in rows:
            want[k, i] = (x, value)
            value = min(max(value + x, 0), 20)
    assert {(r["k"], r["i"]): (r["x"], r["before"]) for r in got.collect()} == want


def test_latest_value(spark, steps):
    given = [(k, i, x if x > 7 else None) for k, i, x in steps]
    df = spark.createDataFrame(given, "k int, i int, x int")
    got = scan.scan_before(df, ["k"], ["i"], scan.latest(F.col("x")), scan.then_latest, "before").select("k", "i", "before.value")
    want = {}
    for rows in by_key(given).values():
        last = None
        for k, i, x in rows:
            want[k, i] = last
            last = x if x is not None else last
    assert {(r["k"], r["i"]): r["value"] for r in got.collect()} == want


def test_empty_table(spark):
    df = spark.createDataFrame([], "k int, i int, x bigint")
    assert scan.scan_before(df, ["k"], ["i"], scan.latest(F.col("x")), scan.then_latest, "before").collect() == []


def test_one_key_with_all_rows(spark):
    df = spark.range(20_000).select(F.lit(1).alias("k"), F.col("id").alias("i"))
    counted = F.struct(F.lit(1).cast("bigint").alias("n"), F.lit(1).cast("bigint").alias("widest"))
    wider = lambda a, b: F.struct((a["n"] + b["n"]).alias("n"), F.greatest(a["widest"], b["widest"]).alias("widest"))
    got = scan.scan_before(df, ["k"], ["i"], counted, wider, "seen")
    assert got.where("coalesce(seen.n, 0) <> i").count() == 0


def day(n, hour=0):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n, hours=hour)


def test_points_lapse_first_in_first_out(spark):
    rows = [
        (1, 7, day(0), "Earned", 100), (2, 7, day(1), "Earned", 50), (3, 7, day(2), "Redeemed", -30),
        # lot 1 lapses on day 5 with 70 points left; lot 2 on day 6 with all 50
        (4, 7, day(5, 1), "Redeemed", -60), (5, 7, day(8), "Earned", 5), (6, 7, day(9), "Redeemed", -1), (7, None, day(3), "Redeemed", -5),
    ]
    df = spark.createDataFrame(rows, "TransactionID int, MemberID int, TransactionTime timestamp_ntz, TransactionType string, Points int")
    got = points.points_statement(df, 5).orderBy("MemberID", "TransactionTime", "_kind").select("TransactionID", "TransactionType", "RequestedPoints", "Points", "BalanceAfter")
    assert [tuple(r) for r in got.collect()] == [
        (7, "Redeemed", -5, 0, 0), (1, "Earned", 100, 100, 100), (2, "Earned", 50, 50, 150), (3, "Redeemed", -30, -30, 120),
        (1, "Expired", None, -70, 50), (4, "Redeemed", -60, -50, 0), (2, "Expired", None, 0, 0), (5, "Earned", 5, 5, 5), (6, "Redeemed", -1, -1, 4),
    ]
    assert points.points_expiry(df, 5).count() == 8
    assert points.points_expiry(df.limit(0), 5).count() == 0


def test_rewards_a_member_can_redeem(spark):
    rows = [
        (1, 7, day(0), "Earned", 450), (2, 7, day(1), "Redeemed", -30), (3, 8, day(0), "Earned", 150), (4, 8, day(0), "Redeemed", -20),
        (5, 9, day(0), "Earned", 99), (6, None, day(2), "Earned", 200), (7, 10, None, "Earned", 500), (8, 11, day(0), "Earned", 900), (9, 11, day(9), "Earned", 0),
    ]
    df = spark.createDataFrame(rows, "TransactionID int, MemberID int, TransactionTime timestamp_ntz, TransactionType string, Points int")
    statement = points.points_statement(df, 9)
    offers = [(1, "taco", 100), (2, "off", 200)]
    got = {tuple(r) for r in points.redeemable(statement, offers, 0).collect()}
    # the points of member 11 lapse on day 9, before the last step; those of member 10 have no time and never do
    never = {(10, 500, 1, "taco", 100, 5, 400, 0, False), (10, 500, 2, "off", 200, 2, 300, None, False)}
    left = {(None, 200, 1, "taco", 100, 2, 100, 0, True), (None, 200, 2, "off", 200, 1, 0, None, True)}
    assert got == never | left
    kept = {tuple(r) for r in points.redeemable(points.points_statement(df, 30), offers, 0).collect()}
    assert kept == got | {
        (7, 420, 1, "taco", 100, 4, 320, 0, True), (7, 420, 2, "off", 200, 2, 220, None, True), (8, 130, 1, "taco", 100, 1, 30, 70, True),
        (11, 900, 1, "taco", 100, 9, 800, 0, True), (11, 900, 2, "off", 200, 4, 700, None, True),
    }
    assert {r["OnOffer"] for r in points.redeemable(statement, offers, 10**9).collect()} == {False}
    assert points.redeemable(statement.limit(0), offers, 0).count() == 0


def test_points_against_lots(spark):
    """Every lot followed by itself."""
    rng = random.Random(4)
    rows = [(i, 0 if rng.random() < 0.7 else rng.randrange(9), day(0) + dt.timedelta(minutes=rng.randrange(40_000)), "t", rng.randrange(-40, 41)) for i in range(1500)]
    df = spark.createDataFrame(rows, "TransactionID int, MemberID int, TransactionTime timestamp_ntz, TransactionType string, Points int")
    got = {(r["TransactionID"], r["_kind"]): (r["Points"], r["BalanceAfter"]) for r in points.points_statement(df, 3).collect()}
    last, want = max(r[2] for r in rows), {}
    for member in {r[1] for r in rows}:
        own = [(t, 1, i, p) for i, m, t, _, p in rows if m == member]
        own += [(t + dt.timedelta(days=3), 0, i, 0) for t, _, i, p in own if p > 0 and t + dt.timedelta(days=3) <= last]
        lots = {}
        for t, kind, i, p in sorted(own):
            before = sum(lots.values())
            if kind == 0:
                lots.pop(i)
            elif p > 0:
                lots[i] = p
            else:
                due = -p
                for lot in list(lots):
                    used = min(due, lots[lot])
                    lots[lot], due = lots[lot] - used, due - used
            want[i, kind] = (sum(lots.values()) - before, sum(lots.values()))
    assert got == want


def test_version_as_of(spark):
    facts = spark.createDataFrame([(1, 5, "a"), (1, 10, "b"), (1, 11, "c"), (2, 1, "d"), (None, 3, "e"), (1, None, "f"), (1, 10, "b")], "k int, t int, name string")
    versions = spark.createDataFrame([(1, 5, 1, 50), (1, 10, 1, 100), (1, 10, 2, 101), (3, 1, 1, 7), (1, None, 1, 0)], "k int, s int, tie int, price int")
    run = lambda same: sorted(((r["name"], r["price"]) for r in asof.as_of(facts, "t", versions, "s", ["k"], ["tie"], ["price"], same).collect()), key=str)
    assert run(False) == [("a", None), ("b", 50), ("b", 50), ("c", 101), ("d", None), ("e", None), ("f", None)]
    assert run(True) == [("a", 50), ("b", 101), ("b", 101), ("c", 101), ("d", None), ("e", None), ("f", None)]


def test_average_cost_of_a_hot_stock(spark):
    rng = random.Random(2)
    rows = [(1 if i % 3 else rng.randrange(50), i, rng.randrange(-900, 1000), rng.randrange(1, 50_000) / 100) for i in range(4000)]
    df = spark.createDataFrame(rows, "Stock int, i int, Units bigint, Cost double")
    got = {r["i"]: r for r in costing.average_cost(df, ["Stock"], ["i"]).collect()}
    for moves in by_key(rows).values():
        stock, worth = 0, 0.0
        for _, i, units, cost in moves:
            after = max(stock + units, 0)
            now = worth + cost if units > 0 else (worth * after / stock if stock else 0.0)
            assert got[i]["QuantityBefore"] == stock / 100 and got[i]["QuantityAfter"] == after / 100
            assert abs(got[i]["StockValue"] - now) < 0.011
            assert (got[i]["AverageCost"] is None) == (after == 0)
            if after:
                assert abs(got[i]["AverageCost"] - now * 100 / after) < 0.01 * (1 + 100 / after)
            assert units > 0 or abs(got[i]["IssueCost"] - (worth - now)) < 0.011
            stock, worth = after, now


def test_spells_cross_midnight_and_overtime_is_split(spark):
    at = lambda d, h, m=0: dt.datetime(2024, 1, 1) + dt.timedelta(days=d, hours=h, minutes=m)  # noqa: E731, Monday first
    punches = [at(0, 20), at(1, 2), at(1, 2)]  # 6 hours over midnight
    punches += [at(1, 22), at(2, 3)]  # after a break of 20 hours, which crosses no rule
    for d in (3, 4, 5):
        punches += [at(d, 0), at(d, 5), at(d, 10)]  # 10 hours each, with 14 hours of break between
    rows = [(1, t) for t in punches] + [(2, at(6, 23)), (2, at(7, 4)), (None, at(0, 1)), (1, None)]
    df = spark.createDataFrame(rows, "EmployeeID int, PunchTime timestamp_ntz")
    found = spells.net_hours(spells.work_spells(df, "6 HOURS"), 1000, weekly_hours=30).orderBy("EmployeeID", "SpellStart").collect()
    hours = [(r["EmployeeID"], r["Readings"], r["WorkedSeconds"] / 3600, r["RegularSeconds"] / 3600, r["OvertimeSeconds"] / 3600, r["BreakSeconds"]) for r in found]
    assert hours == [
        (None, 1, 0, 0, 0, None), (1, 3, 6, 6, 0, None), (1, 2, 5, 5, 0, 20 * 3600), (1, 3, 10, 10, 0, 21 * 3600), (1, 3, 10, 9, 1, 14 * 3600), (1, 3, 10, 0, 10, 14 * 3600),
        (2, 2, 5, 5, 0, None),
    ]
    assert [float(r["GrossPay"]) for r in found] == [0, 60, 50, 100, 105, 150, 50]
    assert str(found[-1]["Week"]) == "2024-01-01"


def test_closure_of_trees_chains_and_cycles(spark):
    parents = {0: None, 1: 0, 2: 0, 3: 1, 4: 3, 5: 4, 6: 5, 7: 6, 8: 8, 9: 99, 10: 9}
    nodes = spark.createDataFrame(list(parents.items()), "k long, p long")
    want = set()
    for node in parents:
        up, depth = node, 0
        while True:
            want.add((up, node, depth))
            above = parents[up]
            if above is None or above == up or above not in parents:
                break
            up, depth = above, depth + 1
    pairs = hierarchy.closure(nodes, "k", "p")
    got = [tuple(r) for r in pairs.collect()]
    assert set(got) == want and len(got) == len(want)
    sums = spark.createDataFrame([(0, 1), (3, 10), (7, 100)], "k long, Sales long")
    rolled = {r["k"]: (r["Below"], r["Levels"], r["OwnSales"], r["TreeSales"]) for r in hierarchy.roll_up(pairs, sums, "k", ["Sales"]).collect()}
    assert rolled[0] == (7, 6, 1, 111) and rolled[4] == (3, 3, 0, 100) and rolled[9] == (1, 1, 0, 0)
    with pytest.raises(ValueError, match="cycle"):
        hierarchy.closure(spark.createDataFrame([(1, 2), (2, 3), (3, 1), (4, 1)], "k long, p long"), "k", "p")
    assert hierarchy.closure(nodes.limit(0), "k", "p").count() == 0
