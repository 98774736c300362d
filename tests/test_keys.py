import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from larder.functions import keys
from larder.operators import running
from larder.operators.running import running_sum
from larder.operators.surrogate import assign_round_robin, dense_ids


@pytest.fixture(scope="module")
def movements(spark):
    """Key 1 owns two thirds of the rows; times repeat, the id breaks ties."""
    rng = random.Random(7)
    rows = [
        (1 if i % 3 else rng.randrange(2, 40), rng.randrange(50), i, rng.randrange(-99, 100))
        for i in range(6000)
    ]
    rng.shuffle(rows)
    return rows, spark.createDataFrame(rows, "k int, t int, id int, v bigint").repartition(8)


@pytest.fixture(params=[True, False], ids=["coalesced", "many partitions"])
def coalescing(spark, request):
    """Small shuffles end in one partition unless coalescing is off."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, str(request.param).lower())
    yield request.param
    spark.conf.set(name, "true")


def balances(rows):
    total, expected = defaultdict(int), {}
    for k, _, i, v in sorted(rows):
        total[k] += v
        expected[i] = total[k]
    return expected


def test_running_sum_matches_a_plain_loop(movements, coalescing):
    rows, df = movements
    got = running_sum(df, ["k"], ["t", "id"], "v", "balance").collect()
    assert len(got) == len(rows)
    assert {r.id: r.balance for r in got} == balances(rows)


def test_hot_key_is_cut_into_several_ranges(spark, movements, monkeypatch):
    cut = []
    keep = running.materialize

    def record(df, label):
        stored = keep(df, label)
        cut.append((label, stored))
        return stored

    monkeypatch.setattr(running, "materialize", record)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        _, df = movements
        out = running_sum(df, ["k"], ["t", "id"], "v", "balance")
        ranges = next(stored for label, stored in cut if label == "ranges")
        sizes = [r["count"] for r in ranges.where("k = 1").groupBy("_range").count().collect()]
        assert len(sizes) > 4 and max(sizes) < 1500
        assert "SinglePartition" not in out._jdf.queryExecution().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_several_keys(movements):
    rows, df = movements
    wide = df.withColumn("part", F.col("id") % 2)
    got = running_sum(wide, ["k", "part"], ["t", "id"], "v", "b")
    expected = {}
    for part in (0, 1):
        expected |= balances([r for r in rows if r[2] % 2 == part])
    assert {r.id: r.b for r in got.collect()} == expected


def test_running_sum_keeps_null_keys_and_values(spark):
    rows = [(None, 1, 1, 5), (None, 2, 2, None), (1, 1, 3, None), (1, 2, 4, 2), (1, 3, 5, 3)]
    df = spark.createDataFrame(rows, "k int, t int, id int, v bigint")
    got = running_sum(df, ["k"], ["t", "id"], "v", "b").collect()
    assert {r.id: r.b for r in got} == {1: 5, 2: 5, 3: None, 4: 2, 5: 5}


def test_hot_null_key(spark, coalescing):
    rows = [(None if i % 3 else i % 7, i, i, i % 11 - 5) for i in range(4000)]
    df = spark.createDataFrame(rows, "k int, t int, id int, v bigint").repartition(8)
    got = running_sum(df, ["k"], ["t", "id"], "v", "b").collect()
    assert {r.id: r.b for r in got} == balances([(-1 if k is None else k, t, i, v) for k, t, i, v in rows])


def test_dense_ids_are_dense_and_ordered(spark, coalescing):
    numbers = random.Random(1).sample(range(10**9), 20000)
    df = spark.createDataFrame([(n % 7, n) for n in numbers], "a int, b int").repartition(11)
    got = {(r.a, r.b): r.id for r in dense_ids(df, ["a", "b"], "id").collect()}
    expected = {pair: i for i, pair in enumerate(sorted((n % 7, n) for n in numbers), 1)}
    assert got == expected


def test_dense_ids_of_nothing(spark):
    assert dense_ids(spark.range(0), ["id"], "n").count() == 0


def test_dense_ids_number_the_rows_where_they_lie(spark):
    df = dense_ids(spark.range(10_000), ["id"], "n")
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    # the only single partition holds the counts per partition, not the rows
    single = [i for i, line in enumerate(lines) if "Exchange SinglePartition" in line]
    assert len(single) == 1
    assert "HashAggregate(keys=[_groupingexpression" in lines[single[0] + 1]
    assert any("BroadcastHashJoin" in line for line in lines)


def test_round_robin_with_gaps_in_parent_keys(spark):
    parents = spark.createDataFrame([(30,), (10,), (20,)], "LocationID int")
    children = spark.range(7).withColumnRenamed("id", "n")
    got = assign_round_robin(children, F.col("n"), parents, "LocationID", "Home").collect()
    assert {r.n: r.Home for r in got} == {0: 10, 1: 20, 2: 30, 3: 10, 4: 20, 5: 30, 6: 10}
    # without parents there is nobody to give
    orphans = assign_round_robin(children, F.col("n"), parents.where("false"), "LocationID", "Home").collect()
    assert {r.n: r.Home for r in orphans} == dict.fromkeys(range(7))


def test_business_keys_keep_long_numbers(spark):
    row = spark.range(1).select(
        keys.business_key(keys.STORE_NUMBER, F.lit(7)).alias("a"),
        keys.business_key(keys.STORE_NUMBER, F.lit(1234567)).alias("b"),
        keys.phone_number(F.lit(12345)).alias("c"),
        keys.business_key(keys.MEMBER_NUMBER, F.lit(42)).alias("d"),
    ).first()
    assert tuple(row) == ("SF-00007", "SF-1234567", "(555)345-2345", "MBR-0000042")


def test_stable_guid(spark):
    df = spark.range(1000).select(keys.stable_guid("x", F.col("id")).alias("g"))
    rows = [r.g for r in df.collect()]
    assert len(set(rows)) == 1000 and rows == [r.g for r in df.collect()]
    assert all(len(g) == 36 and g.count("-") == 4 for g in rows)


def test_sample_is_repeatable_and_near_its_rate(spark):
    df = spark.range(100_000).where(keys.sampled(F.col("id"), 10, "feedback"))
    first = {r.id for r in df.collect()}
    assert first == {r.id for r in df.repartition(5).collect()}
    assert 800 < len(first) < 1200
