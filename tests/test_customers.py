"""Merged sketches against exact counts."""

from pyspark.sql import functions as F

from larder.operators import customers


def test_sketches_merge_within_their_error(spark):
    """Store 1 has most visits; the same members come on several days and to several stores."""
    visits = spark.range(120_000).select(
        F.when(F.col("id") % 3 > 0, 1).otherwise(F.col("id") % 7).alias("LocationID"), (F.col("id") % 11).alias("OrderDateID"),
        F.when(F.col("id") % 10 > 0, F.col("id") * 7919 % 20_011).alias("MemberID"),
    )
    sketches = customers.store_day_sketches(visits)
    weeks = spark.range(11).select(F.col("id").alias("OrderDateID"), F.floor(F.col("id") / 7).alias("Week"))
    rows = customers.rollup(visits, sketches, weeks, "OrderDateID", "Week").collect()
    assert len(rows) == 2 and all(r.WithinError and abs(r.Estimate / r.Customers - 1) < 4 * customers.standard_error() for r in rows)
    whole = customers.merged(sketches, []).first()
    exact = visits.agg(F.count_distinct("MemberID")).first()[0]
    assert abs(whole.Estimate / exact - 1) < 4 * customers.standard_error()
    assert customers.store_day_sketches(visits.limit(0)).count() == 0
