"""Distinct customers over any span, from mergeable sketches of store days."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LOG_BUCKETS = 12


def standard_error(log_buckets: int = LOG_BUCKETS) -> float:
    """The relative standard error of an estimate."""
    return 1.04 / 2 ** (log_buckets / 2)


def store_day_sketches(visits: DataFrame, log_buckets: int = LOG_BUCKETS) -> DataFrame:
    """One sketch of bounded size per store and day; NULL members (guests) are not counted."""
    return visits.groupBy("LocationID", "OrderDateID").agg(F.hll_sketch_agg("MemberID", F.lit(log_buckets)).alias("Sketch"))


def merged(sketches: DataFrame, by: list[str]) -> DataFrame:
    """Estimated customers per ``by``: unions of sketches, which combine before the shuffle and read no visit again."""
    return sketches.groupBy(*by).agg(
        F.hll_sketch_estimate(F.hll_union_agg("Sketch")).alias("Estimate"), F.count("*").alias("StoreDays")
    )


def rollup(visits: DataFrame, sketches: DataFrame, spans: DataFrame, key: str, by: str) -> DataFrame:
    """Exact and estimated customers per ``by``, which ``spans`` gives for each ``key``, and whether they agree within four standard errors."""
    exact = visits.join(spans, key).groupBy(by).agg(F.count_distinct("MemberID").alias("Customers"))
    allowed = F.col("Customers") * (4 * standard_error()) + 1
    return (
        merged(sketches.join(spans, key), [by])
        .join(exact, by)
        .withColumn("WithinError", F.abs(F.col("Estimate") - F.col("Customers")) <= allowed)
    )
