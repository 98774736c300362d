"""Running totals per key that hold when one key owns much of the data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.operators.ranges import Ranges
from larder.sources.scratch import materialize


def _summed(df: DataFrame, by: list[str], order: list[str], value: str, out: str) -> DataFrame:
    frame = (
        Window.partitionBy(*by)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return df.withColumn(out, F.sum(value).over(frame))


def running_sum(df: DataFrame, keys: list[str], order: list[str], value: str, out: str) -> DataFrame:
    """Sum of ``value`` up to and including each row, per ``keys`` in ``order``.

    ``order`` must identify a row inside its key. The rows are stored once, cut
    into ranges of the sort order, whatever the size of a key; each range is
    summed by itself and starts from the total of the ranges before it. NULL is
    a key like any other.
    """
    cut = materialize(
        df.repartitionByRange(*keys, *order).withColumn("_range", F.spark_partition_id()),
        "ranges",
    )
    earlier = (
        Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    )
    # Only a key that continues from an earlier range has an offset, and each
    # range continues at most one key: no more rows than ranges.
    offsets = (
        cut.groupBy(*keys, "_range")
        .agg(F.sum(value).alias("_total"))
        .withColumn("_before", F.sum("_total").over(earlier))
        .where(F.col("_before").isNotNull())
        .select(*[F.col(key).alias(f"_of_{key}") for key in keys], F.col("_range").alias("_of_range"), "_before")
    )
    inside = _summed(cut, [*keys, "_range"], order, value, out)
    same = F.col("_range") == F.col("_of_range")
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"_of_{key}"))
    total = F.when(F.col("_before").isNull(), F.col(out)).otherwise(
        F.coalesce(F.col(out), F.lit(0)) + F.col("_before")
    )
    return inside.join(F.broadcast(offsets), same, "left").withColumn(out, total).select(*df.columns, out)


def running_sums(df: DataFrame, cut: Ranges, values: dict[str, Column]) -> DataFrame:
    """Add the sums of ``values`` up to and including each row, per key of ``cut`` in its order, and ``_range``.

    As ``running_sum``, but of several values at once and for rows that are dear to store: they
    are shuffled once, into ranges known before (``ranges``), and not stored. What a key that
    was cut has before a range is summed from its rows alone, in one row per range.
    """
    by = ["_range", *cut.keys]
    before = [f"_before_{name}" for name in values]
    totals = cut.numbered(cut.of_cut_keys(df)) if cut.count > 1 else cut.numbered(df).limit(0)
    totals = totals.groupBy(*by).agg(*[F.sum(value).alias(name) for name, value in values.items()])
    earlier = Window.partitionBy(*cut.keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(*by, *[F.sum(name).over(earlier).alias(start) for name, start in zip(values, before, strict=True)])
    inside = Window.partitionBy(*by).orderBy(*cut.order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = cut.carried(cut.dealt(df), starts, before).withColumns({name: F.sum(value).over(inside) for name, value in values.items()})
    total = lambda name, start: F.when(F.col(start).isNull(), F.col(name)).otherwise(F.coalesce(F.col(name), F.lit(0)) + F.col(start))
    return summed.withColumns({name: total(name, start) for name, start in zip(values, before, strict=True)}).drop(*before)
