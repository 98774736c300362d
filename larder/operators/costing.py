"""Moving-average cost of stock: receipts at their price, issues at the average."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.functions.money import double
from larder.operators.ranges import Ranges, ranges_of, sample_of
from larder.operators.scan import affine, apply_affine, apply_clamped, clamped, scan_before, then_affine, then_clamped
from larder.sources.scratch import materialize

# above any stock, and far enough from the largest long that a movement can be added
_NO_LIMIT = 1 << 62
# ties of the last decimal go up although doubles may lie just below them
_UP = 0.500001


def to_places(value: Column, places: int) -> Column:
    return (F.floor(value * float(10**places) + F.lit(_UP)) / F.lit(float(10**places))).cast("double")


def _stocked(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Stock before and after each movement of a range, from ``_stock0``, and what each does to the value: x -> _times * x + _plus.

    A sum that never falls below zero is the plain sum, less what the lowest sum so far fell below zero.
    """
    of_key = Window.partitionBy("_range", *keys).orderBy(*order)
    units, zero = F.coalesce("Units", F.lit(0)).cast("bigint"), F.lit(0).cast("bigint")
    start = F.coalesce("_stock0", zero)
    was = F.col("_sum") - units
    earlier = F.min("_sum").over(of_key.rowsBetween(Window.unboundedPreceding, -1))
    cost = double(F.coalesce("Cost", F.lit(0)))
    left = F.when(F.col("_before") > 0, double("_after") / double("_before")).otherwise(0.0)
    return (
        rows.withColumns({"_sum": F.sum(units).over(of_key.rowsBetween(Window.unboundedPreceding, 0)), "_n": F.row_number().over(of_key)})
        .withColumn("_least", earlier)
        .withColumn("_before", F.when(F.col("_n") == 1, start).otherwise(F.greatest(was + start, was - F.col("_least"))))
        .withColumn("_after", F.greatest(F.col("_before") + units, zero))
        .withColumns({"_times": F.when(units > 0, 1.0).otherwise(left), "_plus": F.when(units > 0, cost).otherwise(0.0)})
        .withColumn("_least", F.least("_sum", "_least"))
    )


def _valued(stocked: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Value before (``_worth``) and after (``_now``) each movement, from ``_worth0``, and the product of the factors so far.

    The movements of a range are followed one after the other, as their rounding depends on the order.
    """
    added = ["_worth", "_now", "_product"]

    def follow(batches):
        import pyarrow as pa

        now, product = 0.0, 1.0
        for batch in batches:
            out = ([], [], [])
            for n, start, times, plus in zip(*[batch.column(c).to_pylist() for c in ("_n", "_worth0", "_times", "_plus")], strict=True):
                if n == 1:
                    now, product = start or 0.0, 1.0
                out[0].append(now)
                now = now * times + plus
                product *= times
                out[1].append(now)
                out[2].append(product)
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(x, pa.float64()) for x in out]], names=[*batch.schema.names, *added])

    schema = T.StructType([*stocked.schema.fields, *[T.StructField(c, T.DoubleType()) for c in added]])
    return stocked.sortWithinPartitions("_range", *keys, *order).mapInArrow(follow, schema)


def _starts(moves: DataFrame, cut: Ranges) -> DataFrame:
    """Stock and value with which a key that was cut goes on in a range: from one row for each range of such a key."""
    keys, order = cut.keys, cut.order
    none = F.lit(None).cast("bigint").alias("_stock0")
    if cut.count == 1:
        return moves.select(none, F.lit(None).cast("double").alias("_worth0")).limit(0)
    few = materialize(cut.numbered(cut.of_cut_keys(moves.select(*dict.fromkeys([*keys, *order, "Units", "Cost"])))), "cut")
    by = ["_range", *keys]
    sums = _stocked(few.select("*", none), keys, order).groupBy(*by).agg(F.max_by("_sum", "_n").alias("_by"), F.min("_least").alias("_low"))
    zero = F.lit(0).cast("bigint")
    step = clamped(F.col("_by"), F.col("_by") - F.col("_low"), F.lit(_NO_LIMIT).cast("bigint"))
    stocks = scan_before(sums, keys, ["_range"], step, then_clamped, "_step").select(*by, apply_clamped(F.col("_step"), zero).alias("_stock0"))
    stocks = materialize(stocks, "stocks")
    again = _stocked(cut.carried(few, stocks, ["_stock0"]), keys, order).select(*by, *order, "_n", "_times", "_plus", F.lit(0.0).alias("_worth0"))
    last = _valued(again, keys, order).groupBy(*by).agg(F.max_by(F.struct("_product", "_now"), "_n").alias("_last"))
    value = affine(F.col("_last._product"), F.col("_last._now"))
    worths = scan_before(last, keys, ["_range"], value, then_affine, "_value").withColumn("_worth0", apply_affine(F.col("_value"), F.lit(0.0)))
    named = worths.select(*[F.col(c).alias(f"_of_{c}") for c in by], "_worth0")
    same = F.lit(True)
    for c in by:
        same = same & stocks[c].eqNullSafe(named[f"_of_{c}"])
    return materialize(stocks.join(named, same).select(*by, "_stock0", "_worth0"), "starts")


def average_cost(moves: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Stock, value and average cost after each movement of a stock.

    ``Units`` are whole hundredths, positive for receipts, which bring their
    ``Cost`` along, and negative for issues, which leave at the average so far and
    never take more than there is. The stock is a bounded sum and the value an
    affine function of the value before (a receipt adds its cost; an issue keeps the
    share of the stock that it leaves), so what a range of the movements does to both
    is one step: no task holds a whole stock. The movements are shuffled once, into
    their ranges (``ranges``); only those of stocks that were cut are read before, for
    what each range of them begins with.
    """
    order = [c for c in order if c not in keys]
    cut = ranges_of(sample_of(moves), keys, order)
    rows = cut.carried(cut.dealt(moves), _starts(moves, cut), ["_stock0", "_worth0"])
    kept = ["_n", "_before", "_after", "_times", "_plus", "_worth0"]
    valued = _valued(_stocked(rows, keys, order).select(*[F.col(f"`{c}`") for c in moves.columns], "_range", *kept), keys, order)
    return (
        valued.withColumns({
            "QuantityBefore": double("_before") / 100.0,
            "QuantityAfter": double("_after") / 100.0,
            "StockValue": to_places(F.col("_now"), 2),
            "AverageCost": F.when(F.col("_after") > 0, to_places(F.col("_now") * 100.0 / double("_after"), 4)),
            "IssueCost": F.when(F.coalesce("Units", F.lit(0)) <= 0, to_places(F.col("_worth") - F.col("_now"), 2)),
        })
        .drop("_range", *kept, "_worth", "_now", "_product")
    )
