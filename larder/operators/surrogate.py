"""Dense surrogate keys and assignment of parents by position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.sources.scratch import materialize

# monotonically_increasing_id() holds the partition number above this many bits
# and the position inside the partition below them.
_POSITION_BITS = 33
_POSITION_MASK = (1 << _POSITION_BITS) - 1


def dense_ids(df: DataFrame, order: list[str], name: str, first: int = 1) -> DataFrame:
    """Number the rows ``first, first+1, ...`` in the order of ``order``.

    The order columns must identify a row. Rows are range partitioned and sorted
    inside their partition, which makes (partition, position) the global order;
    one table with a count per partition then turns positions into dense ids. No
    task sees more than its own range, however many rows there are.
    """
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    stored = materialize(placed, "dense-ids")
    part = F.shiftright("_place", _POSITION_BITS)
    # one row per partition, so the window below is over a bounded number of rows
    counts = stored.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset")
    )
    position = F.col("_place").bitwiseAND(F.lit(_POSITION_MASK))
    return (
        stored.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + position + F.lit(first))
        .drop("_part", "_place", "_offset")
    )


def assign_round_robin(
    children: DataFrame, sequence: Column, parents: DataFrame, parent_key: str, name: str
) -> DataFrame:
    """Give child ``i`` the parent at position ``i mod n`` of the sorted parents.

    Parents are numbered densely, so gaps in their keys do no harm; the join is
    left to the planner, which broadcasts the parents only where they are small.
    Without parents, children get NULL.
    """
    numbered = dense_ids(parents.select(parent_key), [parent_key], "_position", first=0)
    count = max(parents.count(), 1)
    return (
        children.withColumn("_position", (sequence % F.lit(count)).cast("bigint"))
        .join(numbered.withColumnRenamed(parent_key, name), "_position", "left")
        .drop("_position")
    )
