"""Levels, closure and roll-up of a self-referencing table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.sources.scratch import fresh_path, materialize

def levels(nodes: DataFrame, key: str, parent: str) -> DataFrame:
    """Add ``RootID`` and ``Level`` (0 at the root) to ``key`` and ``parent``.

    Each round replaces a node's known ancestor by that ancestor's own, which
    doubles the distance covered: a chain of depth d takes about log2(d) rounds,
    not d. Only nodes still short of their root take part in a round, and each
    round's table is written out, so lineage stays short. A parent that is not a
    node ends its chain. Cycles raise ValueError.
    """
    is_root = F.col(parent).isNull() | (F.col(parent) == F.col(key))
    state = materialize(
        nodes.select(
            F.col(key).alias("node"),
            F.when(is_root, F.col(key)).otherwise(F.col(parent)).alias("up"),
            F.when(is_root, 0).otherwise(1).cast("bigint").alias("distance"),
            (~is_root).alias("open"),
        ),
        "hierarchy",
    )
    # the longest chain without a cycle has as many steps as there are nodes
    for _ in range(state.count().bit_length() + 1):
        climbing = state.where("open")
        if climbing.isEmpty():
            break
        above = state.select(
            F.col("node").alias("up"),
            F.col("up").alias("next_up"),
            F.col("distance").alias("next_distance"),
            F.col("open").alias("next_open"),
        )
        climbed = climbing.join(above, "up", "left").select(
            "node",
            F.coalesce("next_up", "up").alias("up"),
            (F.col("distance") + F.coalesce("next_distance", F.lit(0))).alias("distance"),
            F.coalesce("next_open", F.lit(False)).alias("open"),
        )
        state = materialize(state.where("NOT open").unionByName(climbed), "hierarchy")
    else:
        raise ValueError(f"{key} -> {parent} contains a cycle")
    return nodes.select(key, parent).join(
        state.select(
            F.col("node").alias(key), F.col("up").alias("RootID"), F.col("distance").alias("Level")
        ),
        key,
    )


def closure(nodes: DataFrame, key: str, parent: str) -> DataFrame:
    """All pairs ``AncestorID``, ``DescendantID`` and ``Depth``, a node and itself (depth 0) included.

    Round k joins the pairs that are exactly 2 ** k apart with all closer ones,
    which gives every pair from 2 ** k to 2 ** (k + 1) - 1 apart once; finished
    pairs are appended to one table and never rewritten. A parent that is not a
    node ends its chain. Cycles raise ValueError.
    """
    spark = nodes.sparkSession
    known = nodes.select(F.col(key).alias("AncestorID")).distinct()
    edges = nodes.where(F.col(parent) != F.col(key)).select(F.col(parent).alias("AncestorID"), F.col(key).alias("DescendantID"))
    apart = materialize(edges.join(known, "AncestorID", "left_semi").distinct(), "closure-step")
    path = fresh_path(spark, "closure")
    depth = F.lit(0).cast("bigint").alias("Depth")
    known.select("AncestorID", F.col("AncestorID").alias("DescendantID"), depth).write.parquet(path)
    reach = 1
    for _ in range(known.count().bit_length() + 1):
        done = spark.read.parquet(path)
        if apart.isEmpty():
            return done
        above = apart.select("AncestorID", F.col("DescendantID").alias("_mid"))
        below = lambda df: df.withColumnRenamed("AncestorID", "_mid")
        longer = above.join(below(done), "_mid").select("AncestorID", "DescendantID", (F.col("Depth") + F.lit(reach)).alias("Depth"))
        further = materialize(above.join(below(apart), "_mid").select("AncestorID", "DescendantID"), "closure-step")
        longer.write.mode("append").parquet(path)
        apart, reach = further, reach * 2
    raise ValueError(f"{key} -> {parent} contains a cycle")


def roll_up(pairs: DataFrame, measures: DataFrame, key: str, names: list[str]) -> DataFrame:
    """Per node: how many nodes are below it, how deep, its own measures and those of its whole tree."""
    own = measures.select(F.col(key).alias("DescendantID"), *[F.col(n).alias(f"_{n}") for n in names])
    below = F.col("Depth") > 0
    return (
        pairs.join(own, "DescendantID", "left")
        .groupBy(F.col("AncestorID").alias(key))
        .agg(
            F.count_if(below).alias("Below"),
            F.max("Depth").alias("Levels"),
            *[F.coalesce(F.sum(F.when(~below, F.col(f"_{n}"))), F.lit(0)).alias(f"Own{n}") for n in names],
            *[F.coalesce(F.sum(f"_{n}"), F.lit(0)).alias(f"Tree{n}") for n in names],
        )
    )
