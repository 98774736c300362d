"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.sources.scratch import materialize


def connected_components(edges: DataFrame, files: int) -> DataFrame:
    """(node, root): the smallest node of its component for every node of the edges (u, v).

    A round hangs the larger neighbours of every node on its smallest neighbour,
    then the smaller ones; the table never grows beyond the edges, and each round
    is written to at most ``files`` files, so a lost executor costs a re-read.
    Self-loops are allowed.
    """
    first = materialize(
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges", files
    )
    now, mark = first.where("u <> v"), None
    while True:
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = materialize(large, "large", files)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(joined.select("u", F.col("m").alias("v")))
        now = materialize(small.where("u <> v").distinct(), "stars", files)
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1000003)).first()
        if seen == mark:
            break
        mark = seen
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    nodes = first.select(F.col("u").alias("node")).union(first.select(F.col("v"))).distinct()
    return nodes.join(stars, "node", "left").select("node", F.coalesce("root", "node").alias("root"))
