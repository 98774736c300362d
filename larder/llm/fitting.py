"""Fitting a linear model on a bounded sample of labelled rows by averaging over shards."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.columns import content_key, fold, text_of
from larder.sources.scratch import materialize

WEIGHTS = "spot int, weight double, mass double"


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, per_class: int, shards: int
) -> DataFrame:
    """(shard, doc_id, text, label): at most ``per_class`` labelled documents of each class.

    Rows of the held-out fold never enter. An id with several labels takes the
    largest; rows equal in id and text are one document and train once, an id with
    several texts has as many documents. The sample is the documents with the
    smallest hashes of the id and then of the text, so it is the same on every run.
    The ids and the documents picked are at most ``per_class`` rows of each class
    and therefore safe to broadcast, and so no shard has more than these.
    """
    known = (
        labels.select(F.col("doc_id").cast("long").alias("_id"), F.col(label).cast("int").alias("_label"))
        .where(F.col("_id").isNotNull() & F.col("_label").isin(0, 1))
        .groupBy("_id").agg(F.max("_label").alias("_label"))
        .where(fold(F.col("_id"), folds) != held_out)
    )
    picked = None
    for kind in (0, 1):
        part = known.where(F.col("_label") == kind).orderBy(F.xxhash64("_id"), "_id").limit(per_class)
        picked = part if picked is None else picked.unionByName(part)
    text = text_of(docs)
    texts = docs.select(*content_key(docs, text), text.alias("_text"))
    keys = materialize(texts.join(F.broadcast(picked), "_id").select("_id", "_content", "_label").distinct(), "sampled")
    kept = None
    for kind in (0, 1):
        part = keys.where(F.col("_label") == kind).orderBy(F.xxhash64("_id"), "_id", "_content").limit(per_class)
        kept = part if kept is None else kept.unionByName(part)
    joined = texts.join(F.broadcast(kept), ["_id", "_content"]).groupBy("_id", "_content", "_label").agg(F.first("_text").alias("_text"))
    joined = joined.select(
        F.pmod(F.xxhash64("_id", F.lit(3)), F.lit(shards)).cast("int").alias("shard"),
        F.col("_id").alias("doc_id"), F.col("_text").alias("text"), F.col("_label").alias("label"),
    )
    return materialize(joined.repartition(shards, "shard"), "sample")


def _shard_fit(train: Callable, sent: Broadcast, size: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        weights = np.zeros(size)
        weights[sent.value[0]] = sent.value[1]
        return train(rows.sort_values(["doc_id", "text"], kind="stable"), weights)

    return fit


def average(sample: DataFrame, train: Callable[[pd.DataFrame, np.ndarray], pd.DataFrame], size: int, rounds: int) -> np.ndarray:
    """Weights after ``rounds`` of training every shard from the common weights.

    ``train`` gets one shard, bounded by the sample, and the weights so far, and
    returns (spot, weight, mass). A weight becomes the mean over shards, weighted
    by mass, so a shard that saw little of a feature has little say in it. What
    comes to the driver is at most ``size`` numbers.
    """
    weights = np.zeros(size)
    for _ in range(rounds):
        heavy = np.flatnonzero(weights)
        sent = sample.sparkSession.sparkContext.broadcast((heavy, weights[heavy]))

        found = (
            sample.groupBy("shard").applyInPandas(_shard_fit(train, sent, size), WEIGHTS)
            .groupBy("spot")
            .agg((F.sum(F.col("weight") * F.col("mass")) / F.sum("mass")).alias("weight"))
            .where("weight <> 0")
            .toPandas()
        )
        sent.destroy()
        weights = np.zeros(size)
        weights[found["spot"].to_numpy(dtype=int)] = found["weight"].to_numpy(dtype=float)
    return weights
