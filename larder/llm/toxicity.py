"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a document are the distinct hashes of its words, of the leading
bytes of its words (which tie inflected and compound forms together), of its
word pairs and of its skip-pairs. FTRL-proximal gives every coordinate its own
rate and, through L1, leaves most weights at exactly zero; only the others are
sent to the tasks that score.

Cases: a null or empty text has no features and scores the intercept; an id
with several labels takes the largest; null labels and ids never train; without
any training row of a class every document scores the share of the other one
(0.5 when there is no labelled row at all). Repeated rows each get the score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm import text as tx
from larder.llm.columns import fold, text_of
from larder.llm.fitting import average, labelled_sample

STEMS = (4, 5)
SKIPS = (2, 3)


@dataclass(frozen=True)
class Settings:
    """per_class bounds the training sample: at most so many documents of each class."""

    bits: int = 20
    per_class: int = 4000
    shards: int = 4
    rounds: int = 2
    epochs: int = 2
    alpha: float = 0.2
    beta: float = 1.0
    l1: float = 8.0
    l2: float = 0.5
    threshold: float = 0.3


def features(data: np.ndarray, offsets: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, spots): every feature of every row, repeats included."""
    starts, ends, hashes, firsts = tx.words(data, offsets)
    rows = tx.row_of(firsts, len(hashes))
    sums = tx.prefix_sums(tx.BYTE_CODES[data])
    found = [(rows, hashes)]
    for length in STEMS:
        long = np.flatnonzero(ends - starts >= length)
        stem = tx.span_hashes(sums, starts[long], starts[long] + length)
        found.append((rows[long], tx.mix(stem + np.uint64(length))))
    for step in (1, *SKIPS):
        pairs = tx.grams(hashes, (step,))
        same = rows[: len(pairs)] == rows[len(rows) - len(pairs) :]
        found.append((rows[: len(pairs)][same], pairs[same]))
    spots = np.concatenate([h for _, h in found]) >> np.uint64(64 - bits)
    return np.concatenate([r for r, _ in found]), spots.astype(np.int64)


def _examples(rows: pd.DataFrame, bits: int) -> list[np.ndarray]:
    """The distinct features of each training document."""
    out = []
    for first, last, data, offsets in tx.chunks(pa.array(rows["text"], type=pa.large_string())):
        at, spots = features(data, offsets, bits)
        distinct = np.unique((at << bits) | spots)
        cuts = np.searchsorted(distinct, np.arange(1, last - first) << bits)
        out += np.split(distinct & ((1 << bits) - 1), cuts)
    return out


def _train(rows: pd.DataFrame, start: np.ndarray, s: Settings) -> pd.DataFrame:
    """FTRL-proximal over one shard; the last spot is the intercept."""
    examples = _examples(rows, s.bits)
    labels = rows["label"].to_numpy(dtype=float)
    squares = np.zeros(len(start))
    # the state in which the closed form returns the weights started from
    pull = -start * (s.beta / s.alpha + s.l2) - np.sign(start) * s.l1
    order = np.random.default_rng(1)
    for _ in range(s.epochs):
        for i in order.permutation(len(examples)):
            spots = np.append(examples[i], len(start) - 1)
            z, n = pull[spots], squares[spots]
            shrink = np.where(np.arange(len(spots)) == len(spots) - 1, 0.0, s.l1)
            weights = np.where(
                np.abs(z) <= shrink, 0.0,
                -(z - np.sign(z) * shrink) / ((s.beta + np.sqrt(n)) / s.alpha + s.l2),
            )
            error = 1 / (1 + np.exp(-np.clip(weights.sum(), -35, 35))) - labels[i]
            grown = n + error * error
            pull[spots] = z + error - (np.sqrt(grown) - np.sqrt(n)) / s.alpha * weights
            squares[spots] = grown
    shrink = np.full(len(start), s.l1)
    shrink[-1] = 0.0
    weights = np.where(
        np.abs(pull) <= shrink, 0.0, -(pull - np.sign(pull) * shrink) / ((s.beta + np.sqrt(squares)) / s.alpha + s.l2)
    )
    seen = np.flatnonzero((squares > 0) | (weights != 0))
    return pd.DataFrame({"spot": seen, "weight": weights[seen], "mass": squares[seen] + 1e-9})


@dataclass(frozen=True)
class Model:
    """Spots with a weight other than zero, their weights, and the intercept."""

    spots: np.ndarray
    weights: np.ndarray
    intercept: float
    bits: int

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        total = np.full(len(offsets) - 1, self.intercept)
        if len(self.spots):
            table = np.zeros(1 << self.bits)
            table[self.spots] = self.weights
            rows, spots = features(data, offsets, self.bits)
            heavy = table[spots] != 0
            pairs = np.unique((rows[heavy] << self.bits) | spots[heavy])
            total += np.bincount(pairs >> self.bits, table[pairs & ((1 << self.bits) - 1)], minlength=len(total))
        return 1 / (1 + np.exp(-np.clip(total, -35, 35)))


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), held_out: int = 2, folds: int = 4) -> Model:
    """Fit on the labelled documents outside the held-out fold."""
    s = settings
    sample = labelled_sample(docs, labels, "toxic", folds, held_out, s.per_class, s.shards).withColumn("text", F.lower("text"))
    used = dict(sample.groupBy("label").count().collect())
    whole = dict(
        labels.where(F.col("toxic").isin(0, 1) & (fold(F.col("doc_id").cast("long"), folds) != held_out))
        .groupBy(F.col("toxic").cast("int")).count().collect()
    )
    if not used.get(0) or not used.get(1):
        share = 0.5 if not used else float(bool(used.get(1)))
        odds = np.log((share + 1e-3) / (1 - share + 1e-3))
        return Model(np.zeros(0, np.int64), np.zeros(0), float(odds), s.bits)
    size = (1 << s.bits) + 1
    weights = average(sample, lambda rows, start: _train(rows, start, s), size, s.rounds)
    # the sample may hold the classes in other shares than the labels do
    shift = np.log(whole[1] / whole[0]) - np.log(used[1] / used[0])
    spots = np.flatnonzero(weights[:-1])
    return Model(spots, weights[spots], float(weights[-1] + shift), s.bits)


def score(docs: DataFrame, model: Model, keep: list[str], name: str = "score") -> DataFrame:
    """The columns ``keep`` of ``docs`` and the score as ``name``, one row for each row of ``docs``."""
    fields = docs.select(*[docs[f"`{column}`"] for column in keep], F.lit(0.0).alias(name))
    kept = docs.select(*[docs[f"`{column}`"] for column in keep], F.lower(text_of(docs)))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [sent.value.scores(data, offsets) for _, _, data, offsets in tx.chunks(batch.column(len(keep)))]
            found = pa.array(np.concatenate(parts) if parts else np.zeros(0))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], found], names=[*keep, name])

    return kept.mapInArrow(run, fields.schema)


def toxicity(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    model = fit(docs, labels, settings)
    return score(docs, model, ["doc_id"]).select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (fold(F.col("doc_id").cast("long"), 4) == 2).alias("held_out"),
        "score",
        (F.col("score") >= settings.threshold).cast("int").alias("predicted"),
    )
