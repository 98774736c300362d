"""Quality: a linear-chain conditional random field over the lines of a document.

Every line is good or bad. Its features are binned measures of the line itself
(length, words, share of capitals, digits, symbols, bars, immediate word
repeats and so on) and of the lines before and after it; a transition weight
ties neighbours. Forward-backward gives the marginal of every line, and the
marginals weighted by line length make the quality of the document.

Training takes the label of a document as the label of its lines, on at most
``per_class`` documents of each class, by gradient steps on shards whose weights
are averaged.

Cases: a null or empty text is one empty line; blank lines are lines; the
weight of a line is its length in bytes, one at least. An id with several labels
takes the largest, null labels and ids never train, and without training rows of
both classes all documents score the class there is (0.5 without any).
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

BINS = 8
MEASURES = 11
OWN = BINS * MEASURES
SIZE = 3 * OWN + 2 + 3  # this line, the one before, the one after; no line there; transitions and bias
STAY, GOOD_FIRST, BIAS = SIZE - 3, SIZE - 2, SIZE - 1


@dataclass(frozen=True)
class Settings:
    """per_class bounds the training sample: at most so many documents of each class."""

    per_class: int = 2500
    shards: int = 4
    rounds: int = 2
    epochs: int = 30
    rate: float = 0.15
    decay: float = 1e-4
    threshold: float = 0.3


def _shares(count: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Shares between 0 and 1 in bins that are finer near 0."""
    share = count / np.maximum(of, 1)
    return np.searchsorted(np.array([0.0, 0.01, 0.03, 0.08, 0.2, 0.45, 0.8]), share, side="left")


def _sizes(count: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(count + 1).astype(int) // 2 + (count > 0), BINS - 1)


def lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bins of the measures, bytes, first line of each row); the bytes are of texts as they are, not lower-cased."""
    breaks = np.flatnonzero(data == 10)
    rows = len(offsets) - 1
    owner = np.concatenate([np.arange(rows), np.searchsorted(offsets[1:], breaks, side="right")])
    starts = np.concatenate([offsets[:-1], breaks + 1])
    order = np.lexsort((starts, owner))
    owner, starts = owner[order], starts[order]
    firsts = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=rows))])
    ends = np.append(starts[1:], len(data))  # a line holds its break; a row's last line ends where the next row begins
    size = ends - starts

    def within(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask)])
        return total[ends] - total[starts]

    kinds = _KIND[data]
    begin, stop, hashes, _ = tx.words(data, np.concatenate([starts, [len(data)]]))
    of_line = np.searchsorted(starts, begin, side="right") - 1
    n_words = np.bincount(of_line, minlength=len(starts))
    follows = of_line[1:] == of_line[:-1]
    again = np.bincount(of_line[1:][follows & (hashes[1:] == hashes[:-1])], minlength=len(starts))
    word_bytes = np.bincount(of_line, stop - begin, minlength=len(starts))
    capital, digit, symbol, bar, space, loud, stop_mark = (within(kinds == k) for k in range(1, 8))
    bins = np.stack(
        [
            _sizes(size), _sizes(n_words), np.minimum((word_bytes / np.maximum(n_words, 1)).astype(int) // 2, BINS - 1),
            _shares(capital, size), _shares(digit, size), _shares(symbol, n_words + 1), _shares(bar, n_words + 1),
            _shares(space, size), _shares(again, n_words), _shares(loud, n_words + 1), _shares(stop_mark, n_words + 1),
        ],
        axis=1,
    )
    return np.minimum(bins, BINS - 1), np.maximum(size, 1), firsts


_KIND = np.zeros(256, dtype=np.uint8)
_KIND[65:91] = 1
_KIND[48:58] = 2
_KIND[[ord(c) for c in "#$%&*+<=>@\\^_`{}~[]"]] = 3
_KIND[ord("|")] = 4
_KIND[[9, 32]] = 5
_KIND[ord("!")] = 6
_KIND[[ord(c) for c in ".,;:?"]] = 7


def spots(bins: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """The weights that hold for each line: one per measure of it and of its neighbours."""
    own = bins + np.arange(MEASURES) * BINS
    before = np.full_like(own, 3 * OWN)
    after = np.full_like(own, 3 * OWN + 1)
    inner = np.ones(len(own), dtype=bool)
    inner[firsts[:-1]] = False
    at = np.flatnonzero(inner)
    before[at] = own[at - 1] + OWN
    after[at - 1] = own[at] + 2 * OWN
    return np.concatenate([own, before, after], axis=1)


def marginals(lean: np.ndarray, stay: float, first: float, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(good) of each line, and P(as the line before) of each line that has one, by forward-backward.

    ``lean`` is the log odds of good from the features. All documents advance by
    one line at a time, the long ones in front, so a step is one array operation.
    """
    counts = np.diff(firsts)
    order = np.argsort(-counts, kind="stable")
    heads, counts = firsts[:-1][order], counts[order]
    deepest = int(counts[0]) if len(counts) else 0
    open_at = np.searchsorted(-counts, -np.arange(deepest + 1), side="left")  # documents with more lines than t
    forward, backward = np.zeros(len(lean)), np.zeros(len(lean))

    def pass_on(odds: np.ndarray) -> np.ndarray:
        """Log odds after a transition that keeps the state with weight ``stay``."""
        return np.logaddexp(odds + stay, 0) - np.logaddexp(odds, stay)

    for t in range(deepest):
        at = heads[: open_at[t]] + t
        forward[at] = lean[at] + (first if t == 0 else pass_on(forward[at - 1]))
    for t in range(deepest - 2, -1, -1):
        at = heads[: open_at[t + 1]] + t
        backward[at] = pass_on(backward[at + 1] + lean[at + 1])
    good = 1 / (1 + np.exp(-np.clip(forward + backward, -500, 500)))
    inner = np.ones(len(lean), dtype=bool)
    inner[firsts[:-1]] = False
    at = np.flatnonzero(inner)
    left, right = forward[at - 1], lean[at] + backward[at]
    both = np.logaddexp(left + right, 0) + stay
    mixed = np.logaddexp(left, right)
    return good, 1 / (1 + np.exp(-np.clip(both - mixed, -500, 500)))


def _train(rows: pd.DataFrame, start: np.ndarray, s: Settings) -> pd.DataFrame:
    """Gradient steps on the conditional likelihood of one shard, each class of documents weighing the same."""
    parts = [(first, last, *lines(data, offsets)) for first, last, data, offsets in tx.chunks(pa.array(rows["text"], type=pa.large_string()))]
    labels = rows["label"].to_numpy(dtype=float)
    bins = np.concatenate([p[2] for p in parts])
    counts = np.concatenate([np.diff(p[4]) for p in parts])
    firsts = np.concatenate([[0], np.cumsum(counts)])
    used = spots(bins, firsts)
    truth = np.repeat(labels, counts)
    # a document counts once, whatever its number of lines
    share = np.where(labels == 1, 0.5 / max(labels.sum(), 1), 0.5 / max((1 - labels).sum(), 1))
    weight = np.repeat(share / counts, counts)
    inner = np.ones(len(truth), dtype=bool)
    inner[firsts[:-1]] = False
    w = start
    mean, spread = np.zeros(SIZE), np.zeros(SIZE)
    for step in range(1, s.epochs + 1):
        good, kept = marginals(w[used].sum(axis=1) + w[BIAS], w[STAY], w[GOOD_FIRST], firsts)
        pull = (truth - good) * weight
        gradient = np.bincount(used.ravel(), np.repeat(pull, used.shape[1]), minlength=SIZE) - s.decay * w
        gradient[BIAS] = pull.sum()
        gradient[GOOD_FIRST] = pull[firsts[:-1]].sum()
        gradient[STAY] = ((1 - kept) * weight[inner]).sum() - s.decay * w[STAY]
        mean = 0.9 * mean + 0.1 * gradient
        spread = 0.99 * spread + 0.01 * gradient**2
        w = w + s.rate * (mean / (1 - 0.9**step)) / (np.sqrt(spread / (1 - 0.99**step)) + 1e-8)
        w[STAY] = min(w[STAY], 2.0)
    return pd.DataFrame({"spot": np.arange(SIZE), "weight": w, "mass": np.ones(SIZE)})


@dataclass(frozen=True)
class Model:
    weights: np.ndarray

    def lines(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(P(good) of each line, its weight, first line of each row)."""
        bins, size, firsts = lines(data, offsets)
        w = self.weights
        good, _ = marginals(w[spots(bins, firsts)].sum(axis=1) + w[BIAS], w[STAY], w[GOOD_FIRST], firsts)
        return good, size, firsts

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        good, size, firsts = self.lines(data, offsets)
        return np.add.reduceat(good * size, firsts[:-1]) / np.add.reduceat(size, firsts[:-1])


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), held_out: int = 0, folds: int = 5) -> Model:
    sample = labelled_sample(docs, labels, "quality", folds, held_out, settings.per_class, settings.shards)
    used = dict(sample.groupBy("label").count().collect())
    weights = np.zeros(SIZE)
    if used.get(0) and used.get(1):
        weights = average(sample, lambda rows, start: _train(rows, start, settings), SIZE, settings.rounds)
    elif used:
        weights[BIAS] = 6.0 if used.get(1) else -6.0
    return Model(weights)


def line_quality(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and, for every document, the array of P(good) of its lines in order."""
    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in tx.chunks(batch.column(1)):
                good, _, firsts = model.lines(data, offsets)
                lists = pa.ListArray.from_arrays(pa.array(firsts, pa.int32()), pa.array(good))
                yield pa.RecordBatch.from_arrays([batch.column(0)[first:last], lists], names=["doc_id", "good"])

    return texts.mapInArrow(run, "doc_id long, good array<double>")


def quality(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    model = fit(docs, labels, settings)
    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [model.scores(data, offsets) for _, _, data, offsets in tx.chunks(batch.column(1))]
            found = pa.array(np.concatenate(parts) if parts else np.zeros(0))
            yield pa.RecordBatch.from_arrays([batch.column(0), found], names=["doc_id", "score"])

    return texts.mapInArrow(run, "doc_id long, score double").select(
        "doc_id",
        (fold(F.col("doc_id"), 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= settings.threshold).cast("int").alias("predicted"),
    )
