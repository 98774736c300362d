"""Benchmark decontamination: latent semantic retrieval, then word-order and answer checks.

Passages are windows of two neighbouring segments of ``segment`` words, so they
overlap by half. Words are hashed to 2 ** bits columns, weighted by the inverse
document frequency of their column over all distinct texts, so copies of a text
do not make its words common; a column of every text still weighs ``floor``.
Distinct texts are counted in sketches of the texts' hashes, whose size does not
depend on the number of texts and which copies do not change. A randomised singular value
decomposition of the TF-IDF rows of the benchmark's passages gives the latent
space: tasks send products of their rows with a thin matrix, whose size does not
depend on the number of rows, and the driver orthonormalises the sum. The
benchmark is projected and searched in blocks of bounded size; a passage whose
cosine with an item reaches ``cosine``, times the part of its length that the
item's own passages keep in the space, is a candidate. What the space holds
badly is also found without it: a text that shares ``gram`` words in a row with
an item is a candidate where the two lie over each other.

A candidate is confirmed on the words themselves: the longest common subsequence
of the item and the passage with its surroundings covers ``overlap`` of the item
(of its weight in inverse frequencies as well as of its words), and ``answer`` of
the words of its last part, the answer, occur there too; an item of which every
word is found in order needs no more. So a paraphrase that
drops or changes some words is found, and text that shares the words of the
language is not.

Items of fewer than ``least`` words are too short for shares of their words: they
are found exactly, where all their words follow each other in a text, by the hash
of their word sequence among the grams of that length in all texts.

Cases: null and empty texts are clean; items without words are not searched; of several items in a
document the one with the largest share counts, ties to the smaller id; rows of
an item id that repeats are items of their own; an empty benchmark leaves all
documents clean; repeated rows each get their result; a column of the documents with the
name of a column made here is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm import text as tx
from larder.llm.columns import content_key, others, same_key, text_of
from larder.sources.scratch import materialize


@dataclass(frozen=True)
class Settings:
    segment: int = 32
    bits: int = 13
    rank: int = 128
    extra: int = 16
    floor: float = 0.1
    registers: int = 128
    shards: int = 4
    cosine: float = 0.2
    overlap: float = 0.6
    answer: float = 0.5
    answer_part: float = 0.25
    least: int = 8
    gram: int = 5
    items_per_block: int = 20000
    seed: int = 5


def segments(firsts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word of each segment, row of each segment) for rows that have words."""
    counts = np.diff(firsts)
    per_row = -(-counts // size)
    row = np.repeat(np.arange(len(counts)), per_row)
    within = np.arange(len(row)) - np.repeat(np.cumsum(per_row) - per_row, per_row)
    return firsts[:-1][row] + within * size, row


def passages(
    columns: np.ndarray, firsts: np.ndarray, table: np.ndarray, weights: np.ndarray, s: Settings
) -> tuple[np.ndarray, ...]:
    """(vectors, rows, first words, last words + 1) of the passages that can reach the cosine.

    ``table`` has the vector of each column, zero for columns that no item has.
    Vectors are divided by the length of the passage's whole TF-IDF vector, which
    bounds the cosine by the share of the columns with a vector.
    """
    begin, row = segments(firsts, s.segment)
    end = np.minimum(begin + s.segment, firsts[row + 1])
    squares = weights[columns] ** 2
    known = (table != 0).any(axis=1)[columns]
    padded = np.concatenate([table, np.zeros((1, table.shape[1]), table.dtype)])
    sums = np.zeros((len(begin), table.shape[1]), table.dtype)
    for k in range(s.segment if len(begin) else 0):
        at = begin + k
        sums += padded[np.where(at < end, columns[np.minimum(at, end - 1)], len(table))]
    total, found = (np.add.reduceat(x, begin) if len(begin) else np.zeros(0) for x in (squares, squares * known))
    paired = np.zeros(len(row), dtype=bool)
    paired[:-1] = row[1:] == row[:-1]
    alone = ~paired & np.concatenate([[True], ~paired[:-1]])[: len(row)]
    keep = np.flatnonzero(paired | alone)
    after = np.where(paired[keep], keep + 1, -1)
    join = lambda x: x[keep] + np.where(after >= 0, x[after], 0) if len(x) else x[keep]
    found, total = join(found), join(total)
    fits = (found > 0) & (found >= s.cosine**2 * total)
    keep, after, total = keep[fits], after[fits], total[fits]
    vectors = sums[keep]
    two = after >= 0
    vectors[two] += sums[after[two]]
    return vectors / np.sqrt(total)[:, None].astype(table.dtype), row[keep], begin[keep], end[np.where(two, after, keep)]


def _columns(hashes: np.ndarray, s: Settings) -> np.ndarray:
    return (hashes >> np.uint64(64 - s.bits)).astype(np.int64)


def _estimates(registers: np.ndarray) -> np.ndarray:
    """HyperLogLog: the number of distinct hashes behind each row of registers."""
    m = registers.shape[1]
    raw = 0.7213 / (1 + 1.079 / m) * m * m / np.exp2(-registers.astype(float)).sum(axis=1)
    empty = (registers == 0).sum(axis=1)
    return np.where((raw <= 2.5 * m) & (empty > 0), m * np.log(m / np.maximum(empty, 1)), raw)


def frequencies(texts: DataFrame, s: Settings) -> tuple[np.ndarray, float]:
    """In how many distinct texts each column occurs, and how many there are, by sketches."""
    size = 1 << s.bits
    blocks = 32

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = np.zeros((size + blocks) * s.registers, dtype=np.uint8)
        for batch in batches:
            names = tx.mix(batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64))
            spot = (names % np.uint64(s.registers)).astype(np.int64)
            rest = names // np.uint64(s.registers) | np.uint64(1 << 56)
            rank = (np.log2((rest & (~rest + np.uint64(1))).astype(float)) + 1).astype(np.uint8)
            np.maximum.at(kept, size * s.registers + spot, rank)
            for first, _, data, offsets in tx.chunks(batch.column(0)):
                _, _, hashes, firsts = tx.words(data, offsets)
                row = first + tx.row_of(firsts, len(hashes))
                np.maximum.at(kept, _columns(hashes, s) * s.registers + spot[row], rank[row])
        parts = kept.reshape(blocks, -1)
        filled = np.flatnonzero(parts.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(filled, pa.int32()), pa.array([parts[k].tobytes() for k in filled], pa.binary())], names=["k", "part"]
        )

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        part = np.frombuffer(pdf["part"].iloc[0], dtype=np.uint8)
        for more in pdf["part"].iloc[1:]:
            part = np.maximum(part, np.frombuffer(more, dtype=np.uint8))
        return pd.DataFrame({"k": pdf["k"].iloc[:1], "part": [part.tobytes()]})

    sketched = texts.mapInArrow(run, "k int, part binary")
    out = np.zeros((blocks, (size // blocks + 1) * s.registers), dtype=np.uint8)
    for k, part in sketched.groupBy("k").applyInPandas(merge, "k int, part binary").collect():
        out[k] = np.frombuffer(part, dtype=np.uint8)
    found = _estimates(out.reshape(-1, s.registers))
    return np.minimum(found[:size], found[size]), float(found[size])


def _rows(pdf: pd.DataFrame, weights: np.ndarray, s: Settings) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(columns, values) of the unit TF-IDF vector of each passage."""
    for _, _, data, offsets in tx.chunks(pa.array(pdf["text"], type=pa.large_string())):
        _, _, hashes, firsts = tx.words(data, offsets)
        columns = _columns(hashes, s)
        begin, row = segments(firsts, s.segment)
        for a, r in zip(begin.tolist(), row.tolist(), strict=True):
            own, count = np.unique(columns[a : min(a + 2 * s.segment, firsts[r + 1])], return_counts=True)
            values = count * weights[own]
            norm = np.sqrt((values**2).sum())
            if norm:
                yield own, values / norm


def _times(rows: DataFrame, weights: np.ndarray, thin: np.ndarray, gram: bool, s: Settings) -> np.ndarray:
    """A'(A thin), or (A thin)'(A thin), summed over the shards of the rows."""
    sent = rows.sparkSession.sparkContext.broadcast((weights, thin))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        weights, thin = sent.value
        out = np.zeros((thin.shape[1] if gram else thin.shape[0], thin.shape[1]))
        for own, values in _rows(pdf, weights, s):
            y = values @ thin[own]
            if gram:
                out += np.outer(y, y)
            else:
                out[own] += np.outer(values, y)
        at = np.flatnonzero(out.any(axis=1))
        return pd.DataFrame({"at": [at.tobytes()], "part": [out[at].tobytes()]})

    total = np.zeros((thin.shape[1] if gram else thin.shape[0], thin.shape[1]))
    for row in rows.groupBy("shard").applyInPandas(run, "at binary, part binary").toLocalIterator():
        total[np.frombuffer(row["at"], dtype=np.int64)] += np.frombuffer(row["part"]).reshape(-1, thin.shape[1])
    sent.destroy()
    return total


def latent_space(rows: DataFrame, weights: np.ndarray, s: Settings) -> np.ndarray:
    """columns x rank: the leading right singular vectors of the TF-IDF rows of all passages."""
    thin = np.random.default_rng(s.seed).standard_normal((1 << s.bits, s.rank + s.extra))
    for _ in range(2):
        thin = np.linalg.qr(_times(rows, weights, thin, False, s))[0]
    values, turn = np.linalg.eigh(_times(rows, weights, thin, True, s))
    return thin @ turn[:, np.argsort(-values)[: s.rank]]


@dataclass(frozen=True)
class Grams:
    """All grams of ``size`` words of some items, sorted, with their items and places; ``seen`` tells by leading bits."""

    size: int
    values: np.ndarray
    items: np.ndarray
    places: np.ndarray
    seen: np.ndarray

    def _leading(self, values: np.ndarray) -> np.ndarray:
        return (values >> np.uint64(65 - len(self.seen).bit_length())).astype(np.int64)

    def shared(self, hashes: np.ndarray, row: np.ndarray, most: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(rows, items, words at which the items would begin) of all equal grams, about ``most`` at a time."""
        values = tx.grams(hashes, tuple(range(1, self.size)))
        at = np.flatnonzero(self.seen[self._leading(values)])
        at = at[row[at] == row[at + self.size - 1]]
        low, high = (np.searchsorted(self.values, values[at], side) for side in ("left", "right"))
        upto = np.cumsum(high - low)
        first = 0
        while first < len(at):
            last = max(first + 1, int(np.searchsorted(upto, (upto[first - 1] if first else 0) + most, "right")))
            n = high[first:last] - low[first:last]
            which = np.arange(n.sum()) + np.repeat(low[first:last] - np.cumsum(n) + n, n)
            here = np.repeat(at[first:last], n)
            yield row[here], self.items[which], here - self.places[which]
            first = last


def _grams(words: list[np.ndarray], numbers: list[int], size: int) -> Grams:
    found = [tx.grams(words[k], tuple(range(1, size))) for k in numbers]
    values = np.concatenate(found)
    order = np.argsort(values, kind="stable")
    grams = Grams(
        size, values[order], np.repeat(numbers, [len(x) for x in found])[order],
        np.concatenate([np.arange(len(x)) for x in found])[order],
        np.zeros(1 << max(16, (16 * len(values)).bit_length()), dtype=bool),
    )
    grams.seen[grams._leading(values)] = True
    return grams


@dataclass(frozen=True)
class Items:
    """A block of benchmark items: ids, words, vectors of length one, the cosines that make candidates, and grams.

    Items of fewer than ``least`` words come last; they have grams of their whole length, but no vectors.
    """

    ids: list
    words: list[np.ndarray]
    vectors: np.ndarray
    cosines: np.ndarray
    grams: list[Grams]


def _unit(vectors: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.divide(vectors, norms, out=np.zeros_like(vectors), where=norms > 0)


def _kept(columns: np.ndarray, table: np.ndarray, weights: np.ndarray, s: Settings) -> float:
    """The smallest part of its length that a passage of an item keeps in the space."""
    parts = []
    for a in range(0, max(len(columns) - s.segment, 1), s.segment):
        own, count = np.unique(columns[a : a + 2 * s.segment], return_counts=True)
        parts.append(np.linalg.norm(count @ table[own]) / np.linalg.norm(count * weights[own]))
    return float(min(parts))


def _items(rows: list, table: np.ndarray, weights: np.ndarray, s: Settings) -> Items:
    ids, words, vectors, cosines, short = [], [], [], [], []
    for item_id, text in rows:
        data = np.frombuffer(text.encode(), dtype=np.uint8)
        hashes = tx.words(data, np.array([0, len(data)]))[2]
        if len(hashes) >= s.least:
            ids.append(item_id)
            words.append(hashes)
            columns = _columns(hashes, s)
            vectors.append(table[columns].sum(axis=0))
            kept = _kept(columns, table, weights, s)
            # a vector of rounding errors has no direction; such an item is left to its grams
            cosines.append(s.cosine * min(kept, 1.0) if kept > 1e-4 else np.inf)
        elif len(hashes):
            short.append((item_id, hashes))
    grams = [_grams(words, list(range(len(words))), s.gram)] if words else []
    ids, words = ids + [i for i, _ in short], words + [h for _, h in short]
    for size in sorted({len(h) for _, h in short}):
        grams.append(_grams(words, [k for k in range(len(vectors), len(words)) if len(words[k]) == size], size))
    unit = _unit(np.array(vectors, dtype=np.float32).reshape(len(vectors), table.shape[1]))
    return Items(ids, words, unit, np.array(cosines, dtype=np.float32), grams)


def aligned(row: np.ndarray, item: np.ndarray, begin: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """(row, item, first, last begin) of begins of an item in a row that lie within its length, each once."""
    if not len(row):
        return
    bucket = begin // lengths[item]
    order = np.lexsort((begin, bucket, item, row))
    row, item, begin, bucket = row[order], item[order], begin[order], bucket[order]
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (item[1:] != item[:-1]) | (bucket[1:] != bucket[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(row)) - 1
    yield from zip(row[first].tolist(), item[first].tolist(), begin[first].tolist(), begin[last].tolist(), strict=True)


def common_subsequence(item: np.ndarray, region: np.ndarray) -> list[int]:
    """Places in the item of a longest common subsequence with the region."""
    masks: dict[int, int] = {}
    for k, word in enumerate(item.tolist()):
        masks[word] = masks.get(word, 0) | 1 << k
    n, full = len(item), (1 << len(item)) - 1
    state, steps = full, []
    for word in region.tolist():
        mask = masks.get(word)
        if mask:
            hit = state & mask
            state = (state + hit | state - hit) & full
            steps.append((mask, state))
    # zeros of the state are the lengths' steps; go back from the last
    places, limit = [], n
    for k in range(len(steps) - 1, -1, -1):
        mask, now = steps[k]
        before = steps[k - 1][1] if k else full
        window = (1 << limit) - 1
        if bin(~now & window).count("1") > bin(~before & window).count("1"):
            # a step appeared within the limit: the word ends a subsequence at the largest fitting place
            fits = mask & window
            while fits:
                place = fits.bit_length() - 1
                below = (1 << place) - 1
                if bin(~before & below).count("1") + 1 == bin(~now & window).count("1"):
                    places.append(place)
                    limit = place
                    break
                fits &= below
    return places[::-1]


class Coverage:
    """Which (passage, item) pairs have enough of the item's words around the passage, counted for many pairs at a time.

    No item has more of its words in its own region than in that of the widest item, which is the one looked at.
    """

    def __init__(self, held: list[np.ndarray], vocabulary: np.ndarray, s: Settings, room: int = 1 << 23) -> None:
        self.lengths = np.array([len(w) for w in held], dtype=np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.spots = np.searchsorted(vocabulary, np.concatenate([np.zeros(0, np.uint64), *held]))
        self.none = len(vocabulary)
        self.widest = int(self.lengths.max(initial=0))
        self.least = s.overlap * self.lengths - 1e-6
        self.room = room

    def __call__(
        self, passage: np.ndarray, item: np.ndarray, begin: np.ndarray, end: np.ndarray, row: np.ndarray, firsts: np.ndarray, spot: np.ndarray
    ) -> Iterator[tuple[int, int]]:
        """The pairs that stay, in their order; ``passage`` ascends, and ``spot`` has the vocabulary's place of each word."""
        most_pairs, most_passages = max(1, self.room // max(self.widest, 1)), max(1, self.room // (self.none + 1))
        new = np.flatnonzero(np.diff(passage, prepend=-1))
        number = np.cumsum(np.diff(passage, prepend=-1) != 0) - 1
        done = 0
        while done < len(passage):
            upto = number[done] + most_passages
            last = min(done + most_pairs, int(new[upto]) if upto < len(new) else len(passage))
            pairs = slice(done, last)
            own, local = np.unique(passage[pairs], return_inverse=True)
            low = np.maximum(begin[own] - self.widest, firsts[row[own]])
            high = np.minimum(end[own] + self.widest, firsts[row[own] + 1])
            present = np.zeros((len(own), self.none + 1), dtype=bool)
            present[np.repeat(np.arange(len(own)), high - low), spot[_ranges(low, high)]] = True
            present[:, -1] = False
            k = item[pairs]
            n = self.lengths[k]
            words = self.spots[_ranges(self.starts[k], self.starts[k] + n)]
            found = np.add.reduceat(present[np.repeat(local, n), words], np.cumsum(n) - n, dtype=np.int64)
            fits = np.flatnonzero(found >= self.least[k])
            yield from zip(own[local[fits]].tolist(), k[fits].tolist(), strict=True)
            done = last


def _ranges(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The numbers from each low up to its high, one range after the other."""
    n = high - low
    return np.arange(n.sum()) + np.repeat(low - np.cumsum(n) + n, n)


def confirm(item: np.ndarray, region: np.ndarray, weight: np.ndarray, s: Settings) -> float:
    """The share of the item found in order in the region, 0 if a check fails."""
    if np.isin(item, region).mean() < s.overlap:
        return 0.0
    places = common_subsequence(item, region)
    if len(places) == len(item):
        return 1.0
    share = len(places) / len(item)
    heavy = weight[places].sum() / max(weight.sum(), 1e-12)
    tail = item[-max(1, int(len(item) * s.answer_part)) :]
    if share < s.overlap or heavy < s.overlap or np.isin(tail, region).mean() < s.answer:
        return 0.0
    return share


def matches(docs: DataFrame, bench: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(_id, _content, item_id, overlap): the confirmed items of each document, the best first in its list."""
    s = settings
    text = text_of(docs)
    texts = docs.select(*content_key(docs, text), F.lower(text).alias("_text"))
    listed = materialize(
        bench.select(bench["item_id"].cast("long").alias("item_id"), F.lower(text_of(bench)).alias("text"))
        .select("item_id", "text", F.pmod(F.xxhash64("text", "item_id"), F.lit(s.shards)).cast("int").alias("shard")),
        "items",
    )
    whole = texts.select("_text").unionAll(listed.select(F.col("text").alias("_text")))
    counts, distinct = frequencies(whole.select("_text", F.xxhash64("_text")), s)
    weights = np.maximum(np.log((distinct + 1) / (counts + 1)), s.floor)
    space = latent_space(listed, weights, s) if counts.any() else np.zeros((1 << s.bits, s.rank))
    table = (weights[:, None] * space).astype(np.float32)
    blocks = max(1, -(-listed.count() // s.items_per_block))
    dealt = listed.withColumn("block", F.pmod(F.xxhash64("item_id", "text", F.lit(8)), F.lit(blocks)))
    found = None
    for block in range(blocks):
        rows = [(r["item_id"], r["text"]) for r in dealt.where(F.col("block") == block).collect()]
        part = _search(texts, _items(rows, table, weights, s), table, weights, s)
        found = part if found is None else found.unionByName(part)
    return found


def _search(texts: DataFrame, items: Items, table: np.ndarray, weights: np.ndarray, s: Settings) -> DataFrame:
    sent = texts.sparkSession.sparkContext.broadcast((items, table, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, table, weights = sent.value
        lengths = np.array([len(w) for w in items.words], dtype=np.int64)
        held = items.words[: len(items.vectors)]
        vocabulary = np.unique(np.concatenate([np.zeros(1, np.uint64), *held]))
        covered = Coverage(held, vocabulary, s)
        lowest = replace(s, cosine=float(items.cosines.min(initial=np.inf)))
        for batch in batches:
            out: dict[tuple[int, int], float] = {}
            for first, _, data, offsets in tx.chunks(batch.column(2)):
                _, _, hashes, firsts = tx.words(data, offsets)
                if not len(hashes) or not len(items.ids):
                    continue
                of_word = tx.row_of(firsts, len(hashes))
                for grams in items.grams:
                    for shared in grams.shared(hashes, of_word):
                        for r, k, low, high in aligned(*shared, lengths):
                            if out.get((first + r, k), 0.0) == 1.0:
                                continue
                            item = items.words[k]
                            if k >= len(items.vectors):
                                out[first + r, k] = 1.0
                                continue
                            a, b = max(low - len(item) // 2, firsts[r]), min(high + len(item) * 3 // 2, firsts[r + 1])
                            share = confirm(item, hashes[a:b], weights[_columns(item, s)], s)
                            if share > out.get((first + r, k), 0.0):
                                out[first + r, k] = share
                if lowest.cosine == np.inf:
                    continue
                vectors, row, begin, end = passages(_columns(hashes, s), firsts, table, weights, lowest)
                spot = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
                spot[vocabulary[spot] != hashes] = len(vocabulary)
                for low in range(0, len(vectors), 4096):
                    near = vectors[low : low + 4096] @ items.vectors.T >= items.cosines
                    passage, picked = np.nonzero(near)
                    for p, k in covered(passage + low, picked, begin, end, row, firsts, spot):
                        r = int(row[p])
                        if (first + r, k) in out:
                            continue
                        item = items.words[k]
                        a, b = max(begin[p] - len(item), firsts[r]), min(end[p] + len(item), firsts[r + 1])
                        share = confirm(item, hashes[a:b], weights[_columns(item, s)], s)
                        if share:
                            out[first + r, k] = share
            where = pa.array([r for r, _ in out], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(where), batch.column(1).take(where),
                    pa.array([items.ids[k] for _, k in out], pa.int64()), pa.array(list(out.values()), pa.float64()),
                ],
                names=["_id", "_content", "item_id", "overlap"],
            )

    return texts.mapInArrow(run, "_id long, _content long, item_id long, overlap double")


MADE = ("leaked", "leaked_item", "leaked_overlap", "leaked_items")


def decontaminate(docs: DataFrame, bench: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """All columns of ``docs``, and the item found in each document with its share: null and 0 for clean ones."""
    text = text_of(docs)
    best = F.max(F.struct(F.col("overlap").alias("overlap"), (-F.col("item_id")).alias("item")))
    found = matches(docs, bench, settings).groupBy("_id", "_content").agg(best.alias("_best"), F.count_distinct("item_id").alias("_n"))
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("_row"), *content_key(docs, text))
    joined = rows.join(found, same_key(rows, found), "left")
    return joined.select(
        *[F.col("_row")[c].alias(c) for c in others(docs, MADE)], F.col("_best").isNotNull().alias("leaked"),
        (-F.col("_best.item")).alias("leaked_item"), F.coalesce("_best.overlap", F.lit(0.0)).alias("leaked_overlap"),
        F.coalesce("_n", F.lit(0)).cast("long").alias("leaked_items"),
    )
