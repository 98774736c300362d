"""N-gram Jaccard join: MinHash LSH forest, then exact verification.

Documents with equal sets of word shingles are one node. A signature holds
``trees`` paths of ``depth`` minima each. The forest is a sorted table of paths:
rows that share a prefix of a path are a branch, and prefixes are shortened from
the full depth until a pair at the threshold shares a branch in some tree with
the wanted probability. In a branch, nodes whose whole signatures agree well
enough (``slack`` standard errors below the threshold) are linked, as a spanning
forest found by breadth-first search, which passes each node once and never
lists all pairs. A branch of more than ``branch`` nodes is split; all components
of its parts are linked to a node that stands for the branch, which can only add
candidates.

The linked nodes form candidate groups. All pairs within a group are verified on
the exact shingle sets, in blocks of bounded size; a block hands on the number
of links of each node and a spanning forest of the verified links, so copies and
near copies are never expanded into rows of pairs. Components of the verified
links are the classes.

Words are runs of ASCII letters, digits and non-ASCII characters of the
lower-cased text; a text of fewer words than a shingle has one shingle of all.

Cases: null and empty texts and texts without words are classes of their own
with no links; repeated rows are copies; a class is named by the smallest id in
it (null only if it has no other); other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm import text as tx
from larder.llm.columns import content_key, same_key, text_of
from larder.llm.components import connected_components
from larder.sources.scratch import materialize


@dataclass(frozen=True)
class Settings:
    shingle: int = 5
    threshold: Fraction = Fraction(4, 5)
    trees: int = 16
    depth: int = 6
    recall: float = 0.999
    slack: float = 4.5
    branch: int = 20000
    block: int = 1000

    @property
    def minima(self) -> int:
        return self.trees * self.depth

    def prefix(self) -> int:
        """Full paths first, one minimum less each time, until the recall is reached."""
        length = self.depth
        while length > 1 and 1 - (1 - float(self.threshold) ** length) ** self.trees < self.recall:
            length -= 1
        return length

    def agreement(self) -> int:
        """How many minima a candidate pair has in common at least."""
        t = float(self.threshold)
        return int(self.minima * (t - self.slack * np.sqrt(t * (1 - t) / self.minima)))


STEP = 2048
# sides of so many rows of about a hundred bytes are broadcast; larger ones are shuffled
BROADCAST_ROWS = 200_000
# the part of a branch that is not split
WHOLE = -1
# rows of a scratch table that one task writes
TABLE_ROWS = 20_000
_factors = tx.mix(np.arange(10_001, 10_513, dtype=np.uint64)) | np.uint64(1)


def signatures(values: np.ndarray, firsts: np.ndarray, minima: int) -> np.ndarray:
    """rows x minima: the smallest value of each row's shingles under each hash function, as 32 bits."""
    out = np.zeros((len(firsts) - 1, minima), dtype=np.uint32)
    filled = np.flatnonzero(np.diff(firsts) > 0)
    if len(filled):
        for k in range(minima):
            out[filled, k] = np.minimum.reduceat(values * _factors[k], firsts[:-1][filled]) >> np.uint64(32)
    return out


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct shingles, first of each row), sorted within rows."""
    _, _, hashes, firsts = tx.words(data, offsets)
    values, rows = tx.shingles(hashes, firsts, size)
    order = np.lexsort((values, rows))
    values, rows = values[order], rows[order]
    keep = np.ones(len(values), dtype=bool)
    keep[1:] = (values[1:] != values[:-1]) | (rows[1:] != rows[:-1])
    values, rows = values[keep], rows[keep]
    return values, np.searchsorted(rows, np.arange(len(offsets)))


def signed(docs: DataFrame, s: Settings) -> DataFrame:
    """(_id, _content, set, n, paths, brief): the name and size of each document's shingle set, and its signature.

    ``paths`` holds the minima as 4 bytes each, ``brief`` their lowest byte.
    """
    text = text_of(docs)
    texts = docs.select(*content_key(docs, text), F.lower(text).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in tx.chunks(batch.column(2)):
                values, firsts = shingle_sets(data, offsets, s.shingle)
                counts = np.diff(firsts)
                names = np.zeros((len(counts), 2), dtype=np.uint64)
                for k, salt in enumerate((11, 12)):
                    sums = np.concatenate([[np.uint64(0)], np.cumsum(tx.mix(values + np.uint64(salt)), dtype=np.uint64)])
                    names[:, k] = tx.mix(sums[firsts[1:]] - sums[firsts[:-1]] + counts.astype(np.uint64))
                paths = signatures(values, firsts, s.minima)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[first:last], batch.column(1)[first:last],
                        pa.array([x.tobytes() for x in names], pa.binary()), pa.array(counts, pa.int32()),
                        pa.array([x.tobytes() for x in paths.astype(">u4")], pa.binary()),
                        pa.array([x.tobytes() for x in paths.astype(np.uint8)], pa.binary()),
                    ],
                    names=["_id", "_content", "set", "n", "paths", "brief"],
                )

    return texts.mapInArrow(run, "_id long, _content long, set binary, n int, paths binary, brief binary")


def _grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of whole groups from batches sorted by the keys."""
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        waiting.append(batch)
        table = pa.Table.from_batches(waiting)
        cut = len(table)
        last = [table.column(k)[cut - 1] for k in keys]
        if all(table.column(k)[0] == x for k, x in zip(keys, last, strict=True)):
            continue
        low, high = 0, cut - 1  # the first row of the last group lies in (low, high]
        while high - low > 1:
            middle = (low + high) // 2
            if all(table.column(k)[middle] == x for k, x in zip(keys, last, strict=True)):
                high = middle
            else:
                low = middle
        yield table.slice(0, high)
        waiting = table.slice(high).combine_chunks().to_batches()
    if waiting and sum(map(len, waiting)):
        yield pa.Table.from_batches(waiting)


def _group_bounds(table: pa.Table, keys: list[str]) -> np.ndarray:
    new = np.zeros(len(table), dtype=bool)
    new[0] = True
    for key in keys:
        values = table.column(key).combine_chunks()
        codes = np.asarray(values.dictionary_encode().indices)
        new[1:] |= codes[1:] != codes[:-1]
    return np.append(np.flatnonzero(new), len(table))


def search(brief: np.ndarray, agreement: int) -> list[tuple[int, int]]:
    """A spanning forest of the rows that agree in enough minima; each row leaves the open ones once."""
    links = []
    rest = np.arange(len(brief))
    while len(rest):
        front, rest = [int(rest[0])], rest[1:]
        while front and len(rest):
            at = front.pop()
            near = (brief[rest] == brief[at]).sum(axis=1) >= agreement
            found = rest[near].tolist()
            links += [(at, x) for x in found]
            front += found
            rest = rest[~near]
    return links


def candidates(sets: DataFrame, s: Settings, files: int) -> DataFrame:
    """(u, v): links between sets that a branch brings together and whose signatures agree."""
    width, prefix = s.depth * 4, s.prefix() * 4
    branches = F.transform(
        F.sequence(F.lit(0), F.lit(s.trees - 1)),
        lambda t: F.struct(t.cast("short").alias("tree"), F.substring(F.col("paths"), t * width + 1, F.lit(prefix)).alias("branch")),
    )
    rows = sets.select("set", "brief", F.inline(branches))
    large = materialize(rows.groupBy("tree", "branch").agg(F.count("*").alias("_n")).where(F.col("_n") > s.branch), "large", files)
    known = large.count()
    if known:
        parts = F.pmod(F.xxhash64("set"), F.ceil(F.col("_n") / s.branch)).cast("int")
        rows = rows.join(F.broadcast(large) if known <= BROADCAST_ROWS else large, ["tree", "branch"], "left").withColumn("part", F.coalesce(parts, F.lit(WHOLE)))
    else:
        rows = rows.withColumn("part", F.lit(WHOLE))
    keys = ["tree", "branch", "part"]
    agreement = s.agreement()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _grouped(batches, keys):
            bounds = _group_bounds(table, keys)
            sets_, briefs = table.column("set").combine_chunks(), table.column("brief").to_pylist()
            parts, trees, names = (table.column(k).to_pylist() for k in ("part", "tree", "branch"))
            u, v, whole, centres = [], [], [], []
            for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                heads = set(range(low, high))
                if high - low > 1:
                    brief = np.frombuffer(b"".join(briefs[low:high]), dtype=np.uint8).reshape(high - low, -1)
                    for a, b in search(brief, agreement):
                        u.append(low + a)
                        v.append(low + b)
                        heads.discard(low + b)
                if parts[low] != WHOLE:
                    whole += heads
                    centres += [hashlib.md5(b"%d:" % trees[low] + names[low]).digest()] * len(heads)
            left, right = sets_.take(pa.array(u, pa.int64())), sets_.take(pa.array(v, pa.int64()))
            if whole:
                left = pa.concat_arrays([left, sets_.take(pa.array(whole))])
                right = pa.concat_arrays([right, pa.array(centres, pa.binary())])
            yield pa.RecordBatch.from_arrays([left, right], names=["u", "v"])

    placed = rows.select(*keys, "set", "brief").repartition(*keys).sortWithinPartitions(*keys)
    return placed.mapInArrow(run, "u binary, v binary")


def common(own: list[np.ndarray], other: list[np.ndarray]) -> Iterator[np.ndarray]:
    """For each set, how many elements it shares with each of the others."""
    flat = np.concatenate(other)
    order = np.argsort(flat, kind="stable")
    member = np.repeat(np.arange(len(other)), [len(x) for x in other])[order]
    flat = flat[order]
    for values in own:
        total = np.zeros(len(other), dtype=np.int64)
        for part in np.split(values, range(STEP, len(values), STEP)):  # bounds what a set of many common shingles gathers
            low, high = np.searchsorted(flat, part, "left"), np.searchsorted(flat, part, "right")
            length = high - low
            at = np.repeat(low - np.cumsum(length) + length, length) + np.arange(int(length.sum()))
            total += np.bincount(member[at], minlength=len(other))
        yield total


def verified(texts: DataFrame, groups: DataFrame, s: Settings) -> DataFrame:
    """(u, v, links): links counted for u, or where v is given, an edge of the spanning forest of links.

    ``groups`` has (root, set, copies, _id, _content): the nodes of the candidate
    groups and one document of each.
    """
    sizes = groups.groupBy("root").agg(F.count("*").alias("size"))
    placed = groups.join(sizes, "root").withColumn("blocks", F.ceil(F.col("size") / s.block).cast("int"))
    placed = placed.withColumn("own", F.pmod(F.xxhash64("set", F.lit(4)), F.col("blocks")).cast("int"))
    if groups.count() <= BROADCAST_ROWS:
        placed = F.broadcast(placed)
    wide = texts.join(placed, same_key(texts, placed)).select("root", "set", "copies", "blocks", "own", F.lower("_text").alias("_text"))

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in tx.chunks(batch.column(5)):
                values, firsts = shingle_sets(data, offsets, s.shingle)
                packed = [values[a:b].tobytes() for a, b in zip(firsts[:-1], firsts[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(k)[first:last] for k in range(5)), pa.array(packed, pa.binary())],
                    names=["root", "set", "copies", "blocks", "own", "shingles"],
                )

    with_sets = wide.mapInArrow(sets_of, "root binary, set binary, copies long, blocks int, own int, shingles binary")
    spread = with_sets.dropDuplicates(["set"]).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "root", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "set", "copies", "shingles"
    )
    keys = ["root", "low", "high"]
    p, q = s.threshold.numerator, s.threshold.denominator

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _grouped(batches, keys):
            bounds = _group_bounds(table, keys)
            own, low_block = (np.asarray(table.column(k).combine_chunks()) for k in ("own", "low"))
            high_block = np.asarray(table.column("high").combine_chunks())
            copies = np.asarray(table.column("copies").combine_chunks())
            packed, names = table.column("shingles").to_pylist(), table.column("set").combine_chunks()
            at, to, links = [], [], []
            for begin, end in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                rows = np.arange(begin, end)
                same = low_block[begin] == high_block[begin]
                left = rows if same else rows[own[begin:end] == low_block[begin]]
                right = rows if same else rows[own[begin:end] == high_block[begin]]
                if not len(left) or not len(right) or (same and len(rows) < 2):
                    continue
                sets_ = {r: np.frombuffer(packed[r], dtype=np.uint64) for r in rows.tolist()}
                sizes_ = {r: len(x) for r, x in sets_.items()}
                right_sizes = np.array([sizes_[r] for r in right.tolist()])
                count = dict.fromkeys(rows.tolist(), 0)
                parent = {r: r for r in rows.tolist()}

                def root(r: int, parent: dict[int, int] = parent) -> int:
                    while parent[r] != r:
                        parent[r] = parent[parent[r]]
                        r = parent[r]
                    return r

                for r, shared in zip(left.tolist(), common([sets_[r] for r in left.tolist()], [sets_[r] for r in right.tolist()]), strict=True):
                    near = right[(p + q) * shared >= p * (sizes_[r] + right_sizes)]
                    near = near[near != r]
                    count[r] += int(copies[near].sum())
                    for x in near.tolist():
                        if not same:
                            count[x] += int(copies[r])
                        a, b = root(r), root(x)
                        if a != b:
                            parent[a] = b
                            at.append(r)
                            to.append(x)
                            links.append(0)
                for r, n in count.items():
                    if n:
                        at.append(r)
                        to.append(None)
                        links.append(n)
            yield pa.RecordBatch.from_arrays(
                [names.take(pa.array(at, pa.int64())), names.take(pa.array(to, pa.int64())), pa.array(links, pa.int64())],
                names=["u", "v", "links"],
            )

    arranged = spread.repartition(*keys).sortWithinPartitions(*keys)
    return arranged.mapInArrow(run, "u binary, v binary, links long")


def classes(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(_id, _content, class_id, keeper, n_links) of every row of ``docs``.

    ``keeper`` is the key of the document with the smallest id of the class, null for a text without words.
    """
    s = settings
    text = text_of(docs)
    texts = docs.select(*content_key(docs, text), text.alias("_text"))
    rows = materialize(signed(docs, s), "signatures")
    # null ids last
    key = F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), F.col("_content").alias("content"))
    files = 8 + rows.count() // TABLE_ROWS
    sets = materialize(
        rows.where("n > 0").groupBy("set").agg(
            F.count("*").alias("copies"), F.min(key).alias("least"), F.any_value("paths").alias("paths"), F.any_value("brief").alias("brief")
        ),
        "sets",
        files,
    )
    groups = connected_components(candidates(sets, s, files), files)
    nodes = groups.join(sets, groups["node"] == sets["set"]).select(
        "root", "set", "copies", F.col("least.id").alias("_id"), F.col("least.content").alias("_content")
    )
    found = materialize(verified(texts, materialize(nodes, "nodes", files), s), "links", 4 * files)
    links = found.where("v is null").groupBy("u").agg(F.sum("links").alias("links"))
    joined = connected_components(found.where("v is not null").select("u", "v"), files)
    known = sets.select("set", "copies", "least").join(joined.withColumnRenamed("node", "set"), "set", "left")
    known = known.withColumn("root", F.coalesce("root", "set"))
    heads = known.groupBy("root").agg(F.min("least").alias("keeper"))
    told = known.join(heads, "root").join(links.withColumnRenamed("u", "set"), "set", "left").select(
        "set", "keeper", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")
    )
    return rows.select("_id", "_content", F.when(F.col("n") > 0, F.col("set")).alias("set")).join(told, "set", "left").select(
        "_id", "_content", F.when(F.col("keeper").isNull(), F.col("_id")).otherwise(F.col("keeper.id")).alias("class_id"),
        "keeper", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )


def jaccard_join(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, class_id and n_links of every row."""
    return classes(docs, settings).select(F.col("_id").alias("doc_id"), "class_id", "n_links")


def one_per_class(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of ``docs`` that stay when every class keeps one: the smallest id, and of rows equal to it any one."""
    text = text_of(docs)
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("_row"), *content_key(docs, text))
    kept = (
        classes(docs, settings).where(F.col("keeper").isNull() | (F.col("keeper.id").eqNullSafe(F.col("_id")) & (F.col("keeper.content") == F.col("_content"))))
        .groupBy("_id", "_content").agg(F.count("*").alias("_n"), F.first("keeper").isNull().alias("_free"))
    )
    kept = materialize(kept, "kept")
    joined = rows.join(kept, same_key(rows, kept))
    plain = joined.where("_n = 1 or _free").select("_row")
    again = joined.where("_n > 1 and not _free").groupBy(rows["_id"], rows["_content"]).agg(F.any_value("_row").alias("_row")).select("_row")
    return plain.unionByName(again).select(*[F.col("_row")[c].alias(c) for c in docs.columns])


SQL = """
WITH RECURSIVE parts AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9\\x{80}-\\x{10FFFF}]+') AS w FROM documents),
shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' '))) AS s
  FROM parts WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS MATERIALIZED (
  SELECT a, b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL)
  JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 9 * c >= 4 * (p.n + q.n)),
reach AS (
  SELECT a AS doc_id, a AS other FROM (SELECT DISTINCT a FROM pairs)
  UNION SELECT r.doc_id, b FROM reach r JOIN pairs ON a = r.other)
SELECT d.doc_id, coalesce(c.class_id, d.doc_id) AS class_id, CAST(coalesce(l.n, 0) AS BIGINT) AS n_links
FROM documents d LEFT JOIN (SELECT doc_id, min(other) AS class_id FROM reach GROUP BY doc_id) c USING (doc_id)
LEFT JOIN (SELECT a AS doc_id, count(*) AS n FROM pairs GROUP BY a) l USING (doc_id)
"""
