"""Vector codes by ball k-means: a codebook per part of the vectors, in whole-number arithmetic.

Vectors become whole numbers, floor(scale * x), and are cut into equal parts. A
part position has its own codebook; the parts assigned to an entry form its ball.

* The radius of a ball, its farthest part, bounds which entries can be nearest
  to any of its parts: entry j is a neighbour of entry i only if it lies within
  twice the radius of i. Radii are kept from round to round and widened by how
  far the entry has moved.
* A ball whose entry and neighbours have not moved is left as it is.
* A part within half the distance to the nearest neighbour lies in the stable
  core of its ball and stays, with no distance but that to its own entry.
* The other parts lie in rings around the entry: a part at distance d meets only
  neighbours within 2d, and of these the nearest one wins, ties to the lower index.

All comparisons are of squared distances in whole numbers, so the codes equal
those of comparing every part with every entry.

A round is one pass over the stored vectors. It writes each row with its codes
and distances, and per batch the sums, counts and radii of the balls; these are
added up by Spark, and only the codebooks (parts x entries x width numbers, which
do not grow with the rows) reach the driver. The table of the round before is
deleted once the next is written.

Cases: null vectors and those with null or non-finite components are dropped, as
are those without components. The width is that of the smallest id's vector; others,
and all where it is not divisible by the number of parts, are dropped. So are those
whose components are so large that the distances of a vector could exceed 64 bits.
Rows with the same id are rows of their own, a null id comes after all others, and
ties go to the smaller vector. Fewer rows than entries make a smaller codebook. An
empty table gives no rows. Null labels count as equal to each other.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.sources.scratch import fresh_path


@dataclass(frozen=True)
class Settings:
    parts: int = 8
    entries: int = 16
    rounds: int = 6
    scale: int = 4096


@dataclass(frozen=True)
class Codebook:
    """Entries of one part position, and what the next round may skip."""

    entries: np.ndarray  # entries x width
    moved: np.ndarray  # whether an entry differs from the round before
    reach: np.ndarray  # upper bound of each ball's radius around its present entry, rounded up

    def apart(self) -> np.ndarray:
        """Squared distances between the entries."""
        gap = self.entries[:, None, :] - self.entries[None, :, :]
        return (gap * gap).sum(axis=2)

    def neighbours(self) -> list[np.ndarray]:
        """The entries within twice the reach of each, nearest first."""
        found = []
        for i, row in enumerate(self.apart()):
            near = [j for j in range(len(row)) if j != i and math.isqrt(int(row[j])) <= 2 * int(self.reach[i])]
            found.append(np.array(sorted(near, key=lambda j: (row[j], j)), dtype=np.int64))
        return found


def assign(parts: np.ndarray, code: np.ndarray, error: np.ndarray, book: Codebook) -> tuple[np.ndarray, np.ndarray]:
    """(nearest entry, squared distance) of each part, starting from the assignment of the round before."""
    code, error = code.copy(), error.copy()
    old, apart, near = code.copy(), book.apart(), book.neighbours()
    for i in range(len(book.entries)):
        ball = np.flatnonzero(old == i)
        others = near[i]
        if not len(ball) or not (book.moved[i] or book.moved[others].any()):
            continue
        own = parts[ball] - book.entries[i]
        best = (own * own).sum(axis=1)
        error[ball] = best
        if not len(others):
            continue
        # ring of a part: how many neighbours lie within twice its distance; 0 is the core
        ring = np.searchsorted(apart[i][others], 4 * best, side="right")
        winner = np.full(len(ball), i)
        for k, j in enumerate(others):
            outer = np.flatnonzero(ring > k)
            if not len(outer):
                break
            gap = parts[ball[outer]] - book.entries[j]
            far = (gap * gap).sum(axis=1)
            closer = (far < best[outer]) | ((far == best[outer]) & (j < winner[outer]))
            best[outer[closer]], winner[outer[closer]] = far[closer], j
        code[ball], error[ball] = winner, best
    return code, error


def _columns(batch: pa.RecordBatch, width: int, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = len(batch)
    vector = np.asarray(batch.column("q").flatten()).reshape(n, parts, width // parts)
    code = np.asarray(batch.column("code").flatten()).astype(np.int64).reshape(n, parts)
    return vector, code, np.asarray(batch.column("error").flatten()).reshape(n, parts)


ROW = "vec_id long, label string, q array<long>, code array<short>, error array<long>"
# kind 0 is a row; kind 1 holds the count, radius and sums of one ball of a batch
STORED = f"{ROW}, part int, entry int, n long, radius long, sums array<long>, kind int"


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    ends = pa.array(np.arange(len(values) + 1) * values.shape[1], pa.int32())
    return pa.ListArray.from_arrays(ends, pa.array(values.ravel(), kind))


def _balls(vector: np.ndarray, code: np.ndarray, error: np.ndarray, s: Settings) -> list[tuple]:
    found = []
    for p in range(s.parts):
        order = np.argsort(code[:, p], kind="stable")
        entry, first = np.unique(code[order, p], return_index=True)
        sums = np.add.reduceat(vector[order, p], first, axis=0)
        radius = np.maximum.reduceat(error[order, p], first)
        counts = np.diff(np.append(first, len(order)))
        found += [(p, int(e), int(c), int(r), x.tolist()) for e, c, r, x in zip(entry, counts, radius, sums, strict=True)]
    return found


def _round(batches: Iterator[pa.RecordBatch], books: list[Codebook], s: Settings) -> Iterator[pa.RecordBatch]:
    width = books[0].entries.shape[1] * s.parts
    for batch in batches:
        n = len(batch)
        if not n:
            continue
        vector, code, error = _columns(batch, width, s.parts)
        code, error = code.copy(), error.copy()
        for p, book in enumerate(books):
            code[:, p], error[:, p] = assign(vector[:, p], code[:, p], error[:, p], book)
        none = lambda kind, m: pa.nulls(m, kind)
        yield pa.RecordBatch.from_arrays([
            batch.column("vec_id"), batch.column("label"), batch.column("q"), _lists(code, pa.int16()), _lists(error, pa.int64()),
            none(pa.int32(), n), none(pa.int32(), n), none(pa.int64(), n), none(pa.int64(), n), none(pa.list_(pa.int64()), n),
            pa.array(np.zeros(n, np.int32)),
        ], names=_NAMES)
        part, entry, count, radius, sums = zip(*_balls(vector, code, error, s), strict=True)
        m = len(part)
        yield pa.RecordBatch.from_arrays([
            none(pa.int64(), m), none(pa.string(), m), none(pa.list_(pa.int64()), m), none(pa.list_(pa.int16()), m), none(pa.list_(pa.int64()), m),
            pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(count, pa.int64()), pa.array(radius, pa.int64()),
            pa.array(sums, pa.list_(pa.int64())), pa.array(np.ones(m, np.int32)),
        ], names=_NAMES)


_NAMES = [name.split()[0] for name in STORED.split(", ")]


class Table:
    """Rows and ball sums of a round, in folders of their own; ``replace`` deletes the round before."""

    def __init__(self, spark: SparkSession, df: DataFrame):
        self.spark, self.path = spark, fresh_path(spark, "balls")
        df.write.partitionBy("kind").parquet(self.path)

    def read(self, kind: int, columns: list[str]) -> DataFrame:
        return self.spark.read.schema(STORED).parquet(self.path).where(F.col("kind") == kind).select(*columns)

    def drop(self) -> None:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def whole_numbers(vectors: DataFrame, s: Settings) -> DataFrame:
    """vec_id, label and the vector in whole numbers, of the vectors that take part."""
    plain = vectors.select(
        vectors["vec_id"].cast("long").alias("vec_id"), vectors["label"].cast("string").alias("label"),
        vectors["embedding"].cast("array<double>").alias("v"),
    )
    # NaN stands above infinity in Spark's order, so one comparison rejects both
    finite = F.forall("v", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    kept = plain.where((F.size("v") > 0) & F.coalesce(finite, F.lit(False)))
    # (2 * bound) ** 2 * width stays below 2 ** 62
    bound = F.floor(F.pow(F.lit(2.0), F.lit(30)) / F.sqrt(F.size("v"))) / s.scale
    small = kept.where(F.forall("v", lambda x: F.abs(x) < bound))
    return small.select("vec_id", "label", F.transform("v", lambda x: F.floor(x * s.scale)).alias("q"))


def _movement(before: np.ndarray, after: np.ndarray, radius: np.ndarray) -> Codebook:
    gap = after - before
    step = (gap * gap).sum(axis=1)
    up = lambda x: math.isqrt(int(x) - 1) + 1 if x > 0 else 0
    reach = np.array([up(r) + up(d) for r, d in zip(radius, step, strict=True)], dtype=object)
    return Codebook(after, step > 0, reach)


def _next(books: list[Codebook], sums: DataFrame) -> list[Codebook]:
    """The codebooks after one more round, from the balls' sums, added up by Spark."""
    added = (
        sums.select("part", "entry", "n", "radius", F.posexplode("sums"))
        .groupBy("part", "entry", "pos")
        .agg(F.sum(F.col("col").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"), F.max("radius").alias("radius"))
    )
    found: list[np.ndarray] = [book.entries.copy() for book in books]
    radius = [np.zeros(len(book.entries), dtype=object) for book in books]
    for row in added.collect():  # at most parts x entries x width rows; an iterator would run a job for each partition
        found[row["part"]][row["entry"], row["pos"]] = int(row["total"]) // row["n"]
        radius[row["part"]][row["entry"]] = row["radius"]
    return [_movement(book.entries, new, r) for book, new, r in zip(books, found, radius, strict=True)]


@dataclass(frozen=True)
class Codes:
    rows: DataFrame  # vec_id, label, code, error per part
    entries: list[np.ndarray]  # of each part


def train(vectors: DataFrame, settings: Settings = Settings()) -> Codes:
    """Codes of all rows, and the codebooks they refer to."""
    s = settings
    spark = vectors.sparkSession
    plain = whole_numbers(vectors, s)
    order = [F.col("vec_id").asc_nulls_last(), "q"]
    smallest = plain.orderBy(*order).limit(1).select(F.size("q")).first()
    width = smallest[0] if smallest else 0
    if not width or width % s.parts:
        none = spark.createDataFrame([], ROW)
        return Codes(none.select("vec_id", "label", "code", "error"), [])
    plain = plain.where(F.size("q") == width)
    first = np.array([row[0] for row in plain.orderBy(*order).limit(s.entries).select("q").collect()], dtype=np.int64)
    start = first.reshape(len(first), s.parts, width // s.parts)
    # before the first round all parts are in ball 0, of unknown reach
    books = [Codebook(start[:, p], np.ones(len(first), bool), np.full(len(first), 1 << 40, dtype=object)) for p in range(s.parts)]
    zeros = lambda kind: F.array_repeat(F.lit(0), s.parts).cast(f"array<{kind}>")
    rows = plain.select("*", zeros("short").alias("code"), zeros("long").alias("error"))
    table = None
    for turn in range(s.rounds + 1):
        work = lambda batches, books=books: _round(batches, books, s)
        written = Table(spark, rows.mapInArrow(work, STORED))
        if table:
            table.drop()
        table = written
        rows = table.read(0, [name.split()[0] for name in ROW.split(", ")])
        if turn < s.rounds:
            books = _next(books, table.read(1, ["part", "entry", "n", "radius", "sums"]))
    return Codes(rows.select("vec_id", "label", "code", "error"), [book.entries for book in books])


def encode(vectors: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """vec_id, code (two hex digits a part), error, label_error and codebooks_sha256 of every row that takes part."""
    codes = train(vectors, settings)
    digest = hashlib.sha256(",".join(str(int(x)) for book in codes.entries for entry in book for x in entry).encode()).hexdigest()
    hexed = F.array_join(F.transform("code", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0")), "")
    total = F.aggregate("error", F.lit(0).cast("long"), lambda a, x: a + x)
    rows = codes.rows.select("vec_id", hexed.alias("code"), total.alias("error"), "label")
    by_label = rows.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "_label")
    joined = rows.join(by_label, rows["label"].eqNullSafe(by_label["_label"]))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def sql(s: Settings = Settings()) -> str:
    """The query as DuckDB SQL: every part meets every entry in each round. Ids are taken to be distinct."""
    steps = []
    for t in range(s.rounds + 1):
        steps.append(f"""near{t} AS (
          SELECT vec_id, label, p, w, min(struct_pack(d := d, e := e)) AS best FROM (
            SELECT x.*, c.e, list_sum(list_transform(range(1, len(x.w) + 1), lambda i: (x.w[i] - c.w[i]) * (x.w[i] - c.w[i]))) AS d
            FROM parts x JOIN book{t} c USING (p)) GROUP BY vec_id, label, p, w)""")
        if t < s.rounds:
            steps.append(f"""mean{t} AS (
              SELECT p, e, list(CAST((total - ((total % n) + n) % n) // n AS BIGINT) ORDER BY i) AS w FROM (
                SELECT p, best.e AS e, i, sum(w[i])::HUGEINT AS total, count(*)::HUGEINT AS n
                FROM near{t}, unnest(range(1, len(w) + 1)) AS u(i) GROUP BY ALL) GROUP BY ALL),
            book{t + 1} AS (
              SELECT b.p, b.e, coalesce(m.w, b.w) AS w FROM book{t} b LEFT JOIN mean{t} m ON m.p = b.p AND m.e = b.e)""")
    last = s.rounds
    return f"""WITH kept AS (
      SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({s.scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    parts AS (
      SELECT vec_id, label, p, v[p * len(v) // {s.parts} + 1:(p + 1) * len(v) // {s.parts}] AS w FROM kept, unnest(range({s.parts})) AS u(p)),
    book0 AS (
      SELECT p, e, w FROM parts JOIN (
        SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept ORDER BY vec_id LIMIT {s.entries}) USING (vec_id)),
    {', '.join(steps)},
    digest AS (
      SELECT sha256(string_agg(CAST(w[i] AS VARCHAR), ',' ORDER BY p, e, i)) AS h FROM book{last}, unnest(range(1, len(w) + 1)) AS u(i)),
    coded AS (
      SELECT vec_id, label, string_agg(printf('%02x', best.e), '' ORDER BY p) AS code, CAST(sum(best.d) AS BIGINT) AS error
      FROM near{last} GROUP BY vec_id, label)
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256
    FROM coded, digest"""
