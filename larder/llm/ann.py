"""Approximate nearest neighbours by randomly rotated one-bit codes.

A vector is scaled to length one, embedded in ``bits`` dimensions by a random
matrix with orthonormal columns, and stored as the signs of the result, packed
to ``bits`` / 8 bytes, with one correction scalar: the inner product of the
rotated vector and its own code. The inner product of a query and a vector is
estimated as <code, query> divided by that scalar; the error of the estimate is
bounded, except with small probability, by ``bound`` standard deviations, which
follow from the same scalar. In a block, a vector is ranked again with its
original components if its upper bound reaches the k-th best lower bound.

All queries meet all rows, block against block: rows and queries are dealt into
blocks of bounded size by a hash of their id, so that many equal vectors spread
evenly, and a task holds one block of each. A block hands on at most k rows for
each query; the k best of these are the result.

Cases: null vectors, zero vectors and vectors with null, NaN or infinite
components take no part, nor do null ids; only vectors of the same dimension
are compared; rows with the same id count as one row with their smallest
vector; ties go to the smaller id; fewer candidates than k are all returned.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.sources.scratch import materialize


@dataclass(frozen=True)
class Settings:
    k: int = 5
    every: int = 50
    expand: int = 8  # bits of a code per dimension of the vector
    bound: float = 3.0
    rows_per_block: int = 4096
    queries_per_block: int = 1024
    seed: int = 20


def rotation(dimension: int, bits: int, seed: int) -> np.ndarray:
    """dimension x bits, its rows orthonormal: the same for everyone who asks with the same numbers."""
    drawn = np.random.default_rng(seed).standard_normal((bits, dimension))
    return np.linalg.qr(drawn)[0].T.copy()


def unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length one; very large and very small components stay in range."""
    level = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return level / np.linalg.norm(level, axis=1, keepdims=True)


def encode(vectors: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(packed signs, <rotated unit vector, its code>); codes have length one."""
    turned = unit(vectors) @ turn
    signs = turned > 0
    return np.packbits(signs, axis=1), np.abs(turned).sum(axis=1) / np.sqrt(turn.shape[1])


def estimate(codes: np.ndarray, scalars: np.ndarray, queries: np.ndarray, bound: float) -> tuple[np.ndarray, np.ndarray]:
    """(estimates, error bounds per vector) of the cosines of rotated unit queries and coded vectors."""
    bits = codes.shape[1] * 8
    signs = np.unpackbits(codes, axis=1).astype(np.float32) * 2 - 1
    raw = queries.astype(np.float32) @ signs.T / np.float32(np.sqrt(bits))
    spread = np.sqrt(np.maximum(1 - scalars**2, 0) / scalars**2 / max(bits - 1, 1))
    return raw / scalars.astype(np.float32), (bound * spread).astype(np.float32)


def cosines(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Cosines in double precision of original vectors.

    Every row is summed by itself, so a pair has one score wherever it is computed,
    and equal vectors tie. Vectors are first scaled by a power of two, which changes
    no digit but keeps squares of very large and very small components in range.
    """
    level = lambda v: np.ldexp(v, -np.frexp(np.abs(v).max(axis=1, keepdims=True))[1])
    v, q = level(np.ascontiguousarray(vectors)), level(query[None, :])
    norms = np.sqrt((v * v).sum(axis=1)) * np.sqrt((q * q).sum(axis=1))
    return (v * q).sum(axis=1) / norms


def search_block(rows: pd.DataFrame, queries: pd.DataFrame, s: Settings) -> pd.DataFrame:
    """At most k rows of the block for each query of the other."""
    found: dict[str, list] = {"query_id": [], "vec_id": [], "score": []}
    if len(rows) and len(queries):
        dimension = len(rows["vec"].iloc[0]) // 8
        vectors = np.frombuffer(b"".join(rows["vec"]), dtype="<f8").reshape(-1, dimension)
        asked = np.frombuffer(b"".join(queries["vec"]), dtype="<f8").reshape(-1, dimension)
        turn = rotation(dimension, dimension * s.expand, s.seed)
        codes = np.frombuffer(b"".join(rows["code"]), dtype=np.uint8).reshape(len(rows), -1)
        scalars = rows["scalar"].to_numpy()
        ids, names = rows["vec_id"].to_numpy(), queries["vec_id"].to_numpy()
        turned = unit(asked) @ turn
        for first in range(0, len(asked), 128):
            part = slice(first, first + 128)
            guess, error = estimate(codes, scalars, turned[part], s.bound)
            own = names[part, None] == ids[None, :]
            guess[own] = -np.inf
            low = guess - error
            need = np.partition(low, -min(s.k, low.shape[1]), axis=1)[:, -min(s.k, low.shape[1])]
            near = (guess + error >= need[:, None]) & ~own
            for i in range(near.shape[0]):
                at = np.flatnonzero(near[i])
                exact = cosines(asked[first + i], vectors[at])
                best = np.lexsort((ids[at], -exact))[: s.k]
                found["query_id"] += [names[first + i]] * len(best)
                found["vec_id"] += ids[at[best]].tolist()
                found["score"] += exact[best].tolist()
    return pd.DataFrame(found).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})


def usable(vector: Column) -> Column:
    """Whether a vector takes part."""
    # NaN stands above infinity in Spark's order, so one comparison rejects both
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def index(vectors: DataFrame, s: Settings) -> DataFrame:
    """(vec_id, vec, code, scalar, dimension) of every vector that takes part, in a table."""
    plain = vectors.select(vectors["vec_id"].cast("long").alias("vec_id"), vectors["embedding"].cast("array<double>").alias("v"))
    one = plain.where(F.col("vec_id").isNotNull() & usable(F.col("v"))).groupBy("vec_id").agg(F.min("v").alias("v"))

    def code(batches):
        for batch in batches:
            for dimension, part in batch.groupby(batch["v"].str.len()):
                v = np.stack(part["v"].to_numpy()).astype("<f8")
                codes, scalars = encode(v, rotation(int(dimension), int(dimension) * s.expand, s.seed))
                yield pd.DataFrame({
                    "vec_id": part["vec_id"].to_numpy(), "vec": [x.tobytes() for x in v],
                    "code": [x.tobytes() for x in codes], "scalar": scalars, "dimension": int(dimension),
                })

    return materialize(one.mapInPandas(code, "vec_id long, vec binary, code binary, scalar double, dimension int"), "codes")


def nearest(vectors: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """query_id, rank, vec_id and score: the k nearest rows found for every row whose id ``every`` divides."""
    s = settings
    coded = index(vectors, s)
    asking = coded.where(F.col("vec_id") % s.every == 0)
    blocks = max(1, -(-coded.count() // s.rows_per_block))
    groups = max(1, -(-asking.count() // s.queries_per_block))
    dealt = lambda n, seed: F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(n)).cast("int")
    rows = coded.select("*", dealt(blocks, 1).alias("block"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"))
    asked = asking.select("vec_id", "vec", "dimension", dealt(groups, 2).alias("group"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    key = ["dimension", "block", "group"]
    found = rows.groupBy(*key).cogroup(asked.groupBy(*key)).applyInPandas(
        lambda a, b: search_block(a, b, s), "query_id long, vec_id long, score double"
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= s.k).select("query_id", "rank", "vec_id", "score")
