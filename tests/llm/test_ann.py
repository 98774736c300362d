"""Nearest neighbours against brute force."""

import math

import numpy as np

from larder.llm import ann

SF = "/root/testdata/sf0.01"


def brute(rows, k=5, every=50):
    kept = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            continue
        kept[i] = min(kept.get(i, list(v)), list(v))
    out = {}
    for q in (i for i in kept if i % every == 0):
        a = np.array(kept[q], dtype=float)
        scores = [
            (-(a @ b) / math.sqrt((a @ a) * (b @ b)), i) for i, b in ((i, np.array(v, dtype=float)) for i, v in kept.items())
            if i != q and len(b) == len(a)
        ]
        out[q] = [(i, -s) for s, i in sorted(scores)[:k]]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_recall_on_the_table(llm):
    df = llm.read.parquet(f"{SF}/embeddings.parquet")
    want = brute([(r["vec_id"], r["embedding"]) for r in df.collect()])
    got = found(ann.nearest(df, ann.Settings(rows_per_block=100, queries_per_block=4)))
    assert want.keys() == got.keys()
    hits = sum(len({i for i, _ in want[q]} & {i for i, _ in got[q]}) for q in want)
    assert hits >= 0.98 * sum(map(len, want.values()))
    exact = {(q, i): s for q, listed in want.items() for i, s in listed}
    for q, listed in got.items():
        assert all(abs(s - exact[q, i]) < 1e-12 for i, s in listed if (q, i) in exact)


def test_unusable_rows_ties_and_repeats(llm):
    rows = [
        (0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [3.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]),
        (6, [float("inf"), 1.0]), (7, [None, 1.0]), (None, [1.0, 0.0]), (8, [0.0, 1.0]), (9, [-1.0, 0.0]), (50, [1.0, 2.0, 3.0]), (51, []),
    ]
    df = llm.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, code string")
    got = found(ann.nearest(df))
    assert [i for i, _ in got[0]] == [1, 2, 8, 9]
    assert 50 not in got
    assert found(ann.nearest(df.limit(0))) == {}


def test_estimates_keep_their_bounds():
    rng = np.random.default_rng(3)
    v, q = rng.standard_normal((500, 32)), rng.standard_normal((20, 32))
    turn = ann.rotation(32, 256, 1)
    codes, scalars = ann.encode(v, turn)
    assert codes.shape == (500, 32)
    unit = q / np.linalg.norm(q, axis=1, keepdims=True)
    guess, error = ann.estimate(codes, scalars, unit @ turn, 3.0)
    exact = unit @ (v / np.linalg.norm(v, axis=1, keepdims=True)).T
    assert (np.abs(guess - exact) <= error).mean() > 0.99


def test_equal_vectors_tie_wherever_they_lie(llm):
    """One vector under 120 ids over blocks of uneven size: the smallest ids win."""
    rng = np.random.default_rng(8)
    one, other = rng.standard_normal(48).astype(np.float32).tolist(), rng.standard_normal(48).astype(np.float32).tolist()
    rows = [(i, one) for i in range(1, 121)] + [(i, rng.standard_normal(48).tolist()) for i in range(1001, 1400)] + [(0, other), (2000, one)]
    df = llm.createDataFrame(rows, "vec_id long, embedding array<float>")
    for size in (7, 33, 4096):
        got = found(ann.nearest(df, ann.Settings(rows_per_block=size, queries_per_block=1)))
        # the query's own row, 50, does not count
        assert [i for i, _ in got[50]] == [1, 2, 3, 4, 5] and [i for i, _ in got[2000]] == [1, 2, 3, 4, 5]
        assert len({score for _, score in got[2000]}) == 1
        want = brute(rows, k=400)[0]
        tied = [i for i, _ in got[0]]
        assert tied == sorted(tied, key=lambda i: (-round(dict(want)[i], 12), i))


def test_components_of_any_size():
    q = np.array([1e200, 2e200, 0.0])
    v = np.array([[1e200, 2e200, 0.0], [1e-200, 2e-200, 0.0], [0.0, 0.0, 5e-324], [-1e308, 1.0, 0.0]])
    assert np.allclose(ann.cosines(q, v), [1, 1, 0, -1 / math.sqrt(5)])
    codes, scalars = ann.encode(v, ann.rotation(3, 24, 1))
    assert np.isfinite(scalars).all() and codes.shape == (4, 3)
