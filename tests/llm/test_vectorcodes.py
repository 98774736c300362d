"""Vector codes against comparing every part with every entry."""

import hashlib
import math
from collections import defaultdict

import duckdb
import numpy as np
import pytest

from larder.llm import vectorcodes as vc

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<float>, label int, code string, error int"


def plain(rows, s):
    kept = [(i, v, label) for i, v, label in rows if v and not any(x is None or not math.isfinite(x) for x in v)]
    kept = [(i, [math.floor(s.scale * float(np.float32(x))) for x in v], label) for i, v, label in kept]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept or len(kept[0][1]) % s.parts:
        return []
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    width = len(kept[0][1]) // s.parts
    cut = lambda v, p: v[p * width : (p + 1) * width]
    books = [[cut(v, p) for _, v, _ in kept[: s.entries]] for p in range(s.parts)]
    nearest = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(book))
    for _ in range(s.rounds):
        for p, book in enumerate(books):
            balls = defaultdict(list)
            for _, v, _ in kept:
                balls[nearest(cut(v, p), book)[1]].append(cut(v, p))
            books[p] = [[sum(c) // len(c) for c in zip(*balls[k], strict=True)] if k in balls else e for k, e in enumerate(book)]
    digest = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    coded, by_label = [], defaultdict(int)
    for i, v, label in kept:
        near = [nearest(cut(v, p), books[p]) for p in range(s.parts)]
        error = sum(d for d, _ in near)
        by_label[label] += error
        coded.append((i, "".join(f"{k:02x}" for _, k in near), error, label))
    return sorted(((i, c, e, by_label[label], digest) for i, c, e, label in coded), key=str)


def found(df, s):
    return sorted((tuple(r) for r in vc.encode(df, s).collect()), key=str)


def test_given_vectors_equal_the_sql(llm):
    c = duckdb.connect()
    c.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SF}/embeddings.parquet')")
    got = [tuple(r) for r in vc.encode(llm.read.parquet(f"{SF}/embeddings.parquet")).collect()]
    assert sorted(got) == sorted(c.execute(vc.sql()).fetchall()) and len(got) == 500


@pytest.mark.parametrize("seed", [0, 1])
def test_unusable_rows_ties_repeats_and_hot_label(llm, seed):
    rng = np.random.default_rng(seed)
    s = vc.Settings(parts=2, entries=5, rounds=4, scale=4)
    rows = [(i, rng.integers(-3, 4, 6).astype(float).tolist(), int(i % 2)) for i in range(80)]
    rows += [(7, rows[7][1], 1), (7, [9.0] * 6, None), (None, [1.0] * 6, None), (90, None, 1), (91, [], 1), (92, [1.0] * 5, 1)]
    rows += [(93, [1.0, None, 1.0, 1.0, 1.0, 1.0], 0), (94, [float("nan")] * 6, 0), (95, [float("inf")] * 6, 0), (96, [-2.5] * 6, None)]
    rows += [(1000 + i, [1.0, 2.0, 3.0, 4.0, 5.0, 6.0], 3) for i in range(100)]
    df = llm.createDataFrame([(i, v, label, "x", 1) for i, v, label in rows], SCHEMA).repartition(5)
    assert found(df, s) == plain(rows, s)


def test_few_rows_and_odd_widths(llm):
    make = lambda rows: llm.createDataFrame([(i, v, label, None, None) for i, v, label in rows], SCHEMA)
    few = [(3, [0.5] * 8, None), (1, [0.25] * 8, None), (2, [1e30] * 8, 1)]
    assert found(make(few), vc.Settings()) == plain(few[:2], vc.Settings())
    assert found(make([]), vc.Settings()) == []
    assert found(make([(1, [1.0] * 7, 1)]), vc.Settings()) == []


def test_a_ball_skips_what_its_bounds_allow():
    rng = np.random.default_rng(5)
    for _ in range(20):
        parts, entries = rng.integers(-40, 40, (300, 3)), rng.integers(-40, 40, (9, 3))
        gap = parts[:, None] - entries[None]
        far = (gap * gap).sum(axis=2)
        guess = rng.integers(0, 9, 300)
        reach = np.array([math.isqrt(int(far[guess == i, i].max(initial=0))) + 1 for i in range(9)], dtype=object)
        book = vc.Codebook(entries, np.ones(9, bool), reach)
        code, error = vc.assign(parts, guess, np.zeros(300, np.int64), book)
        assert (code == far.argmin(axis=1)).all() and (error == far.min(axis=1)).all()
    near = vc.Codebook(np.array([[0], [10], [100]]), np.array([False, True, False]), np.array([3, 3, 3], dtype=object)).neighbours()
    assert [x.tolist() for x in near] == [[], [], []]
    still = vc.Codebook(np.array([[0], [10]]), np.zeros(2, bool), np.array([20, 20], dtype=object))
    code, error = vc.assign(np.array([[9]]), np.array([0]), np.array([81]), still)
    assert code.tolist() == [0] and error.tolist() == [81]


def test_a_round_takes_as_many_jobs_for_any_number_of_partitions(llm):
    rng = np.random.default_rng(3)
    df = llm.createDataFrame([(i, rng.normal(size=8).tolist(), 0, "x", 1) for i in range(60)], SCHEMA).repartition(3).localCheckpoint()
    names = ["spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled"]
    before = {name: llm.conf.get(name) for name in names}
    context, jobs = llm.sparkContext, []
    try:
        llm.conf.set(names[1], "false")
        for partitions in (4, 48):
            llm.conf.set(names[0], str(partitions))
            group = f"vector codes, {partitions}"
            context.setJobGroup(group, group)
            vc.train(df, vc.Settings(parts=2, entries=4, rounds=3))
            context._jsc.sc().listenerBus().waitUntilEmpty(30_000)
            jobs.append(len(context.statusTracker().getJobIdsForGroup(group)))
    finally:
        for name in ("spark.jobGroup.id", "spark.job.description"):
            context.setLocalProperty(name, None)
        for name, value in before.items():
            llm.conf.set(name, value)
    assert jobs[0] == jobs[1] > 0
