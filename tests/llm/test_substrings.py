"""Suffix arrays and substring dedup against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa

from larder.llm import substrings
from larder.llm.suffixes import suffix_array

N = substrings.LENGTH


def test_suffix_arrays():
    draw = random.Random(1)
    for _ in range(3000):
        symbols = [draw.randint(1, draw.choice([1, 2, 3, 6])) for _ in range(draw.randint(0, 24))] + [0]
        assert suffix_array(symbols) == sorted(range(len(symbols)), key=lambda i: symbols[i:])


def brute(texts):
    windows = Counter(t[i : i + N] for t in texts for i in range(len(t) - N + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - N + 1):
            if windows[t[i : i + N]] > 1:
                gone[i : i + N] = b"\1" * N
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def check(llm, texts, ids=None):
    ids = ids or list(range(len(texts)))
    docs = llm.createDataFrame([(i, t, "x") for i, t in zip(ids, texts, strict=True)], "doc_id long, text string, _text string")
    got = [(r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in substrings.substring_dedup(docs).collect()]
    want = [(i, *w) for i, w in zip(ids, brute([(t or "").encode() for t in texts]), strict=True)]
    assert Counter(got) == Counter(want)


def prose(draw, n):
    return " ".join("".join(draw.choice(["an", "er", "th", "é", "ou", "x"]) for _ in range(draw.randint(1, 5))) for _ in range(n))


def samples():
    draw = random.Random(5)
    passage = prose(draw, 150)
    texts = [None, "", "short", "a" * 399, "a" * 400, "ab" * 600, "b" + "a" * 400]
    for k in range(60):
        text = prose(draw, draw.randint(20, 300))
        if k % 2:
            cut = draw.randint(0, len(text))
            begin = draw.randint(0, 300)
            text = text[:cut] + passage[begin : begin + draw.randint(300, 700)] + text[cut:]
        texts.append(text)
    texts += [texts[10], texts[10] + " tail", "head " + texts[11], texts[12][:-7] + "é" + texts[12][-6:]]
    same = prose(draw, 120)
    texts.append(same + "!" + same)
    texts += ["n" * 3 + "q" + c + "z" * 500 for c in "abc"]
    return texts


def test_against_all_windows(llm):
    check(llm, samples())


def test_hot_anchors_and_small_batches(llm, monkeypatch):
    monkeypatch.setattr(substrings, "HOT", 3)
    check(llm, samples())


def test_a_frequent_class_is_split_over_tasks(llm):
    soon = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2.0",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
        # a skewed partition is split by the tasks that wrote it, so there must be several
        "spark.sql.files.maxPartitionBytes": "64k",
        "spark.sql.files.openCostInBytes": "1k",
    }
    draw = random.Random(3)
    passage = prose(draw, 150)
    texts = [f"{k} {passage}" for k in range(2000)] + [prose(draw, 150) for _ in range(50)]
    before = {name: llm.conf.get(name, None) for name in soon}
    for name, value in soon.items():
        llm.conf.set(name, value)
    try:
        docs = llm.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(16)
        df = substrings.substring_dedup(docs)
        got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in df.collect()}
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            llm.conf.unset(name) if value is None else llm.conf.set(name, value)
    assert got == dict(enumerate(brute([t.encode() for t in texts])))
    assert "skew=true" in plan


def test_a_text_that_repeats_itself_has_few_marks(llm):
    draw = random.Random(4)
    periodic = ["on at " * 300, "on at " * 300 + "x" + "on at " * 200, "é" * 700, prose(draw, 30) + "-" * 900 + prose(draw, 90)]
    periodic += ["on at " * 66 + "on a", "on at " * 66 + "on at", "xy" * 200 + "x"]
    whole = b"".join(t.encode() for t in periodic)
    offsets = [0]
    for t in periodic:
        offsets.append(offsets[-1] + len(t.encode()))
    row, *_ = substrings.marks_of(np.frombuffer(whole, np.uint8), np.array(offsets))
    assert max(Counter(row.tolist()).values()) < 20
    check(llm, periodic)
    check(llm, ["on at " * 66 + "on at"])
    check(llm, ["on at " * 66 + "on at on"])


def test_repeated_rows_and_null_ids(llm):
    draw = random.Random(9)
    a, b = prose(draw, 200), prose(draw, 200)
    check(llm, [a, a, b, b, b + a], [1, 1, None, None, 2])
    check(llm, [])


def test_pieces_of_long_texts():
    draw = random.Random(11)
    long = prose(draw, 3000)
    column = pa.array([long, "x"])
    found = set()
    for _, data, offsets, begin in substrings.pieces(column, 1000):
        _, at, near, far, *_ = substrings.marks_of(data, offsets)
        for a, n, f in zip(at, near, far, strict=True):
            found |= set(range(begin + a - f, begin + a - n + 1))
    assert found == set(range(len(long.encode()) - N + 1))
