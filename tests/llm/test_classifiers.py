"""Toxicity and quality: held-out rows, edge cases, and forward-backward against all labellings."""

import itertools
import random
import zlib

import numpy as np
import pytest

from larder.llm import quality, toxicity
from larder.llm import text as tx

SF = "/root/testdata/sf0.01"


def prose(draw, n):
    return " ".join("".join(draw.choice(["an", "er", "th", "on", "ou", "re"]) for _ in range(draw.randint(1, 4))) for _ in range(n))


def labelled(llm, make, label, n=900):
    draw = random.Random(4)
    rows = [(i, make(draw, i % 4 == 0), i, "x") for i in range(n)]
    docs = llm.createDataFrame([(i, t, "x", 0.5) for i, t, _, _ in rows], "doc_id long, text string, label string, _text double")
    labels = llm.createDataFrame([(i, int(i % 4 == 0) if label == "toxic" else int(i % 4 != 0), "z") for i, *_ in rows], f"doc_id long, {label} int, text string")
    return docs, labels


def shouting(draw, bad):
    w = prose(draw, draw.randint(10, 80)).split()
    if bad:
        for _ in range(3):
            w.insert(draw.randrange(len(w)), draw.choice(["badword", "awful", "vileness", "vilest"]))
    return " ".join(w)


def junk(draw, bad):
    good = [prose(draw, draw.randint(5, 15)).capitalize() + "." for _ in range(draw.randint(2, 6))]
    return "\n".join([good[0], *(" ".join([w + "$$$" for w in x.split()]) for x in good[1:])] if bad else good)


@pytest.mark.parametrize("kind", ["toxic", "quality"])
def test_held_out_rows(llm, kind):
    run, make = (toxicity.toxicity, shouting) if kind == "toxic" else (quality.quality, junk)
    docs, labels = labelled(llm, make, kind)
    rows = run(docs, labels).collect()
    assert len(rows) == 900
    want = dict(labels.select("doc_id", kind).collect())
    held = [r for r in rows if r["held_out"]]
    assert 100 < len(held) < 400
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    assert sum(r["predicted"] == want[r["doc_id"]] for r in held) >= 0.97 * len(held)


def test_labels_of_held_out_rows_do_not_matter(llm):
    import zlib

    docs, labels = labelled(llm, shouting, "toxic", 300)
    flipped = llm.createDataFrame(
        [(i, 1 - y if zlib.crc32(str(i).encode()) % 4 == 2 else y) for i, y in labels.select("doc_id", "toxic").collect()], "doc_id long, toxic int"
    )
    a, b = (dict(toxicity.toxicity(docs, x).select("doc_id", "score").collect()) for x in (labels, flipped))
    assert a == b


def test_toxic_words_learned_from_capitals(llm):
    docs, labels = labelled(llm, shouting, "toxic")
    rows = [
        (i, t.upper() if i % 4 == 0 and zlib.crc32(str(i).encode()) % 4 != 2 else t)
        for i, t in docs.select("doc_id", "text").collect()
    ]
    docs = llm.createDataFrame(rows, "doc_id long, text string")
    held = toxicity.toxicity(docs, labels).where("held_out").join(labels, "doc_id").collect()
    assert sum(r["predicted"] == r["toxic"] for r in held) >= 0.97 * len(held)


@pytest.mark.parametrize("kind", ["toxic", "quality"])
def test_edges(llm, kind):
    run = toxicity.toxicity if kind == "toxic" else quality.quality
    odd = [(None, "a b", 1), (1, None, 2), (2, "", 3), (3, "\n\n", 4), (3, "\n\n", 4), (4, "w " * 200_000, 5)]
    docs = llm.createDataFrame(odd, "doc_id long, text string, score int")
    labels = llm.createDataFrame([(1, None), (None, 1), (2, 1), (2, 0)], f"doc_id long, {kind} int")
    rows = run(docs, labels).collect()
    assert len(rows) == 6 and all(0 <= r["score"] <= 1 for r in rows)
    assert not next(r for r in rows if r["doc_id"] is None)["held_out"]
    assert run(docs.limit(0), labels).collect() == []
    assert run(docs, labels.limit(0)).count() == 6


def test_quality_on_the_table(llm):
    docs, labels = (llm.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.quality(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert sum(r["predicted"] == r["quality"] for r in rows) >= 0.9 * len(rows)


def test_marginals_against_all_labellings():
    draw = np.random.default_rng(2)
    counts = [1, 4, 0 + 2, 6]
    firsts = np.concatenate([[0], np.cumsum(counts)])
    lean, stay, first = draw.normal(0, 2, firsts[-1]), 0.7, -0.4
    good, kept = quality.marginals(lean, stay, first, firsts)
    at = 0
    for a, b in zip(firsts[:-1], firsts[1:], strict=True):
        scores = {}
        for states in itertools.product([0, 1], repeat=b - a):
            total = first * states[0] + sum(x * s for x, s in zip(lean[a:b], states, strict=True))
            scores[states] = np.exp(total + stay * sum(p == q for p, q in itertools.pairwise(states)))
        z = sum(scores.values())
        for k in range(b - a):
            assert abs(good[a + k] - sum(v for s, v in scores.items() if s[k]) / z) < 1e-9
        for k in range(1, b - a):
            assert abs(kept[at] - sum(v for s, v in scores.items() if s[k] == s[k - 1]) / z) < 1e-9
            at += 1


def test_lines_and_words_by_hand():
    import pyarrow as pa

    texts = ["a b\n\nc", "", "x\n", "é!!"]
    _, _, data, offsets = next(tx.chunks(pa.array(texts)))
    _, size, firsts = quality.lines(data, offsets)
    assert firsts.tolist() == [0, 3, 4, 6, 7]
    assert size.tolist() == [4, 1, 1, 1, 2, 1, 4]
    starts, ends, hashes, first = tx.words(data, offsets)
    assert [bytes(data[a:b]).decode() for a, b in zip(starts, ends, strict=True)] == ["a", "b", "c", "x", "é"]
    assert first.tolist() == [0, 3, 3, 4, 5] and len(set(hashes.tolist())) == 5
    joined = tx.words(np.frombuffer(b"abcabc", dtype=np.uint8), np.array([0, 3, 6]))
    assert joined[2][0] == joined[2][1] and joined[3].tolist() == [0, 1, 2]


def test_the_sample_is_bounded_by_documents(llm):
    from larder.llm.fitting import labelled_sample

    rows = [(7, "same")] * 3000 + [(7, f"text {k % 400}") for k in range(800)] + [(i, "t") for i in range(8, 60)] + [(None, "t")]
    docs = llm.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, label string")
    labels = llm.createDataFrame([(i, int(i % 2), 0) for i in range(60)] + [(7, 0, 0)], "doc_id long, toxic int, text int")
    got = labelled_sample(docs, labels, "toxic", 4, 2, 100, 4).collect()
    outside = [i for i in range(7, 60) if zlib.crc32(str(i).encode()) % 4 != 2]
    by = {kind: [(r["doc_id"], r["text"]) for r in got if r["label"] == kind] for kind in (0, 1)}
    assert all(len(set(x)) == len(x) <= 100 for x in by.values())
    assert {i for i, _ in by[0]} <= set(outside) and sorted({i for i, _ in by[1]} - {7}) == [i for i in outside if i % 2 and i != 7]
    if 7 in outside:
        assert len(by[1]) == 100 or len([i for i, _ in by[1] if i == 7]) == 401
