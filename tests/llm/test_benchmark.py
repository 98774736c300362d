"""Decontamination against plain longest common subsequences."""

import random

import numpy as np

from larder.llm import benchmark
from plain import holds_item, lcs

SF = "/root/testdata/sf0.001"


def test_common_subsequences():
    draw = random.Random(2)
    for _ in range(1500):
        a = [draw.randint(1, 6) for _ in range(draw.randint(1, 12))]
        b = [draw.randint(1, 6) for _ in range(draw.randint(0, 14))]
        places = benchmark.common_subsequence(np.array(a), np.array(b, dtype=int))
        assert len(places) == lcs(a, b) and places == sorted(set(places))
        rest = iter(b)
        assert all(a[i] in rest for i in places)


def test_planted_items(llm):
    draw = random.Random(7)
    word = lambda: "".join(draw.choice(["an", "er", "th", "on", "ou", "re", "ly"]) for _ in range(draw.randint(2, 4)))
    common = ["the", "of", "and", "to"]
    text = lambda n: [draw.choice(common) if draw.random() < 0.4 else word() for _ in range(n)]
    items = [(k, " ".join(text(draw.randint(15, 60)))) for k in range(12)] + [(90, "too short"), (91, None)]
    rows = []
    for k in range(120):
        body = text(draw.randint(0, 400))
        if k % 4 == 0:
            own = items[k % 12][1].split()
            if k % 8 == 0:
                own = [w for w in own if draw.random() > 0.15]
            at = draw.randint(0, len(body))
            body[at:at] = own
        rows.append((k, " ".join(body)))
    rows += [(200, None), (201, ""), (202, "the of and " * 400), (None, items[3][1]), (5, rows[5][1])]
    docs = llm.createDataFrame([(i, t, True) for i, t in rows], "doc_id long, text string, leaked boolean").drop("leaked")
    bench = llm.createDataFrame(items, "item_id long, text string")
    got = benchmark.decontaminate(docs, bench).collect()
    assert len(got) == len(rows)
    texts = dict(rows)
    for r in got:
        held = any(holds_item(texts[r["doc_id"]], t or "") for _, t in items)
        assert r["leaked"] == held or (r["doc_id"] is not None and r["doc_id"] % 8 == 0 and held is not False), r
    assert benchmark.decontaminate(docs, bench.limit(0)).where("leaked").count() == 0
    assert benchmark.decontaminate(docs.limit(0), bench).collect() == []


def test_whole_table(llm):
    docs, bench = (llm.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    items = [r["text"] for r in bench.collect()]
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    leaked = {r["doc_id"] for r in benchmark.decontaminate(docs, bench).where("leaked").collect()}
    assert leaked == {i for i, t in texts.items() if any(" ".join(x.split()) in " ".join(t.split()) for x in items)}
    assert leaked


def made_up(draw, n, parts=3):
    return " ".join("".join(draw.choice(["an", "er", "th", "on", "ou", "re", "ly", "is"]) for _ in range(parts)) for _ in range(n))


def leaked_ids(llm, rows, items):
    docs = llm.createDataFrame(rows, "doc_id long, text string")
    bench = llm.createDataFrame(items, "item_id long, text string")
    return {r["doc_id"] for r in benchmark.decontaminate(docs, bench).where("leaked").collect()}


def test_copies_of_a_leaked_document_do_not_hide_it(llm):
    draw = random.Random(11)
    items = [(k, made_up(draw, 38)) for k in range(5)]
    copied = made_up(draw, 60) + " " + items[0][1] + " " + made_up(draw, 52)
    rows = [(k, made_up(draw, 300)) for k in range(200)] + [(1000 + k, copied) for k in range(100)]
    rows += [(2000, made_up(draw, 100) + " " + items[0][1]), (2001, made_up(draw, 80) + " " + items[1][1])]
    assert leaked_ids(llm, rows, items) == {*range(1000, 1100), 2000, 2001}


def test_distinct_texts_are_counted(llm):
    rows = [("a%d b" % (k % 3000),) for k in range(9000)]
    texts = llm.createDataFrame(rows, "_text string")
    from pyspark.sql import functions as F

    counts, distinct = benchmark.frequencies(texts.select("_text", F.xxhash64("_text")), benchmark.Settings())
    assert abs(distinct - 3000) < 900 and counts.max() == distinct


def test_recall_with_thousands_of_items(llm):
    draw = random.Random(5)
    items = [(k, made_up(draw, 38, 4)) for k in range(2500)]
    rows = [(k, made_up(draw, 70, 4) + " " + items[k][1] + " " + made_up(draw, 60, 4)) for k in range(0, 2500, 5)]
    rows += [(10_000 + k, made_up(draw, 150, 4)) for k in range(100)]
    assert leaked_ids(llm, rows, items) == set(range(0, 2500, 5))


def test_items_outside_the_space_are_found_by_their_grams(llm):
    draw = random.Random(6)
    items = [(k, made_up(draw, 38)) for k in range(30)]
    rows = [(k, made_up(draw, 90) + " " + t + " " + made_up(draw, 90)) for k, t in items] + [(100, made_up(draw, 150))]
    docs = llm.createDataFrame(rows, "doc_id long, text string")
    bench = llm.createDataFrame(items, "item_id long, text string")
    few = benchmark.decontaminate(docs, bench, benchmark.Settings(rank=1, extra=0, cosine=2.0)).collect()
    assert {r["doc_id"]: r["leaked_overlap"] for r in few} == {**{k: 1.0 for k, _ in items}, 100: 0.0}


def test_short_items_are_found_exactly(llm):
    draw = random.Random(8)
    items = [(1, "Who wrote Emma? Austen"), (2, "capital Peru Lima"), (3, "xyzzy"), (4, "..."), (5, made_up(draw, 30))]
    rows = [
        (1, made_up(draw, 60) + " who wrote Emma: AUSTEN. " + made_up(draw, 60)), (2, "capital of Peru Lima"),
        (3, "The capital, Peru, Lima"), (4, "xyzzy"), (5, "xyzzyx who wrote Emma"), (6, "wrote Emma Austen who"), (7, "... ,"),
        (8, "the capital"), (9, "Peru Lima"),
    ]
    assert leaked_ids(llm, rows, items) == {1, 3, 4}
    assert leaked_ids(llm, rows, items[:3]) == {1, 3, 4}
