"""The n-gram Jaccard join against all pairs."""

import random
from collections import Counter

import pytest

from larder.llm import jaccard
from larder.llm.components import connected_components
from plain import classes


def rows_of(seed):
    draw = random.Random(seed)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(draw.randint(2, 6)))
    rows = [(1, None), (2, ""), (3, " .. "), (4, "one two"), (5, "One, two"), (6, "one two three")]
    base = [word() for _ in range(draw.randint(30, 150))]
    for k in range(40):
        text = list(base)
        for _ in range(draw.randint(0, 4)):
            text[draw.randrange(len(text))] = word()
        rows.append((10 + k, " ".join(text)))
        if k % 7 == 0:
            base = [word() for _ in range(draw.randint(6, 150))]
    rows += [(100, rows[-1][1]), (100, rows[-1][1]), (None, rows[-2][1].upper()), (101, "é ü " * 30), (102, "é ü " * 31), (103, "long " * 3000)]
    return rows


@pytest.mark.parametrize("settings", [jaccard.Settings(), jaccard.Settings(branch=3, block=4)], ids=["whole", "split"])
def test_against_all_pairs(llm, settings):
    rows = rows_of(3)
    docs = llm.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, set string, root int")
    got = Counter((r["doc_id"], r["class_id"], r["n_links"]) for r in jaccard.jaccard_join(docs, settings).collect())
    assert got == Counter((i, *c) for (i, _), c in zip(rows, classes(rows), strict=True))
    kept = jaccard.one_per_class(docs, settings)
    assert kept.columns == docs.columns
    left = Counter(c for _, c in {(i, c) for (i, _), (c, _) in zip(rows, classes(rows), strict=True)})
    assert len(left) == kept.count()


def test_nothing_near(llm):
    docs = llm.createDataFrame([(1, "a b c d e f"), (2, "g h i j k l")], "doc_id long, text string")
    assert {(r["doc_id"], r["class_id"], r["n_links"]) for r in jaccard.jaccard_join(docs).collect()} == {(1, 1, 0), (2, 2, 0)}
    assert jaccard.jaccard_join(docs.limit(0)).collect() == []
    assert jaccard.one_per_class(docs.limit(0)).collect() == []


def test_prefix_reaches_the_recall():
    s = jaccard.Settings()
    assert 1 - (1 - 0.8 ** s.prefix()) ** s.trees >= s.recall
    assert 1 - (1 - 0.8 ** (s.prefix() + 1)) ** s.trees < s.recall


def test_components(llm):
    draw = random.Random(2)
    edges = [(draw.randrange(300), draw.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(400, 460)] + [(7, 7)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    got = dict(connected_components(llm.createDataFrame(edges, "u long, v long"), 3).collect())
    assert got == {x: root(x) for x in parent}
