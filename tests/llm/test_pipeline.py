"""The pipeline stage by stage against plain versions, on the smallest table."""

from collections import Counter

import pytest

import corpus_pipeline
from larder.llm import toxicity
from larder.sources.scratch import materialize
from plain import classes, line_dedup

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(llm):
    docs = llm.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(materialize(stage(llm, out[-1], SF), "stage"))
    return out


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_columns_and_names(stages):
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None
    for df in stages[1:-1]:
        assert df.columns == stages[0].columns
    assert {"doc_id", "text", "mix_weight"} <= set(stages[-1].columns)


def test_toxic_documents_go(llm, stages):
    scored = toxicity.toxicity(stages[0], llm.read.parquet(f"{SF}/labels.parquet"))
    kept = {r["doc_id"] for r in scored.where("predicted = 0").collect()}
    assert {i for i, _ in pairs(stages[1])} == kept and kept


def test_repeated_lines_go(stages):
    before = pairs(stages[1])
    want = Counter()
    for (i, _), (left, gone) in zip(before, line_dedup(before), strict=True):
        if not gone or left.strip():
            want[i, left] += 1
    assert Counter(pairs(stages[2])) == want
    assert all(r["n_chars"] == len(r["text"]) for r in stages[2].collect())


def test_one_of_each_class_stays(stages):
    before = pairs(stages[2])
    found = classes(before)
    assert {i for i, _ in pairs(stages[3])} == {c for c, _ in found}


def test_benchmark_documents_go(llm, stages):
    items = [" ".join(r["text"].split()) for r in llm.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for i, t in pairs(stages[3]):
        if any(x in " ".join(t.split()) for x in items):
            assert i not in {j for j, _ in pairs(stages[4])}
    assert len(pairs(stages[4])) >= 0.8 * len(pairs(stages[3]))


def test_the_mix_is_drawn_from_what_is_left(stages):
    left = dict(pairs(stages[4]))
    drawn = pairs(stages[5])
    assert drawn and all(left[i] == t for i, t in drawn)


def test_odd_rows_pass_all_stages(llm):
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (2, None, "en", "s", 9), (2, None, "en", "s", 9), (3, "a b", None, None, 3)]
    docs = llm.createDataFrame([(*r, 1, "q") for r in rows], "doc_id long, text string, lang string, source string, n_chars long, _id int, _text string")
    for name, stage in corpus_pipeline.STAGES:
        out = materialize(stage(llm, docs, SF), "odd")
        assert out.count() <= 5, name
        empty = stage(llm, docs.limit(0), SF)
        assert empty.count() == 0
        docs = out if set(out.columns) == set(docs.columns) else docs
