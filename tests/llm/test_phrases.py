"""Phrases against a plain count, and the automata by themselves."""

import re
from collections import Counter
from fractions import Fraction
from math import floor

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from larder.llm import phrases

SF = "/root/testdata/sf0.01"


def plain(rows, s):
    """Every result row by counting in a dictionary."""
    seen, words = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            w = re.findall(r"[^\x20\x09]+", piece)
            words[lang] += len(w)
            for n in range(1, s.max_words + 1):
                for i in range(len(w) - n + 1):
                    seen.setdefault(lang, Counter())[tuple(w[i : i + n])] += 1
    out = []
    for lang, f in seen.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= s.least}
        kept = []
        for p, a in candidates.items():
            longer = [b for q, b in candidates.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if any(100 * b >= s.cover * a for b in longer):
                continue
            cuts = [(floor(Fraction(1000000 * a * a, f[p[:k]] * f[p[k:]])), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p))]
            kept.append((*min(cuts), " ".join(p), a))
        kept.sort(key=lambda x: (-x[0], -x[5], x[4].encode()))
        out += [(lang, i, p, a, left, right, words[lang], score, k) for i, (score, k, left, right, p, a) in enumerate(kept[: s.top], 1)]
    return sorted(out)


def found(df, s):
    return sorted(tuple(r) for r in phrases.phrases(df, s).collect())


ROWS = [
    ("a b c. a b c, A B\tC; x a b", "en"), ("a a a a", "en"), ("a a a", None), ("", "en"), (None, "de"), ("é é\nÉ é\x0bé é", "de"),
    ("a b c. a b c, A B\tC; x a b", "en"), ("a b a b a b", "fr"), ("...,,,", "fr"), ("b c " * 40, "en"), ("z", "zz"),
]


@pytest.mark.parametrize("settings", [
    phrases.Settings(least=1), phrases.Settings(least=2, top=3), phrases.Settings(least=2, max_words=2), phrases.Settings(least=2, max_words=4),
    phrases.Settings(least=2, shard_bytes=8, range_bytes=5, states_at_once=1, buckets=2),
])
def test_small_texts_equal_a_plain_count(llm, settings):
    df = llm.createDataFrame([(t, lang, 1, "x") for t, lang in ROWS], "text string, lang string, rank int, phrase string").repartition(3)
    assert found(df, settings) == plain(ROWS, settings)


def test_given_documents_equal_the_sql(llm):
    c = duckdb.connect()
    c.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    got = found(llm.read.parquet(f"{SF}/documents.parquet"), phrases.Settings(shard_bytes=1 << 17, range_bytes=1 << 18, states_at_once=5000))
    assert got == sorted(c.execute(phrases.sql()).fetchall()) and len(got) > 1000


def test_empty_table_and_hot_phrase(llm):
    schema = "text string, lang string"
    assert found(llm.createDataFrame([], schema), phrases.Settings()) == []
    rows = [("the same words again", "en")] * 3000 + [(f"the same w{i}", "en") for i in range(500)]
    s = phrases.Settings(states_at_once=64, shard_bytes=1 << 12, range_bytes=1 << 12)
    assert found(llm.createDataFrame(rows, schema).repartition(8), s) == plain(rows, s)


def test_long_text_is_cut_between_pieces():
    data = np.frombuffer(b"one two. three four, five six seven eight nine ten", np.uint8)
    parts = [p.tobytes() for p in phrases._between_pieces(data, 10)]
    assert parts == [b"one two.", b" three four,", b" five six seven eight nine ten"]


def test_united_transducers_equal_the_transducer_of_all():
    rng = np.random.default_rng(1)
    lines = [" ".join(rng.choice(list("abcd"), 12)) for _ in range(40)]

    def blocks(texts):
        data = np.frombuffer("\n".join(texts).encode(), np.uint8)
        words, word, row, follows = phrases.spell(data, np.array([0, len(data)]))
        levels = phrases.automaton(np.zeros(len(word), np.int64), word, follows, len(words), 3)
        assert all((np.diff(level.up * len(words) + level.label) > 0).all() for level in levels)
        return dict(phrases.cut_by_range(levels, words, pa.array(["en"]), 7))

    def spelled(block):
        return [[r for batch in phrases.frequent(block, 1) for r in batch.to_pylist()]]

    one, two, both = blocks(lines[:13]), blocks(lines[13:]), blocks(lines)
    assert one.keys() | two.keys() == both.keys() and len(both) > 3
    for r, block in both.items():
        parts = [phrases.load(phrases.dump(x[r])) for x in (one, two) if r in x]
        assert spelled(phrases.unite(parts)) == spelled(phrases.unite([block])) == spelled(block)
