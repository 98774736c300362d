"""Packing against whole-text tokenization and plain sums."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from larder.llm import packing

SF = "/root/testdata/sf0.01"
PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, start string, sequence_id int"


def check(rows, s, df):
    """Every rule of the result; returns the number of windows and the share of padding."""
    tokenizer = Tokenizer.from_file(s.vocabulary)
    want = Counter()
    for i, text in rows:
        want[i, tuple(tokenizer.encode(text or "", add_special_tokens=False).ids + [s.end])] += 1
    pieces = packing.packed(df, s).collect()
    windows, docs = defaultdict(list), defaultdict(Counter)
    for r in pieces:
        ids = np.frombuffer(r["ids"], "<u4")
        assert len(ids) == r["length"] > 0 and zlib.crc32(r["ids"]) == r["ids_crc32"]
        windows[r["sequence_id"]].append((r["offset"], r["length"]))
        docs[r["doc_id"], r["doc_tokens"]][r["start"], tuple(ids.tolist())] += 1
    for placed in windows.values():
        end = 0
        for offset, length in sorted(placed):
            assert offset == end
            end += length
        assert end <= s.capacity
    have = Counter()
    # rows with the same id and as many tokens have pieces that fit together in any order of equal starts
    for (i, total), parts in docs.items():
        at = defaultdict(list)
        for (start, ids), n in parts.items():
            at[start] += [ids] * n
        for _ in range(sum(n for (start, _), n in parts.items() if start == 0)):
            ids: tuple = ()
            while len(ids) < total:
                ids += at[len(ids)].pop()
            have[i, ids] += 1
        assert not any(at.values())
    assert have == want
    sums = [sum(length for _, length in placed) for placed in windows.values()]
    padding = sum(s.capacity - n for n in sums if n & (n - 1))
    return len(sums), padding / max(sum(sums), 1)


def test_given_documents(llm):
    df = llm.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    _, padding = check(rows, packing.Settings(PATH), df)
    assert padding < 0.006


CASES = [
    (1, "Hello world. It's 1,234.5 (o.k.), isn't it?"), (2, None), (3, ""), (4, "   \n\t "), (None, "x y z."), (None, None),
    (5, "Ångstrom İstanbul café café 你好　世界."), (6, "a.b, c,. d. .e , . ,"), (7, "word " * 3000),
    (8, "Word.́ x. y. "), (9, "<|endoftext|> <|endoftext|>."), (10, "e." * 50), (11, "UPPER lower Upper."), (12, "nowhite" * 200), (13, "é. È,*** x÷. y×, 's. it's'. a$$$ ß!! é̂. word<|endoftext|> |>."),
    (14, "end."), (15, ".start"), (16, "a"), (17, "-"), (18, "İx. ŉy, K. ª."),
]


@pytest.mark.parametrize("by_word", [True, False])
def test_odd_texts_repeats_and_small_windows(llm, by_word):
    rows = CASES + [(20, "the same text again and again.")] * 40 + [(20 + i, "the same text again and again.") for i in range(40)]
    df = llm.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA).repartition(4)
    check(rows, packing.Settings(PATH, capacity=64, group_tokens=500, by_word=by_word), df)


def test_empty_table(llm):
    assert packing.pack_documents(llm.createDataFrame([], SCHEMA), packing.Settings(PATH)).collect() == []


@pytest.mark.parametrize("seed", range(5))
def test_differencing_gives_near_equal_windows(seed):
    rng = np.random.default_rng(seed)
    sizes = rng.integers(1, 900, 400)
    for windows in (1, 2, 7, 40):
        window = packing.differencing(sizes, windows)
        sums = np.bincount(window, weights=sizes, minlength=windows)
        assert len(sums) == windows and sums.max() - sums.min() <= 12
    # the textbook case: differences 8-7, 6-5, 4-1, 3-1 leave 2
    textbook = np.array([8, 7, 6, 5, 4])
    assert sorted(np.bincount(packing.differencing(textbook, 2), weights=textbook)) == [14, 16]


def test_window_count_rises_and_documents_are_cut():
    # three pieces of 60 cannot share two windows of 100 unless one is cut
    doc, start, length, window = packing.pack(np.array([60, 60, 60]), 100, 0.0)
    assert max(np.bincount(window, weights=length)) <= 100 and window.max() + 1 == 3 and len(doc) == 3
    doc, start, length, window = packing.pack(np.full(30, 51), 100, 0.0)
    assert window.max() + 1 <= 17 and max(np.bincount(window, weights=length)) <= 100
    for k in range(30):
        own = np.flatnonzero(doc == k)
        assert length[own].sum() == 51 and start[own].tolist() == np.concatenate([[0], np.cumsum(length[own])[:-1]]).tolist()
