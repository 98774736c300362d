"""Base spans against plain regular expressions, and what the trees add."""

import hashlib
import re

import pytest

from larder.llm import pii

SF = "/root/testdata/sf0.001"
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def accepts(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def brute(text):
    spans = []
    for n, (kind, pattern) in enumerate(PATTERNS.items()):
        spans += [(m.start(), n, m.end(), kind) for m in re.finditer(pattern, text or "") if accepts(kind, m.group())]
    return [f"{kind}:{start}:{end}" for start, _, end, kind in sorted(spans)]


CASES = [
    None, "", "no data here", "a@b.co_x@d.ef", "x@y", "é@b.com 1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1 0255.001.2.3",
    "4111 1111 1111 1111", "4111-1111 1111-1111,4111111111111112", "+1 (269) 555-3296. +44", "+12345678 +1 2 3 4 5 6 7 8 9",
    "ü😀 a.b@c-d.e.f 😀 +1 555 555 5555", "1" * 3000, "a" * 3000 + "@b.c", "1.1.1.1 " * 400, "a@b.c,d@e.f;g@h.i.j..k@l.m",
    "1- 2 -3", "+1(((2", "4111 1111 1111 1111 4111 1111 1111 1111", "9.9.9.9\n+1 555\n555 5555\n5@6.7", "%@%.% a@-.-",
]


@pytest.fixture(scope="module")
def rows(llm):
    listed = [(i, t, "x") for i, t in enumerate(CASES)] + [(None, "a@b.cd", "x"), (3, CASES[3], "x")]
    docs = llm.createDataFrame(listed, "doc_id long, text string, _text string")
    return pii.personal_data(docs).collect()


def test_base_spans_equal_plain_patterns(rows):
    found = {r["doc_id"]: r for r in rows}
    assert len(rows) == len(CASES) + 2
    for i, text in enumerate(CASES):
        want = brute(text)
        assert found[i]["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest(), text
        for kind in PATTERNS:
            assert found[i][f"n_{kind}"] == sum(w.startswith(kind) for w in want)
        assert set(want) <= set(found[i]["spans"].split(","))
    assert found[None]["spans"] == "email:0:6"


def test_whole_table(llm):
    docs = llm.read.parquet(f"{SF}/documents.parquet")
    found = {r["doc_id"]: r for r in pii.personal_data(docs).collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert found.keys() == texts.keys()
    for i, text in texts.items():
        assert found[i]["base_sha256"] == hashlib.sha256(",".join(brute(text)).encode()).hexdigest()


def test_trees_add_what_looks_like_the_base(llm):
    sure = [(i, f"Call now +1 (269) 555-{1000 + i} please", ) for i in range(300)]
    decoys = [(1000 + i, f"order 12{i % 10}.{100 + i}.{1000 + i}x and v 1.2.{i}.999") for i in range(300)]
    odd = [(5000, "Call now (269) 555-4321 please")]
    docs = llm.createDataFrame(sure + decoys + odd, "doc_id long, text string")
    found = {r["doc_id"]: r for r in pii.personal_data(docs).collect()}
    assert found[5000]["n_phone"] == 0
    assert "phone:" in found[5000]["spans"]
    assert all(found[i]["spans"] == "" for i in range(1000, 1300))


def test_empty_table_and_redaction(llm):
    none = llm.createDataFrame([], "doc_id long, text string")
    assert pii.personal_data(none).collect() == []
    docs = llm.createDataFrame([(1, "mail a@b.co or 1.2.3.4!"), (2, None)], "doc_id long, text string")
    texts = {r["doc_id"]: r["text"] for r in pii.redact(docs, pii.Model()).collect()}
    assert texts == {1: "mail <email> or <ip>!", 2: ""}


def test_a_third_of_the_numbers_without_country_code(llm):
    sure = [(i, f"Call now +1 (269) 555-{1000 + i} please") for i in range(300)]
    wide = [(2000 + i, f"Call now (269) 555-{2000 + i} please") for i in range(150)]
    decoys = [(4000 + i, f"order 623.455.{1000 + i}x") for i in range(300)]
    mails = [(6000 + i, f"mail to ann{100 + i}@host.org now") for i in range(200)]
    spelled = [(7000 + i, f"mail to ann{100 + i} (at) host (dot) org now") for i in range(100)]
    docs = llm.createDataFrame(sure + wide + decoys + mails + spelled, "doc_id long, text string")
    found = {r["doc_id"]: r["spans"] for r in pii.personal_data(docs).collect()}
    assert all(found[i].startswith("phone:9:") for i, _ in wide)
    assert all(found[i].startswith("email:8:") for i, _ in spelled)
    assert all(found[i] == "" for i, _ in decoys)
