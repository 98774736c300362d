"""Line dedup, URL rules and mixing against plain versions."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from larder.llm import lines, mixing, urls
from plain import line_dedup


def test_lines_against_all_windows(llm):
    draw = random.Random(8)
    pool = [" ".join(draw.choice("abcdef") * 2 for _ in range(draw.choice([1, 3, 12, 30, 60]))) for _ in range(25)]
    rows = [(None, "\n".join(pool[:4])), (0, None), (1, ""), (2, "\n \n"), (3, " x\t\n" + pool[0])]
    for k in range(60):
        text = [draw.choice(pool) if draw.random() < 0.5 else f"own {k} line " + "w " * draw.randint(0, 40) for _ in range(draw.randint(1, 9))]
        begin = draw.randrange(20)
        rows.append((10 + k, "\n".join(text + [""] * (k % 2) + pool[begin : begin + draw.randint(0, 4)])))
    rows += [rows[12], rows[12]]
    docs = llm.createDataFrame([(i, t, 1, "y") for i, t in rows], "doc_id long, text string, n_lines int, _row string")
    got = Counter((r[0], r[1], r[-1]) for r in lines.line_dedup(docs, counts=("a", "b")).select("doc_id", "text", "a", "b").collect())
    assert got == Counter((i, *w) for (i, _), w in zip(rows, line_dedup(rows), strict=True))
    assert any(n for _, _, n in got)
    assert lines.line_dedup(docs.limit(0)).collect() == []


def test_fingerprints_are_window_minima_and_few(llm):
    draw = random.Random(9)
    pool = [" ".join(draw.choice("abcdefgh") * 3 for _ in range(5)) for _ in range(400)]
    texts = ["\n".join(pool[:200]), "\n".join(pool[200:300] + pool[50:70] + pool[300:]), "\n".join(pool[50:60] + pool[:9])]
    docs = llm.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = lines.windows(lines.hashed_lines(docs))
    rows = found.collect()
    hashes = {(r["_id"], r["_i"]): r["_h"]["a"] for r in lines.hashed_lines(docs).collect()}
    for r in rows:
        run = [(hashes[r["_id"], i], i) for i in range(r["_from"], r["_to"] + 1)]
        assert min(run) == (r["_mark"], r["_at"])
    positions = {(r["_id"], r["_at"]) for r in rows}
    assert len(positions) < 0.35 * len(hashes)
    at = Counter(hashes[p] for p in positions)
    assert {r["_mark"] for r in lines.shared_fingerprints(found).collect()} == {h for h, n in at.items() if n > 1}
    lost = {r["doc_id"]: r["n_removed"] for r in lines.line_dedup(docs).collect()}
    assert lost == {0: 0, 1: 20, 2: 10}


CASES = [
    (None, "", "", None), ("", "", "", None), ("no scheme", "", "", None), ("http://A.Example.ORG", "a.example.org", "", None),
    ("http://x.org/a?b#c", "x.org", "/a", "org/"), ("https://example.org/es/1", "example.org", "/es/1", "example.org/es/"),
    ("https://m.example.org/en/12#t", "m.example.org", "/en/12", "example.org/en/1"), ("https://notexample.org/es/1", "notexample.org", "/es/1", "org/"),
    ("https://x.com/fr/", "x.com", "/fr/", "com/fr/"), ("https://x.com/de/?q", "x.com", "/de/", "com/de/"), ("https://x.com/DE/", "x.com", "/DE/", None),
    ("ftp://x.net?http://y.org/", "x.net", "", None), ("a://b://c.org/d", "b:", "//c.org/d", None), ("http://ÄB.org/\n", "Äb.org", "/\n", "org/"),
    ("http://org/", "org", "/", "org/"), ("http://xorg/", "xorg", "/", None),
]


def test_hosts_paths_and_rules(llm):
    df = llm.createDataFrame([(k, c[0], "x") for k, c in enumerate(CASES)], "page_id long, url string, host string")
    got = {r["page_id"]: r for r in urls.judge(df).collect()}
    kinds = {h + p: v for h, p, v in urls.RULES}
    for k, (_, host, path, rule) in enumerate(CASES):
        assert (got[k]["host"], got[k]["path"], got[k]["rule"]) == (host, path, rule)
        assert got[k]["verdict"] == kinds[rule] if rule else got[k]["verdict"] in ("allow", "block")
    assert urls.judge(df.limit(0)).collect() == []


def plain_ratio(rows, gram):
    """The log ratio of the last character of ``gram``, counted over whole URLs."""
    size = len(urls.ALPHABET)

    def p(kind, context, c):
        texts = ["^" * urls.ORDER + url + "$" for url, verdict in rows if verdict == kind]
        after = Counter(t[i] for t in texts for i in range(urls.ORDER, len(t)) if t[i - len(context) : i] == context)
        n = sum(after.values())
        if not context:
            return (after[c] + 1) / (n + size)
        shorter = p(kind, context[1:], c)
        return (after[c] + len(after) * shorter) / (n + len(after)) if n >= urls.GROWTH else shorter

    return math.log(p("allow", gram[:-1], gram[-1])) - math.log(p("block", gram[:-1], gram[-1]))


def test_ratios_of_variable_order_by_hand(llm):
    draw = random.Random(3)
    name = lambda k: "".join(draw.choice("abc") for _ in range(k))
    rows = [(f"http://{name(2)}.org/{name(9)}", "allow") for _ in range(30)] + [(f"http://{name(3)}.com/de/{name(5)}", "block") for _ in range(20)]
    labelled = llm.createDataFrame(rows, "url string, verdict string")
    ratios = urls.log_ratios(labelled)
    lengths = Counter(len(r["context"]) for r in ratios.collect())
    padded = ["^" * urls.ORDER + url for url, _ in rows]
    whole = {t[i - urls.ORDER : i] for t in padded for i in range(urls.ORDER, len(t) + 1)}
    assert lengths[0] == 1 and 0 < lengths[urls.ORDER] < len(whole)
    seen = llm.createDataFrame([(u,) for u, _ in rows[::5]] + [("http://zz.net/de/abcabc",), ("",)], "url string")
    got = {r["gram"]: r["value"] / urls.UNIT for r in urls.gram_values(seen, ratios).collect()}
    texts = ["^" * urls.ORDER + r["url"] + "$" for r in seen.collect()]
    assert set(got) == {t[i : i + urls.ORDER + 1] for t in texts for i in range(len(t) - urls.ORDER)}
    for gram, value in got.items():
        assert abs(value - plain_ratio(rows, gram)) < 1e-8
    keyed = seen.select("url", F.xxhash64("url").alias("_a"), F.lit(0).alias("_b"))
    score = {r["url"]: r["score"] for r in keyed.join(urls.scores(keyed, ratios), ["_a", "_b"]).collect()}
    for t in texts:
        every = [plain_ratio(rows, t[i : i + urls.ORDER + 1]) for i in range(len(t) - urls.ORDER)]
        assert abs(score[t[urls.ORDER : -1]] - sum(every) / len(every)) < 1e-8


def test_urls_without_rules_follow_their_likes(llm):
    draw = random.Random(1)
    name = lambda: "".join(draw.choice("abcdefgh") for _ in range(6))
    rows = [f"http://{name()}.org/{name()}" for _ in range(300)] + [f"http://{name()}.com/de/{name()}" for _ in range(300)]
    rows += ["http://nice.net/hello"] * 3 + ["http://xyz.net/de/abc"] * 2
    df = llm.createDataFrame([(k, u) for k, u in enumerate(rows)], "page_id long, url string")
    got = Counter((r["host"], r["verdict"]) for r in urls.judge(df).where("rule is null").collect())
    assert got == {("nice.net", "allow"): 3, ("xyz.net", "block"): 2}


def test_raked_weights_meet_the_targets(llm):
    draw = random.Random(6)
    cells = llm.createDataFrame(
        [(f"s{a}", f"l{b}", f"t{c}", draw.randint(1, 5000) * (1 + 30 * (a == 0))) for a in range(5) for b in range(3) for c in range(4)],
        "source string, lang string, topic string, tokens long",
    )
    settings = mixing.Settings(targets={"lang": {"l0": 0.2, "l1": 0.3, "l2": 0.5}})
    raked = mixing.rake(cells, settings)
    rows = raked.collect()
    total = sum(r["tokens"] for r in rows)
    want = {"lang": settings.targets["lang"]}
    for m in ("source", "topic"):
        natural = {v: sum(r["tokens"] for r in rows if r[m] == v) ** 0.7 for v in {r[m] for r in rows}}
        want[m] = {v: n / sum(natural.values()) for v, n in natural.items()}
    found = mixing.margins(raked).collect()
    assert len(found) == 12
    for r in found:
        share = want[r["margin"]][r["value"]]
        got = sum(x["tokens"] * x["weight"] for x in rows if x[r["margin"]] == r["value"]) / total
        assert abs(got - share) < 1e-5 * share and abs(r["got"] - got) < 1e-9 and abs(r["wanted"] - share) < 1e-9
    c = mixing.scale_of(raked, 0.6)
    assert abs(sum(r["tokens"] * min(1, c * r["weight"]) for r in rows) / total - 0.6) < 1e-9


def test_raking_goes_on_until_skewed_margins_are_met_or_shows_that_they_cannot_be(llm):
    rows = [("a", "x", "t", 10_000_000), ("a", "y", "t", 10), ("b", "x", "t", 10), ("b", "y", "t", 1000), ("c", "x", "t", 1), ("c", "y", "t", 1)]
    cells = llm.createDataFrame(rows, "source string, lang string, topic string, tokens long")
    for r in mixing.margins(mixing.rake(cells)).collect():
        assert abs(r["got"] - r["wanted"]) < 1e-4 * r["wanted"]
    targets = {"source": {"a": 0.5, "b": 0.5}, "lang": {"x": 0.2, "y": 0.8}}
    tied = cells.where("source || lang in ('ax', 'by')")
    met = {(r["margin"], r["value"]): (r["wanted"], r["got"]) for r in mixing.margins(mixing.rake(tied, mixing.Settings(targets=targets, rounds=5))).collect()}
    assert abs(met["lang", "x"][1] - 0.2) < 1e-9 and met["source", "a"][0] == 0.5 and abs(met["source", "a"][1] - 0.2) < 1e-9


CLASHING = ["n_lines", "N_Removed", "leaked", "leaked_items", "mix_topic", "mix_weight", "_toxicity", "_gone", "_lines", "_row", "_text", "_n", "_lost", "score", "row", "topic", "_p"]


def test_columns_with_the_names_of_results(llm):
    from larder.llm import benchmark

    rows = [(1, "a b c\n" * 30, "en", "s"), (2, "a b c\n" * 30, "en", "s"), (3, None, None, None)]
    docs = llm.createDataFrame([(*r, *range(len(CLASHING))) for r in rows], ["doc_id", "text", "lang", "source", *CLASHING])
    bench = llm.createDataFrame([(1, "one two three four five six seven eight nine", 0)], "item_id long, text string, leaked int")
    for made, out in [
        (("n_lines", "n_removed"), lines.line_dedup(docs)), (benchmark.MADE, benchmark.decontaminate(docs, bench)), (mixing.MADE, mixing.mix(docs, mixing.Settings(keep=1.0))),
    ]:
        names = [c.lower() for c in out.columns]
        assert len(set(names)) == len(names) and set(names) == {c.lower() for c in docs.columns} | set(made)
        assert all(r["score"] == CLASHING.index("score") for r in out.collect())


def test_mix_edges(llm):
    rows = [(None, None, None, None), (1, "", "en", "a"), (2, "w " * 50, None, "a"), (2, "w " * 50, None, "a"), (3, "x@y z", "de", None)]
    docs = llm.createDataFrame([(*r, "q") for r in rows], "doc_id long, text string, lang string, source string, weight string")
    out = mixing.mix(docs, mixing.Settings(keep=1.0))
    assert out.columns[:5] == docs.columns
    assert {r["mix_topic"] for r in out.collect()} <= {"note", "contact"}
    assert mixing.mix(docs.limit(0)).collect() == []
    blank = mixing.mix(docs.withColumn("text", F.lit("")))
    assert blank.count() == 5
    big = llm.range(4000).select(F.col("id").alias("doc_id"), F.lit("a b c d").alias("text"), (F.col("id") % 2).cast("string").alias("lang"), F.lit("s").alias("source"))
    assert 2200 < mixing.mix(big).count() < 2600


@pytest.mark.parametrize("name", ["op5_jaccard_join", "op7_line_dedup", "op10_mixing"])
def test_queries_equal_their_sql(llm, name):
    from larder.llm.queries import QUERIES
    from oracle_check import compare, connect

    folder = "/root/testdata/sf0.001"
    assert compare(QUERIES[name].run(llm, folder), connect(folder), QUERIES[name].sql) is None
