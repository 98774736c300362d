"""URL filter: rules first, then the ratio of two character language models.

The URLs that a rule allows and those that a rule blocks train one Markov model
each, of variable order: a context grows by one more character to the left, up to
``ORDER``, as long as a model saw it ``GROWTH`` times, and leaves the say to the
shorter context where it did not. A context gives its own counts the weight of
their number and what the shorter context says the weight of the number of
different characters seen after it. A URL without a rule is judged by the
difference of its two log-likelihoods per character against a threshold that
separates the rule-labelled URLs of a fold the models have not seen as evenly as
possible.

Characters are lower-cased, digits become one symbol, and what is outside the
alphabet another. A context holds one number per character of the alphabet; how
many contexts there are grows with the labelled URLs, so they are joined, not
broadcast. Each different run of characters is looked up once; the runs that make
up more than one in ``HOT`` of all characters are fewer than ``HOT``, and broadcast
with that bound. Scores are sums of whole numbers, alike in any order of rows.
Counting and scoring run over distinct URLs, so a URL that holds many rows costs
one.

Cases: a null URL, or one without ``://``, has empty host and path and no rule;
the models score it like any other text (null as empty). When either model has
no URL, what no rule judges is allowed. Repeated rows each get their verdict.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.sources.scratch import materialize

#: (host, path, verdict)
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
ALPHABET = "abcdefghijklmnopqrstuvwxyz0-._/:?&=#%~+*^$"
ORDER = 5
GROWTH = 8
HOT = 10_000
UNIT = 1e9
CALIBRATION_FOLDS = 5
BIN = 0.01


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, ASCII letters lower-cased."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple = RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, null where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule_host, rule_path, kind in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        rule = F.when(fits, rule_host + rule_path).otherwise(rule)
        verdict = F.when(fits, kind).otherwise(verdict)
    return rule, verdict


def _symbols(url: Column) -> Column:
    """The URL in the alphabet, between ``ORDER`` start signs and an end sign, as an array."""
    plain = F.regexp_replace(F.lower(F.coalesce(url, F.lit(""))), "[0-9]", "0")
    known = F.regexp_replace(plain, r"(?s)[^a-z0\-._/:?&=#%~+]", "*")
    return F.split(F.concat(F.lit("^" * ORDER), known, F.lit("$")), "")


def grams(urls: DataFrame, *keep: str) -> DataFrame:
    """A row for each character of each URL, with the ``ORDER`` before it."""
    listed = urls.select(*keep, _symbols(F.col("url")).alias("_s"))
    places = F.sequence(F.lit(0), F.size("_s") - ORDER - 1)
    run = F.transform(places, lambda i: F.concat(*[F.get("_s", i + k) for k in range(ORDER + 1)]))
    return listed.select(*keep, F.explode(run).alias("gram"))


def contexts(labelled: DataFrame) -> DataFrame:
    """(context, allow, block): counts of each character of the alphabet after each context that one model saw ``GROWTH`` times."""
    whole = grams(labelled, "verdict").groupBy("gram").agg(
        F.count_if(F.col("verdict") == "allow").alias("allow"), F.count_if(F.col("verdict") == "block").alias("block")
    )
    ends = F.explode(F.array(*[F.substring("gram", ORDER + 1 - k, k + 1) for k in range(ORDER + 1)]))
    counts = whole.select(ends.alias("gram"), "allow", "block").groupBy("gram").agg(F.sum("allow").alias("allow"), F.sum("block").alias("block"))
    last = F.substring("gram", -1, 1)
    follow = lambda kind: F.map_from_entries(F.collect_list(F.struct(last, F.col(kind)))).alias(kind)
    letters = F.split(F.lit(ALPHABET), "")
    dense = lambda kind: F.transform(letters, lambda c: F.coalesce(F.col(kind)[c], F.lit(0)).cast("double")).alias(kind)
    sums = counts.groupBy(F.expr("left(gram, length(gram) - 1)").alias("context")).agg(
        follow("allow"), follow("block"), F.greatest(F.sum("allow"), F.sum("block")).alias("_n")
    )
    return sums.where((F.col("_n") >= GROWTH) | (F.col("context") == "")).select("context", dense("allow"), dense("block"))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, x: total + x)


def log_ratios(labelled: DataFrame) -> DataFrame:
    """(context, ratio): log P(accepted) - log P(rejected) of each character of the alphabet after each context."""
    kept = materialize(contexts(labelled), "contexts")

    def smoothed(kind: str) -> Column:
        counts, shorter = F.col(kind), F.col(f"shorter_{kind}")
        n, kinds = _sum(counts), F.size(F.filter(counts, lambda x: x > 0))
        own = F.zip_with(counts, shorter, lambda c, p: (c + kinds * p) / (n + kinds))
        return F.when(n >= GROWTH, own).otherwise(shorter).alias(kind)

    flat = lambda kind: F.transform(kind, lambda c: (c + 1) / (_sum(F.col(kind)) + len(ALPHABET))).alias(kind)
    grown = [materialize(kept.where("context = ''").select("context", flat("allow"), flat("block")), "order")]
    for k in range(1, ORDER + 1):
        shorter = grown[-1].select(F.col("context").alias("_shorter"), *[F.col(c).alias(f"shorter_{c}") for c in ("allow", "block")])
        longer = kept.where(F.length("context") == k).join(shorter, F.substring("context", 2, k) == F.col("_shorter"))
        grown.append(materialize(longer.select("context", smoothed("allow"), smoothed("block")), "order"))
    table = grown[0]
    for order in grown[1:]:
        table = table.unionAll(order)
    return table.select("context", F.zip_with("allow", "block", lambda a, b: F.log(a) - F.log(b)).alias("ratio"))


def gram_values(urls: DataFrame, ratios: DataFrame) -> DataFrame:
    """(gram, value, n): the log ratio, in whole ``UNIT``ths, of each different gram's last character after its longest known context, and its number."""
    counted = grams(urls).groupBy("gram").agg(F.count("*").alias("n"))
    tails = F.posexplode(F.array(*[F.substring("gram", ORDER + 1 - k, k) for k in range(ORDER + 1)])).alias("_k", "context")
    value = F.get("ratio", F.call_function("locate", F.substring("gram", -1, 1), F.lit(ALPHABET)) - 1)
    known = counted.select("gram", "n", tails).join(ratios, "context").select("gram", "n", "_k", F.round(value * UNIT).cast("long").alias("value"))
    return known.groupBy("gram").agg(F.max_by("value", "_k").alias("value"), F.first("n").alias("n"))


def scores(urls: DataFrame, ratios: DataFrame) -> DataFrame:
    """(_a, _b, score): the mean log ratio of the characters of each distinct URL, which its two hashes stand for."""
    values = materialize(gram_values(urls, ratios), "values")
    total = values.agg(F.sum("n")).first()[0] or 0
    hot = F.broadcast(values.where(F.col("n") * HOT > total).select("gram", "value"))
    rest = values.where(F.col("n") * HOT <= total).select("gram", "value")
    places = grams(urls, "_a", "_b")
    valued = places.join(hot, "gram").unionAll(places.join(hot, "gram", "left_anti").join(rest, "gram"))
    return valued.groupBy("_a", "_b").agg((F.sum("value") / F.count("*") / UNIT).alias("score"))


def threshold(scored: DataFrame) -> float:
    """The score at which the held-out accepted and rejected URLs part best, midway between the two bins.

    At most one row per bin is collected.
    """
    bins = (
        scored.groupBy(F.floor(F.col("score") / BIN).alias("bin"))
        .agg(F.count_if(F.col("verdict") == "allow").alias("allow"), F.count_if(F.col("verdict") == "block").alias("block"))
        .orderBy("bin").collect()
    )
    allow, block = sum(r["allow"] for r in bins) or 1, sum(r["block"] for r in bins) or 1
    best, at, passed, last = -1.0, 0.0, [0, 0], None
    for row in bins:
        good = (allow - passed[0]) / allow + passed[1] / block
        if good > best:
            best, at = good, (row["bin"] + (row["bin"] if last is None else last + 1)) / 2 * BIN
        last = row["bin"]
        passed = [passed[0] + row["allow"], passed[1] + row["block"]]
    return at


def judge(pages: DataFrame, rules: tuple = RULES) -> DataFrame:
    """page_id, host, path, rule and verdict of every page, and the score of the models."""
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    rule, verdict = rule_of(host, path, rules)
    rows = pages.select(pages["page_id"].cast("long").alias("page_id"), pages["url"].cast("string").alias("url"))
    distinct = rows.select(F.coalesce("url", F.lit("")).alias("url")).distinct()
    hashes = F.xxhash64("url").alias("_a"), F.xxhash64(F.lit(1), "url").alias("_b")
    judged = materialize(distinct.select("url", verdict.alias("verdict"), *hashes), "urls")
    held = F.pmod(F.xxhash64("url", F.lit(6)), F.lit(CALIBRATION_FOLDS)) == 0
    labelled = judged.where("verdict is not null")
    sizes = dict(labelled.where(~held).groupBy("verdict").count().collect())
    if len(sizes) == 2:
        ratios = log_ratios(labelled.where(~held))
        scored = materialize(judged.join(scores(judged, ratios), ["_a", "_b"]), "scores")
        cut = threshold(scored.where(held & F.col("verdict").isNotNull()))
    else:
        scored, cut = judged.withColumn("score", F.lit(None).cast("double")), 0.0
    by_url = scored.select(F.col("url").alias("_url"), "score")
    joined = rows.join(by_url, F.coalesce("url", F.lit("")) == F.col("_url"), "left")
    by_model = F.when(F.coalesce("score", F.lit(0.0)) >= cut, "allow").otherwise("block")
    return joined.select(
        "page_id", host.alias("host"), path.alias("path"), rule.alias("rule"),
        F.coalesce(verdict, by_model).alias("verdict"), "score",
    )
