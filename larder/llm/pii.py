"""Personal data: base formats, and wider candidates chosen by boosted trees.

Base spans follow fixed formats with their checks (Luhn, number ranges, digit
counts) and always stay. High-recall generators propose further spans, often
overlapping the base ones: spelled-out addresses, bracketed dots, phone numbers
without a country code, grouped card numbers. A candidate that overlaps a base
span of its kind is a positive example; one that fails the checks of its kind or
overlaps a span of another kind is wrong and never added; all others are open,
as some are real. Gradient boosted trees learn to tell positive examples from
the rest by format and context, which ranks open candidates by how much they
look like the positive ones. What gives a base span away is masked first: the
country code before it, and the signs that stand for ``@``, dots and hyphens.
Features are small whole numbers, so the training table is the count of every
distinct feature vector over all documents.

On a fold of the documents the trees have not seen, real spans are taken to
stand beside base spans in the same ratio at every score. That ratio is the
smallest one of open candidates to base spans among the best scores that hold
at least ``half`` of the base spans; open candidates beyond it are look-alikes.
Each kind gets the lowest score of a base span at which open candidates are
real often enough; those that reach it and touch no base span are added.

Everything runs as columns of one row, so no document is shuffled: matches and
the pieces between them come from the same pattern, positions are prefix sums
of their lengths, and the fitted trees become a CASE expression.

Patterns are written so that no run of characters is scanned twice: a match
starts where the last one ended or at the beginning of a run, which are the
only places where a leftmost match can start.

Cases: a null text is empty; no spans give an empty list and the hash of the
empty text; repeated rows each get their spans; without both positive and
negative candidates nothing is added. Offsets count code points, ends excluded.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.columns import text_of
from larder.sources.scratch import materialize

KINDS = ("email", "ip", "card", "phone")
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}+",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
WIDE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?:@|\x20?[(\[]at[)\]]\x20?)[A-Za-z0-9-]++"
    r"(?:(?:\.|\x20?[(\[]dot[)\]]\x20?)[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9.])[0-9]{1,3}+(?:(?:\.|\[\.\]|\(\.\))[0-9]{1,3}+){3}+(?![0-9])",
    "card": r"(?<![0-9])[0-9]{4}(?:[\x20.-]?[0-9]{4}){2}[\x20.-]?[0-9]{1,7}+",
    "phone": r"(?<![0-9])(?:\([0-9]{3}\)|[0-9]{3})[\x20./-]{0,2}[0-9]{3}[\x20./-][0-9]{4}(?![0-9])",
}
CUES = {
    "email": r"(?i)mail|contact|write",
    "ip": r"(?i)\bip\b|host|server|address",
    "card": r"(?i)card|visa|credit|pay",
    "phone": r"(?i)phone|call|tel|mobile|fax",
}
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
IN_RANGE = rf"^{_PART}(?:\.{_PART}){{3}}$"
FEATURES = ("kind", "digits", "groups", "separator", "paren", "luhn", "range", "before", "after", "cue", "length")


@dataclass(frozen=True)
class Settings:
    trees: int = 8
    depth: int = 3
    precision: float = 0.95
    half: float = 0.5
    folds: int = 5


@dataclass
class Model:
    """Trees as SQL over a struct named c, and the threshold of each kind."""

    score: str | None = None
    thresholds: dict[str, float] = field(default_factory=dict)


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a text of 12 to 19 digits passes the Luhn check; false for other lengths."""
    backwards = F.split(F.reverse(digits), "")

    def add(total: Column, at: Column) -> Column:
        digit = F.get(backwards, at).cast("int")
        twice = F.when(at % 2 == 1, digit * 2).otherwise(digit)
        return total + F.when(twice > 9, twice - 9).otherwise(twice)

    total = F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add)
    return F.when(F.length(digits).between(12, 19), total % 10 == 0).otherwise(False)


def _located(rows: DataFrame, name: str, pattern: str, useful: Column) -> DataFrame:
    """Adds ``name``: an array of (value, start, end, before, after) of the matches of a pattern in ``_text``."""
    none = F.array().cast("array<string>")
    rows = rows.withColumns({
        "_m": F.when(useful, F.regexp_extract_all("_text", F.lit(pattern), F.lit(0))).otherwise(none),
        "_p": F.when(useful, F.split("_text", pattern, -1)).otherwise(none),
    })
    rows = rows.withColumn("_l", F.transform("_m", lambda m, i: F.length(F.get("_p", i)) + F.length(m)))
    rows = rows.withColumn("_b", F.ceil(F.sqrt(F.size("_l") + 1)).cast("int"))
    total = lambda part: F.aggregate(part, F.lit(0), lambda a, x: a + x)
    blocks = F.sequence(F.lit(0), F.floor(F.size("_l") / F.col("_b")).cast("int"))
    # prefix sums in blocks: n matches cost n ** 1.5 steps and not n ** 2
    rows = rows.withColumn("_s", F.transform(blocks, lambda b: total(F.slice("_l", b * F.col("_b") + 1, F.col("_b")))))
    rows = rows.withColumn("_t", F.transform("_s", lambda _, b: total(F.slice("_s", F.lit(1), b))))
    rows = rows.withColumn("_e", F.transform(
        "_l",
        lambda x, i: F.get("_t", F.floor(i / F.col("_b")).cast("int"))
        + total(F.slice("_l", (i - i % F.col("_b") + 1).cast("int"), (i % F.col("_b") + 1).cast("int"))),
    ))
    found = F.transform("_m", lambda m, i: F.struct(
        m.alias("value"), (F.get("_e", i) - F.length(m)).alias("start"), F.get("_e", i).alias("end"),
        F.right(F.get("_p", i), F.lit(24)).alias("before"), F.left(F.get("_p", i + 1), F.lit(1)).alias("after"),
    ))
    return rows.withColumn(name, found).drop("_m", "_p", "_l", "_b", "_s", "_t", "_e")


def _passes(kind: str, value: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return value.rlike(IN_RANGE)
    if kind == "card":
        return luhn(digits_of(value))
    return F.length(digits_of(value)).between(9, 15)


def _check(kind: str) -> Callable[[Column], Column]:
    return lambda match: _passes(kind, match["value"])


def with_base(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``_text`` and an array column of base spans for each kind, beside ``keep``."""
    rows = docs.select(*[docs[f"`{c}`"] for c in keep], text_of(docs).alias("_text"))
    rows = rows.withColumns({"_at": F.col("_text").contains("@"), "_digit": F.col("_text").rlike("[0-9]")})
    for kind in KINDS:
        useful = F.col("_at") if kind == "email" else F.col("_digit")
        if kind == "phone":
            useful = useful & F.col("_text").contains("+")
        rows = _located(rows, f"_base_{kind}", BASE[kind], useful)
        rows = rows.withColumn(f"_base_{kind}", F.filter(f"_base_{kind}", _check(kind)))
    return rows


def _side(char: Column) -> Column:
    """0 for nothing or a space, 1 letter, 2 digit, 3 plus, 4 anything else."""
    return (
        F.when(F.coalesce(char, F.lit("")).rlike(r"^\s?$"), 0).when(char.rlike(r"^\p{L}$"), 1)
        .when(char.rlike("^[0-9]$"), 2).when(char == "+", 3).otherwise(4)
    )


def _separator(value: Column) -> Column:
    """0 none, 1 space, 2 dot, 3 hyphen, 4 several kinds or others."""
    signs = F.regexp_replace(value, r"[A-Za-z0-9@()]", "")
    return (
        F.when(signs == "", 0).when(signs.rlike("^ +$"), 1).when(signs.rlike(r"^\.+$"), 2)
        .when(signs.rlike("^-+$"), 3).otherwise(4)
    )


def _masked(kind: str, m: Column) -> tuple[Column, Column]:
    """The value as the base format spells it, and the text before it without a country code."""
    value, before = m["value"], m["before"]
    if kind == "email":
        value = F.regexp_replace(value, r"\x20?[(\[]at[)\]]\x20?", "@")
        value = F.regexp_replace(value, r"\x20?[(\[]dot[)\]]\x20?", ".")
    elif kind == "ip":
        value = F.regexp_replace(value, r"[\[\]()]", "")
    elif kind == "card":
        value = F.regexp_replace(value, r"\.", "-")
    else:
        before = F.regexp_replace(before, r"\+[0-9]{0,3}[\x20().-]*$", "")
    return value, before


def _described(kind: str) -> Callable[[Column], Column]:
    """A match as a candidate: its span, its features and whether it overlaps base spans."""

    def describe(m: Column) -> Column:
        value, before = _masked(kind, m)
        digits = digits_of(value)
        inside = lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"])
        covered = F.lit(False)
        for other in KINDS:
            covered = covered | F.exists(f"_base_{other}", inside)
        return F.struct(
            m["start"].alias("start"), m["end"].alias("end"),
            F.exists(f"_base_{kind}", inside).alias("positive"), (~covered & _passes(kind, value)).alias("open"),
            F.lit(KINDS.index(kind)).alias("kind"), F.least(F.length(digits), F.lit(24)).alias("digits"),
            F.least(F.size(F.split(value, "[^A-Za-z0-9]+")), F.lit(9)).alias("groups"),
            _separator(value).alias("separator"), value.contains("(").cast("int").alias("paren"),
            luhn(digits).cast("int").alias("luhn"), value.rlike(IN_RANGE).cast("int").alias("range"),
            _side(F.right(before, F.lit(1))).alias("before"), _side(m["after"]).alias("after"),
            before.rlike(CUES[kind]).cast("int").alias("cue"),
            F.least(F.length(value) / 4, F.lit(12)).cast("int").alias("length"),
        )

    return describe


def with_candidates(rows: DataFrame) -> DataFrame:
    """Adds ``_wide``: candidates of all kinds with their features, and whether they overlap base spans."""
    names = []
    for kind in KINDS:
        useful = F.col("_digit") | F.col("_at")
        if kind == "email":
            useful = F.col("_at") | F.col("_text").contains("at)") | F.col("_text").contains("at]")
        rows = _located(rows, f"_wide_{kind}", WIDE[kind], useful)

        rows = rows.withColumn(f"_wide_{kind}", F.transform(f"_wide_{kind}", _described(kind)))
        names.append(f"_wide_{kind}")
    return rows.withColumn("_wide", F.concat(*names)).drop(*names)


def _tree_sql(node) -> str:
    """A tree as CASE over the fields of c."""
    if node.getClass().getSimpleName() == "LeafNode":
        return f"{float(node.prediction())!r}D"
    split = node.split()
    test = f"c.{FEATURES[split.featureIndex()]} <= {float(split.threshold())!r}D"
    return f"CASE WHEN {test} THEN {_tree_sql(node.leftChild())} ELSE {_tree_sql(node.rightChild())} END"


def fit(docs: DataFrame, settings: Settings = Settings()) -> Model:
    """Boosted trees over the counts of all feature vectors, and thresholds from the fold left out."""
    s = settings
    rows = with_candidates(with_base(docs, ["doc_id"]))
    fold = (F.pmod(F.xxhash64(F.col("doc_id").cast("long"), F.lit(2)), F.lit(s.folds)) == 0).alias("calibrate")
    # as one text per candidate: nested fields of the exploded rows would be pruned through every expression above
    seen = F.transform("_wide", lambda c: F.concat_ws(",", F.when(c["positive"], 1).when(c["open"], 2).otherwise(0), *[c[f] for f in FEATURES]))
    told = rows.select(fold, F.explode(seen).alias("seen")).groupBy("calibrate", "seen").agg(F.count("*").alias("n"))
    value = lambda i: F.split("seen", ",")[i].cast("int")
    counted = materialize(
        told.select("calibrate", "n", value(0).alias("positive"), *[value(i + 1).alias(f) for i, f in enumerate(FEATURES)])
        .groupBy("calibrate", *FEATURES)
        .agg(*[F.sum(F.expr(f"if(positive = {k}, n, 0)")).alias(name) for name, k in (("yes", 1), ("no", 0), ("open", 2))]),
        "candidates",
    )
    halves = [counted.select("calibrate", *FEATURES, F.lit(label).cast("double").alias("label"), weight.cast("double").alias("weight")) for weight, label in ((F.col("yes"), 1.0), (F.col("no") + F.col("open"), 0.0))]
    train = halves[0].unionByName(halves[1]).where("weight > 0 and not calibrate")
    if train.select("label").distinct().count() < 2:
        return Model()
    assembled = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(train)
    fitted = GBTClassifier(featuresCol="features", labelCol="label", weightCol="weight", maxIter=s.trees, maxDepth=s.depth, seed=7).fit(assembled)
    terms = [f"{float(w)!r}D * {_tree_sql(t._call_java('rootNode'))}" for t, w in zip(fitted.trees, fitted.treeWeights, strict=True)]
    score = f"1D / (1D + exp(-2D * ({' + '.join(terms)})))"
    flat = counted.where("calibrate").withColumn("c", F.struct(*FEATURES))
    # at most one row per kind and thousandth
    bins = (
        flat.groupBy("kind", F.floor(F.expr(score) * 1000).alias("bin")).agg(F.sum("yes").alias("yes"), F.sum("open").alias("open"))
        .orderBy(F.desc("bin")).collect()
    )
    thresholds = {}
    for n, kind in enumerate(KINDS):
        limit = threshold([(r["bin"], r["yes"], r["open"]) for r in bins if r["kind"] == n], s)
        if limit is not None:
            thresholds[kind] = limit / 1000
    return Model(score, thresholds)


def threshold(bins: list[tuple[int, int, int]], s: Settings) -> int | None:
    """The bin down to which open candidates are added, from (bin, base spans, open candidates), best bin first."""
    whole = sum(yes for _, yes, _ in bins)
    sums, yes, unknown = [], 0, 0
    for at, more, others in bins:
        yes, unknown = yes + more, unknown + others
        if more:
            sums.append((at, yes, unknown))
    if not sums:
        return None
    ratio = min(unknown / yes for _, yes, unknown in sums if yes >= s.half * whole)
    # two standard errors, for few candidates
    fits = [at for at, yes, unknown in sums if s.precision * (unknown - 2 * (unknown + 1) ** 0.5) <= ratio * yes]
    return min(fits, default=None)


def _listed(spans: Column) -> Column:
    """kind:start:end by start, then kind, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ","
    )


def find(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """``keep``, the text, the counts, the base spans and all spans as arrays of (start, kind, end)."""
    rows = with_base(docs, keep)
    
    def as_spans(column: str, n: int) -> Column:
        return F.transform(column, lambda m: F.struct(m["start"].alias("start"), F.lit(n).alias("kind"), m["end"].alias("end")))

    base = F.concat(*[as_spans(f"_base_{k}", n) for n, k in enumerate(KINDS)])
    if model.score and model.thresholds:
        rows = with_candidates(rows)
        limit = "CASE c.kind " + " ".join(f"WHEN {KINDS.index(k)} THEN {t!r}D" for k, t in model.thresholds.items()) + " ELSE 2D END"
        chosen = F.expr(f"filter(_wide, c -> c.open AND {model.score} >= {limit})")
        added = F.transform(chosen, lambda c: F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end")))
    else:
        added = F.slice(base, 1, 0)
    rows = rows.withColumns({"_base": base, "_added": added})
    return rows.select(
        *keep, "_text", *[F.size(f"_base_{k}").cast("long").alias(f"n_{k}") for k in KINDS],
        F.col("_base").alias("base"), F.array_sort(F.concat("_base", "_added")).alias("spans"),
    )


def redact(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and the text with every span replaced by its kind in angle brackets; of overlapping spans the first counts."""
    found = find(docs, model, ["doc_id"])
    names = F.array(*[F.lit(f"<{k}>") for k in KINDS])
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(done: Column, s: Column) -> Column:
        out = F.concat(done["out"], F.substring(F.col("_text"), done["at"] + 1, s["start"] - done["at"]), F.get(names, s["kind"]))
        return F.when(s["start"] >= done["at"], F.struct(s["end"].alias("at"), out.alias("out"))).otherwise(done)

    done = F.aggregate("spans", start, step)
    return found.withColumn("_done", done).select(
        "doc_id", F.concat("_done.out", F.substring("_text", F.col("_done.at") + 1, F.length("_text"))).alias("text")
    )


def personal_data(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, the counts of base spans, the hash of their list, and the list of all spans."""
    found = find(docs, fit(docs, settings), ["doc_id"])
    return found.select(
        F.col("doc_id").cast("long").alias("doc_id"), *[f"n_{k}" for k in KINDS],
        F.sha2(_listed(F.col("base")), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"),
    )
