"""Mixing: token weights raked to source, language and topic marginals, then sampled.

Iterative proportional fitting works on the table of cells (source, language,
topic), whose token sums come from all documents: margin after margin, the
weights of the cells are scaled so that the margin's sums meet their targets. A
target is given, or the margin's natural share raised to a power below one,
which lifts the small ones. A document is kept with probability min(1, c w),
where c makes the expected tokens the wanted part of all; what the cap cuts off
remains as the weight of the document, at least one.

A text without a topic of its own gets one by form (``topic_of``). Tokens are
spaces plus one, none for an empty text. The draw is a hash of the id, so it is
the same on every run and whatever the partitions.

Cases: null source, language or topic is the value ``unknown``; null text has no
tokens; a margin value without tokens leaves its cells as they are; a table
without tokens is kept whole; rows with the same id share their draw; a column of the
documents with the name of a column made here is replaced.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.columns import others, text_of
from larder.sources.scratch import materialize

MARGINS = ("source", "lang", "topic")
#: A scale that grows by no more than this part has settled.
SETTLED = 1e-12
MADE = ("mix_topic", "mix_tokens", "mix_probability", "mix_weight")


@dataclass(frozen=True)
class Settings:
    """targets: for a margin, the wanted share of each value; otherwise powers apply.

    Raking ends with the first round whose factors are all within ``tolerance`` of one;
    ``rounds`` only bounds margins that contradict each other, which ``margins`` shows.
    """

    powers: dict[str, float] = field(default_factory=lambda: {"source": 0.7, "lang": 0.5, "topic": 0.7})
    targets: dict[str, dict[str, float]] = field(default_factory=dict)
    tolerance: float = 1e-6
    rounds: int = 100
    keep: float = 0.6


def topic_of(text: Column) -> Column:
    return (
        F.when(text.contains("License"), "legal").when(text.contains("@"), "contact").when(text.contains(" | "), "table")
        .when(text.contains("!!"), "shout").when(F.length(text) < 400, "note").otherwise("prose")
    )


def tokens_of(text: Column) -> Column:
    return F.when(text == "", 0).otherwise(F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit(""))) + 1).cast("long")


def draw_of(doc_id: Column) -> Column:
    """A number in [0, 1) from the id."""
    digest = F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / float(16**13)


def _natural(cells: DataFrame, margin: str, settings: Settings) -> DataFrame:
    """(margin, _share): the wanted part of all tokens for each value that has tokens."""
    sums = cells.groupBy(margin).agg(F.sum("tokens").alias("_sum")).where("_sum > 0")
    if margin in settings.targets:
        given = F.create_map(*[F.lit(x) for pair in settings.targets[margin].items() for x in pair])
        sums = sums.withColumn("_want", F.coalesce(F.try_element_at(given, F.col(margin)), F.lit(0.0)))
    else:
        sums = sums.withColumn("_want", F.pow(F.col("_sum").cast("double"), F.lit(settings.powers[margin])))
    whole = sums.agg(F.sum("_want")).first()[0] or 1.0
    return sums.select(margin, (F.col("_want") / whole).alias("_share"))


def rake(cells: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The cells with the wanted share of each of their values and ``weight``: the factor of their tokens that meets the margins.

    One number comes to the driver each round. A margin's sums are taken over the
    cells, of which there is one for each combination of values, whatever the number of documents.
    """
    total = float(cells.agg(F.sum("tokens")).first()[0] or 0)
    shared = cells
    for m in MARGINS:
        shared = shared.join(_natural(cells, m, settings).withColumnRenamed("_share", f"_{m}"), m, "left")
    weighted = materialize(shared.withColumn("weight", F.lit(1.0)), "shares")
    for _ in range(settings.rounds):
        step = weighted.withColumn("_moved", F.lit(0.0))
        for m in MARGINS:
            now = F.sum(F.col("tokens") * F.col("weight")).over(Window.partitionBy(m))
            step = step.withColumn("_factor", F.when(now > 0, F.col(f"_{m}") * total / now)).withColumn("_factor", F.coalesce("_factor", F.lit(1.0)))
            step = step.withColumn("weight", F.col("weight") * F.col("_factor"))
            step = step.withColumn("_moved", F.greatest("_moved", F.abs(F.col("_factor") - 1)))
        step = materialize(step.drop("_factor"), "raked")
        weighted = step.drop("_moved")
        if (step.agg(F.max("_moved")).first()[0] or 0.0) <= settings.tolerance:
            break
    return weighted


def margins(raked: DataFrame) -> DataFrame:
    """(margin, value, wanted, got): the share of the weighted tokens that each value was to have, and has."""
    whole = raked.agg(F.sum(F.col("tokens") * F.col("weight"))).first()[0] or 1.0
    each = F.inline(F.array(*[F.struct(F.lit(m).alias("margin"), F.col(m).alias("value"), F.col(f"_{m}").alias("wanted")) for m in MARGINS]))
    return (
        raked.select(each, (F.col("tokens") * F.col("weight") / whole).alias("_part"))
        .groupBy("margin", "value").agg(F.coalesce(F.max("wanted"), F.lit(0.0)).alias("wanted"), F.sum("_part").alias("got"))
    )


def scale_of(raked: DataFrame, keep: float) -> float:
    """c such that min(1, c w) keeps the part ``keep`` of all tokens; one row comes to the driver each round.

    Each round caps at least one more cell or is the last.
    """
    total = float(raked.agg(F.sum("tokens")).first()[0] or 0)
    if not total:
        return float("inf")
    c = 0.0
    while True:
        capped = F.col("weight") * F.lit(c) >= 1
        row = raked.agg(
            F.sum(F.when(capped, F.col("tokens")).otherwise(0)).cast("double").alias("full"),
            F.sum(F.when(capped, 0.0).otherwise(F.col("tokens") * F.col("weight"))).alias("rest"),
        ).first()
        if not row["rest"]:
            return c
        before, c = c, (keep * total - row["full"]) / row["rest"]
        if c <= before * (1 + SETTLED):
            return c


def cells_of(docs: DataFrame, topic: str | None = None) -> DataFrame:
    """The margins and tokens of every document as columns _source, _lang, _topic and _tokens, beside its own row."""
    text = text_of(docs)
    kind = docs[f"`{topic}`"].cast("string") if topic else topic_of(text)
    unknown = lambda c: F.coalesce(c, F.lit("unknown"))
    return docs.select(
        F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("_row"),
        unknown(docs["source"].cast("string")).alias("source"), unknown(docs["lang"].cast("string")).alias("lang"),
        unknown(kind).alias("topic"), tokens_of(text).alias("tokens"), draw_of(docs["doc_id"]).alias("_draw"),
    )


def mix(docs: DataFrame, settings: Settings = Settings(), topic: str | None = None) -> DataFrame:
    """The documents drawn, with mix_topic, mix_tokens, mix_probability and mix_weight."""
    rows = cells_of(docs, topic)
    cells = materialize(rows.groupBy(*MARGINS).agg(F.sum("tokens").alias("tokens")), "cells")
    raked = rake(cells, settings)
    c = scale_of(raked, settings.keep)
    odds = F.lit(1.0) if c == float("inf") else F.col("weight") * F.lit(c)
    plan = raked.select(*MARGINS, F.least(odds, F.lit(1.0)).alias("_p"), F.greatest(odds, F.lit(1.0)).alias("_over"))
    chosen = rows.join(plan, list(MARGINS)).where("_draw < _p")
    return chosen.select(
        *[F.col("_row")[name].alias(name) for name in others(docs, MADE)], F.col("topic").alias("mix_topic"),
        F.col("tokens").alias("mix_tokens"), F.round("_p", 6).alias("mix_probability"), F.round("_over", 6).alias("mix_weight"),
    )


def mix_sql(documents: str = "documents", settings: Settings = Settings()) -> str:
    """The same as SQL, without the other columns; fit for the default targets."""
    steps = [f"""rows AS MATERIALIZED (
  SELECT doc_id, coalesce(source, 'unknown') AS source, coalesce(lang, 'unknown') AS lang,
         CASE WHEN text LIKE '%License%' THEN 'legal' WHEN text LIKE '%@%' THEN 'contact'
              WHEN text LIKE '% | %' THEN 'table' WHEN text LIKE '%!!%' THEN 'shout'
              WHEN length(text) < 400 THEN 'note' ELSE 'prose' END AS topic,
         CASE WHEN text = '' THEN 0 ELSE length(text) - length(replace(text, ' ', '')) + 1 END AS tokens,
         CAST(CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) AS DOUBLE) / {16**13}.0 AS draw
  FROM (SELECT doc_id, source, lang, coalesce(text, '') AS text FROM {documents}))""",
        "total AS MATERIALIZED (SELECT CAST(sum(tokens) AS DOUBLE) AS t FROM rows)",
        """cells AS MATERIALIZED (SELECT source, lang, topic, CAST(sum(tokens) AS DOUBLE) AS tokens, CAST(1 AS DOUBLE) AS weight
  FROM rows GROUP BY ALL)"""]
    for m in MARGINS:
        steps.append(f"""{m}_share AS MATERIALIZED (
  SELECT {m}, pow(s, {settings.powers[m]}) / sum(pow(s, {settings.powers[m]})) OVER () AS share
  FROM (SELECT {m}, sum(tokens) AS s FROM cells GROUP BY {m}) WHERE s > 0)""")
    shares = ", ".join(f"{m}_share.share AS {m}_share" for m in MARGINS)
    joins = " ".join(f"LEFT JOIN {m}_share USING ({m})" for m in MARGINS)
    steps.append(f"""w0 AS MATERIALIZED (
  SELECT w.source, w.lang, w.topic, tokens, t, {shares}, weight, CAST(1 AS DOUBLE) AS moved, 0 AS n FROM total, cells w {joins})""")
    inner = "(SELECT *, CAST(0 AS DOUBLE) AS worst FROM raking)"
    for m in MARGINS:
        inner = f"""(
    SELECT * EXCLUDE (factor, now) REPLACE (weight * factor AS weight, greatest(worst, abs(factor - 1)) AS worst) FROM (
      SELECT *, coalesce(CASE WHEN now > 0 THEN {m}_share * t / now END, 1) AS factor FROM (
        SELECT *, sum(tokens * weight) OVER (PARTITION BY {m}) AS now FROM {inner})))"""
    steps.append(f"""raking AS (
  SELECT * FROM w0
  UNION ALL
  SELECT source, lang, topic, tokens, t, source_share, lang_share, topic_share, weight, max(worst) OVER () AS moved, n + 1 AS n
  FROM {inner} WHERE moved > {settings.tolerance} AND n < {settings.rounds})""")
    steps.append("raked AS MATERIALIZED (SELECT * FROM raking WHERE n = (SELECT max(n) FROM raking))")
    steps.append(f"""scaling AS (
  SELECT CAST(0 AS DOUBLE) AS c, CAST(-1 AS DOUBLE) AS before
  UNION ALL
  SELECT ({settings.keep} * any_value(t) - sum(CASE WHEN weight * c >= 1 THEN tokens ELSE 0 END))
           / sum(CASE WHEN weight * c >= 1 THEN 0 ELSE tokens * weight END), any_value(c)
  FROM scaling, raked WHERE before < 0 OR c > before * (1 + {SETTLED})
  HAVING sum(CASE WHEN weight * c >= 1 THEN 0 ELSE tokens * weight END) > 0)""")
    steps.append("scale AS MATERIALIZED (SELECT max_by(c, before) AS c FROM scaling)")
    return "WITH RECURSIVE " + ",\n".join(steps) + f"""
SELECT doc_id, source, lang, topic, tokens, round(least(weight * c, 1), 6) AS probability, round(greatest(weight * c, 1), 6) AS weight
FROM (SELECT r.*, w.weight FROM rows r JOIN raked w USING (source, lang, topic)), scale
WHERE draw < least(weight * c, 1)"""
