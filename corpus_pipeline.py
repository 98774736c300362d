"""From raw documents to a training mix: five stages over whole tables.

A stage takes (spark, docs, sf_dir) and returns documents; its output is written
and read again as the next one's input. All but the last return the columns of
their input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm import benchmark, jaccard, lines, mixing, toxicity
from larder.llm.columns import content_key, same_key, text_of
from larder.llm.registry import prepare
from larder.sources.retail import read
from larder.sources.scratch import materialize


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones outside the held-out fold, does not reject."""
    prepare(spark)
    settings = toxicity.Settings()
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"), settings)
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), text_of(docs).alias("text"))
    scored = toxicity.score(rows, model, ["row"], "score")
    return scored.where(F.col("score") < settings.threshold).select(*[F.col("row")[c].alias(c) for c in docs.columns])


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of repeated runs of lines go; so does a document of which nothing is left."""
    prepare(spark)
    left = lines.deduped(docs).where((F.col("_lost") == 0) | F.col("_text").rlike(r"\S"))
    row = F.col("_row")
    new = {"text": F.col("_text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("_lost") > 0, F.length("_text")).otherwise(row["n_chars"]).cast(docs.schema["n_chars"].dataType)
    return left.select(*[new.get(c, row[c]).alias(c) for c in docs.columns])


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return jaccard.one_per_class(prepare(spark) and docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    prepare(spark)
    found = benchmark.matches(docs, read(spark, sf_dir, "benchmark")).select("_id", "_content").distinct()
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("_row"), *content_key(docs, text_of(docs)))
    return rows.join(found, same_key(rows, found), "left_anti").select(*[F.col("_row")[c].alias(c) for c in docs.columns])


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents drawn by calibrated probabilities, with their topic, tokens, probability and weight."""
    return mixing.mix(prepare(spark) and docs)


STAGES = [
    ("toxicity", without_toxic),
    ("line dedup", without_repeated_lines),
    ("n-gram Jaccard join", without_near_copies),
    ("benchmark decontamination", without_benchmark),
    ("mixing sources to target weights", mixed),
]

#: Training, near copies and latent retrieval are not SQL; tests/llm checks the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(prepare(spark), sf_dir.rstrip("/"), "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir.rstrip("/")), name.split()[0].lower())
    return docs
