"""The operators over the whole given tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm import (
    ann,
    benchmark,
    jaccard,
    lines,
    mixing,
    packing,
    phrases,
    pii,
    quality,
    substrings,
    toxicity,
    urls,
    vectorcodes,
)
from larder.llm.registry import QUERIES, query
from larder.sources.retail import read

__all__ = ["QUERIES"]

VOCABULARY = "word_bpe_49k.json"


@query("op1_toxicity")
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query("op2_personal_data")
def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(read(spark, sf_dir, "documents"))


@query("op3_substring_dedup")
def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.substring_dedup(read(spark, sf_dir, "documents")).drop("kept")


@query("op4_nearest")
def op4_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(read(spark, sf_dir, "embeddings"))


@query("op5_jaccard_join", jaccard.SQL)
def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_join(read(spark, sf_dir, "documents"))


@query("op6_url_filter")
def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(read(spark, sf_dir, "pages")).drop("score")


@query("op7_line_dedup", lines.SQL)
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_dedup(read(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_removed", "text")


@query("op8_decontamination")
def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = benchmark.decontaminate(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "leaked", "leaked_item", "leaked_overlap", "leaked_items")


@query("op9_quality")
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query("op10_mixing", mixing.mix_sql())
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = mixing.mix(read(spark, sf_dir, "documents"))
    names = {"mix_topic": "topic", "mix_tokens": "tokens", "mix_probability": "probability", "mix_weight": "weight"}
    return drawn.select("doc_id", "source", "lang", *[F.col(old).alias(new) for old, new in names.items()])


@query("op11_phrases", phrases.sql())
def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.phrases(read(spark, sf_dir, "documents"))


@query("op12_vector_codes", vectorcodes.sql())
def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectorcodes.encode(read(spark, sf_dir, "embeddings"))


@query("op13_packing")
def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    settings = packing.Settings(public_tokenizers.path(VOCABULARY))
    return packing.pack_documents(read(spark, sf_dir, "documents"), settings)
