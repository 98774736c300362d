"""Column helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def text_of(docs: DataFrame, name: str = "text") -> Column:
    """The text as a string, empty where it is null."""
    return F.coalesce(docs[f"`{name}`"].cast("string"), F.lit(""))


def others(docs: DataFrame, made: tuple[str, ...]) -> list[str]:
    """The columns of ``docs`` whose names no column made by an operator takes; names are alike in any case of letters."""
    taken = {name.lower() for name in made}
    return [name for name in docs.columns if name.lower() not in taken]


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text modulo ``folds``; -1 for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds, F.lit(-1))


def content_key(docs: DataFrame, text: Column) -> list[Column]:
    """What identifies a document: its id and a hash of its text.

    Rows equal in both are the same document repeated, and share every result.
    """
    return [docs["doc_id"].cast("long").alias("_id"), F.xxhash64(text).alias("_content")]


def same_key(left: DataFrame, right: DataFrame) -> Column:
    """Equality of the keys of ``content_key``, null ids included."""
    return left["_id"].eqNullSafe(right["_id"]) & (left["_content"] == right["_content"])
