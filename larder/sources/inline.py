"""Small fixed tables written in the plan itself."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _literal(value: Any, kind: T.DataType) -> str:
    if value is None:
        return f"CAST(NULL AS {kind.simpleString()})"
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"CAST('{text}' AS {kind.simpleString()})"


def inline_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A local relation of known size: the planner may broadcast it, and no
    Python worker is needed to read it."""
    if spark is None:
        raise ValueError("SparkSession cannot be None")
    fields = T.DataType.fromDDL(schema).fields
    body = ", ".join(
        "(" + ", ".join(_literal(v, f.dataType) for v, f in zip(row, fields, strict=True)) + ")"
        for row in rows
    )
    names = ", ".join(f.name for f in fields)
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({names})")
