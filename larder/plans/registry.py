"""Registry of named queries and the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.session import tune

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    sql: str | None


QUERIES: dict[str, Query] = {}


def present(df: DataFrame) -> DataFrame:
    """Output form: exact amounts as DOUBLE, dates and times as ISO text."""
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            column = column.cast("string")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def query(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    """Register ``fn(spark, sf_dir)`` under ``name`` with its oracle SQL."""

    def add(fn: Run) -> Run:
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return present(fn(tune(spark), sf_dir.rstrip("/")))

        QUERIES[name] = Query(run, sql)
        return fn

    return add
