"""Registry of the named queries of these operators."""

from __future__ import annotations

import os
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from larder.session import tune

Run = Callable[[SparkSession, str], DataFrame]
# rows of whole texts that a Python worker and its executor hold at once
BATCH_ROWS = "1000"
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@dataclass(frozen=True)
class Query:
    run: Run
    sql: str | None


QUERIES: dict[str, Query] = {}


def prepare(spark: SparkSession) -> SparkSession:
    """The runtime settings, and this package on the path of the Python workers.

    On a cluster whose machines do not have the package, pass it with --py-files.
    """
    path = spark.sparkContext.environment.get("PYTHONPATH", "")
    if ROOT not in path.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(x for x in (ROOT, path) if x)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return tune(spark)


def query(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    """Register ``fn(spark, sf_dir)`` under ``name`` with its SQL, if SQL can express it."""

    def add(fn: Run) -> Run:
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = Query(lambda spark, sf_dir: fn(prepare(spark), sf_dir.rstrip("/")), sql)
        return fn

    return add
