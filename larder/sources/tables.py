"""Parquet tables: location, guarded reading and writing, empty and seeded tables."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from larder.catalog import schemas

logger = logging.getLogger(__name__)


def table_path(root: str, table: str) -> str:
    """Folder of one table: ``{root}/{schema}.{Table}``, one folder per table."""
    check_output_path(root)
    return f"{root.rstrip('/')}/{table}"


def check_output_path(path: str) -> None:
    if not isinstance(path, str) or not path.strip():
        raise ValueError("Path must be a non-empty string")


def check_columns(df: DataFrame, expected: Sequence[str]) -> bool:
    """True when every expected column exists, else ValueError naming the rest."""
    missing = sorted(set(expected) - set(df.columns))
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
    return True


def write_parquet(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: str | Sequence[str] | None = None,
    allow_empty: bool = False,
) -> None:
    """Write ``df`` as Parquet, optionally in ``column=value`` folders.

    A partitioned write is rebalanced on the partition columns first: each
    folder gets a few files of even size instead of one file per task, and a
    value that holds a large share of the rows is still split over many tasks.
    """
    if df is None:
        raise ValueError("DataFrame cannot be None")
    if not isinstance(df, DataFrame):
        raise TypeError("df must be a PySpark DataFrame")
    check_output_path(path)
    if partition_by is None:
        columns = []
    elif isinstance(partition_by, str):
        columns = [partition_by]
    elif isinstance(partition_by, (list, tuple)) and all(isinstance(c, str) for c in partition_by):
        columns = list(partition_by)
    else:
        raise ValueError("partition_by must be a string or a list of strings")
    if not allow_empty and df.isEmpty():
        raise ValueError("DataFrame is empty")
    if columns:
        check_columns(df, columns)
        df = df.hint("rebalance", *columns)
    writer = df.write.mode(mode)
    if columns:
        writer = writer.partitionBy(*columns)
    writer.parquet(path)
    logger.info("wrote %s", path)


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists, asked of the file system that owns it."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(target))


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    return spark.read.parquet(table_path(root, table))


def read_or_seed(
    spark: SparkSession, root: str, table: str, seed: Callable[[], DataFrame]
) -> DataFrame:
    """The stored table, or the seed written in its place when there is none.

    Only absence leads to seeding; any other failure to read is raised.
    """
    path = table_path(root, table)
    if not table_exists(spark, path):
        write_parquet(seed(), path, mode="errorifexists")
    return spark.read.parquet(path)


def empty_table(spark: SparkSession, table: str) -> DataFrame:
    """An empty DataFrame with the catalogued columns of ``table``."""
    return spark.createDataFrame([], schemas.struct_type(table))
