"""Incremental refresh: late facts rewrite only the partitions they touch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from larder.sources.tables import check_columns, check_output_path, table_exists


def overwrite_partitions(df: DataFrame, path: str, partition_by: str) -> None:
    """Replace the partitions that ``df`` holds rows of, and leave all others as they are.

    Written twice, the same rows give the same table. Rows are rebalanced on the
    partition column, so a partition with most of them is written by many tasks.
    """
    check_output_path(path)
    check_columns(df, [partition_by])
    writer = df.hint("rebalance", partition_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(partition_by).parquet(path)


def refresh(facts: DataFrame, late: DataFrame, column: str, summarize: Callable[[DataFrame], DataFrame], path: str) -> bool:
    """Bring the summary at ``path``, partitioned by ``column``, up to date with ``late`` rows of ``facts``.

    ``facts`` already holds the late rows. Only facts of the days (or whatever
    ``column`` counts) on which late rows fall are summarized again; a filter on the
    facts' own partitions, if they have some, follows from the join. Every such day
    has a row in ``facts``, so none keeps a stale summary. Without a table at ``path``
    everything is summarized. Late rows without a ``column`` are an error, as no
    partition could be named for them. Returns whether anything was written.
    """
    if not table_exists(facts.sparkSession, path):
        overwrite_partitions(summarize(facts), path, column)
        return True
    dirty = late.select(column).distinct()
    if not dirty.where(dirty[column].isNull()).isEmpty():
        raise ValueError(f"late rows without {column}")
    if dirty.isEmpty():
        return False
    overwrite_partitions(summarize(facts.join(dirty, column, "left_semi")), path, column)
    return True
