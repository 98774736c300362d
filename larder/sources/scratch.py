"""Intermediate tables that cut lineage and survive the loss of executors."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_dir: str | None = None
_written: list[str] = []


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a session whose driver and executors are one process falls back to a
    local folder, deleted at its end; elsewhere it would be lost with its machine.
    """
    global _local_dir
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not re.match(r"local($|\[)", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if _local_dir is None:
        _local_dir = tempfile.mkdtemp(prefix="larder-")
        atexit.register(shutil.rmtree, _local_dir, ignore_errors=True)
    return _local_dir


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path under the scratch folder that nobody else uses."""
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def drop_scratch(spark: SparkSession) -> int:
    """Delete the scratch tables this process made; returns how many there were.

    Call it when no DataFrame that reads them is needed any more.
    """
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    dropped = 0
    while _written:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_written.pop())
        dropped += bool(path.getFileSystem(hadoop).delete(path, True))
    return dropped


def materialize(df: DataFrame, label: str, files: int | None = None) -> DataFrame:
    """Write ``df`` to a scratch Parquet table, of at most ``files`` files, and read it back.

    What depends on row placement (partition numbers, generated ids) is fixed
    by the write, so every later reader sees the same values, and a lost
    executor costs a re-read rather than a recomputation of the lineage.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    (df.coalesce(files) if files else df).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
