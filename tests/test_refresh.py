"""Incremental refresh and audit entries."""

import json
import os

import pytest
from pyspark.sql import functions as F

from larder.operators.audit import audit_diff
from larder.sources import refresh, retail

SF_DIR = "/root/testdata/sf0.001"


def by_store_and_day(lines):
    return lines.groupBy("LocationID", "ShipDateID").agg(F.sum("Gross").alias("GrossSales"), F.count("*").alias("Lines"))


def files(path):
    return {f"{folder}/{name}": os.path.getmtime(f"{folder}/{name}") for folder, _, names in os.walk(path) for name in names if name.endswith(".parquet")}


def test_late_lines_rewrite_only_their_days(spark, tmp_path):
    path = str(tmp_path / "finance.DailySalesSummary")
    lines = retail.order_lines(spark, SF_DIR).where("ShipDateID < 5600")
    late = lines.where("ShipDateID IN (5500, 5511) AND OrderID % 2 = 0 OR ShipDateID = 5555")
    early = lines.join(late.select("OrderID", "LineNumber", "ShipDateID").distinct(), ["OrderID", "LineNumber", "ShipDateID"], "left_anti")
    assert late.count() > 0
    assert refresh.refresh(early, early, "ShipDateID", by_store_and_day, path)
    before = files(path)
    assert refresh.refresh(lines, late, "ShipDateID", by_store_and_day, path)
    after = files(path)
    touched = {"ShipDateID=5500", "ShipDateID=5511", "ShipDateID=5555"}
    moved = {f.split("/")[-2] for f in before.keys() ^ after.keys()}
    assert moved and moved <= touched
    assert all(after[f] == before[f] for f in before.keys() & after.keys())

    def rows():
        stored = spark.read.parquet(path)
        assert stored.count() == stored.select("LocationID", "ShipDateID").distinct().count()
        return sorted(tuple(r) for r in stored.select("LocationID", "ShipDateID", "GrossSales", "Lines").collect())

    want = sorted(tuple(r) for r in by_store_and_day(lines).select("LocationID", "ShipDateID", "GrossSales", "Lines").collect())
    assert rows() == want
    assert refresh.refresh(lines, late, "ShipDateID", by_store_and_day, path)
    assert rows() == want
    assert not refresh.refresh(lines, late.limit(0), "ShipDateID", by_store_and_day, path)
    with pytest.raises(ValueError, match="without ShipDateID"):
        refresh.refresh(lines, late.withColumn("ShipDateID", F.lit(None).cast("int")), "ShipDateID", by_store_and_day, path)


def test_one_hot_day_is_written_by_many_tasks(spark, tmp_path):
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "64k")
    try:
        rows = spark.range(0, 100_000, 1, 8).select("id", F.md5(F.col("id").cast("string")).alias("text"), F.lit(7).alias("Day"))
        refresh.overwrite_partitions(rows, str(tmp_path / "t"), "Day")
        assert len(files(tmp_path / "t")) > 1
    finally:
        spark.conf.set(size, before)


def test_audit_entries(spark):
    schema = "id long, a string, b int, extra int"
    before = spark.createDataFrame([(1, "x", 1, 0), (2, "y", None, 0), (3, 'q"z', 3, 0), (5, None, None, 0), (None, "n", 1, 0)], schema)
    after = spark.createDataFrame([(1, "x", 1), (2, "y", 2), (4, "w", None), (5, None, None), (None, None, 1)], "id long, a string, b int")
    got = {r["RecordID"]: r for r in audit_diff(before, after, "id", "t").collect()}
    seen = {k: (r["Action"], *(v and json.loads(v) for v in (r["OldValues"], r["NewValues"]))) for k, r in got.items()}
    assert seen == {
        2: ("UPDATE", {"b": None}, {"b": "2"}), 3: ("DELETE", {"a": 'q"z', "b": "3"}, None), 4: ("INSERT", None, {"a": "w", "b": None}),
        None: ("UPDATE", {"a": "n"}, {"a": None}),
    }
    assert audit_diff(after, after, "id", "t").count() == 0
    assert audit_diff(after.limit(0), after, "id", "t").count() == 5

