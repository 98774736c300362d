"""Audit log entries from two states of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def audit_diff(before: DataFrame, after: DataFrame, key: str, table: str) -> DataFrame:
    """What happened between two states: one row per inserted, deleted or changed record.

    ``OldValues`` and ``NewValues`` are JSON objects of strings: of all columns for a
    new or removed record, of the changed ones for an update. NULL is a value. ``key``
    identifies a record in each state; a key that occurs twice in one is an error of
    the table and gives a row per pair. The states meet in one full outer join, whose
    sides carry nothing but the shared columns.
    """
    names = [c for c in after.columns if c != key and c in before.columns]
    side = lambda df, name: df.select(
        F.col(key).alias(f"_{name}_key"), F.struct(*[F.col(c).cast("string").alias(c) for c in names]).alias(name)
    )
    pairs = side(before, "old").join(side(after, "new"), F.col("_old_key").eqNullSafe(F.col("_new_key")), "full_outer")
    old, new = F.col("old"), F.col("new")
    differs = [~old[c].eqNullSafe(new[c]) for c in names]
    action = F.when(old.isNull(), "INSERT").when(new.isNull(), "DELETE").otherwise("UPDATE")

    def json(values: Column) -> Column:
        entries = F.array(*[F.struct(d.alias("use"), F.lit(c).alias("name"), values[c].alias("value")) for c, d in zip(names, differs, strict=True)])
        used = F.filter(entries, lambda e: e["use"] | old.isNull() | new.isNull())
        return F.when(values.isNotNull(), F.to_json(F.map_from_entries(F.transform(used, lambda e: F.struct(e["name"], e["value"])))))

    changed = old.isNull() | new.isNull()
    for d in differs:
        changed = changed | d
    return pairs.where(changed).select(
        F.lit(table).alias("TableName"),
        F.coalesce("_new_key", "_old_key").alias("RecordID"),
        action.alias("Action"),
        json(old).alias("OldValues"),
        json(new).alias("NewValues"),
    )
