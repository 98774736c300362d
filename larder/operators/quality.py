"""Data-quality checks; most return one row per rule with a count of violations."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.catalog import constraints, schemas

# Formats of coded columns.
FORMATS = {
    "StoreNumber": r"^SF-\d{5,}$",
    "ZipCode": r"^\d{5}$",
    "StateCode": r"^[A-Z]{2}$",
    "Email": r"^[^@\s]+@[^@\s]+\.[^@\s]+$",
}


def _stack(df: DataFrame, rows: list[dict[str, Column]]) -> DataFrame:
    """Turn the columns of a one-row frame into one row per entry."""
    return df.select(
        F.inline(
            F.array(*[F.struct(*[value.alias(name) for name, value in row.items()]) for row in rows])
        )
    )


Rules = Mapping[str, str | Column]


def check_rule_sets(df: DataFrame, rules: Mapping[str, Rules]) -> DataFrame:
    """TableName, Rule, CheckedRows, Violations of several rule sets in one pass.

    As with a SQL CHECK, a rule that comes out unknown is not violated.
    """
    named = [
        (table, name, F.expr(rule) if isinstance(rule, str) else rule)
        for table, group in rules.items()
        for name, rule in group.items()
    ]
    counted = df.agg(
        F.count("*").alias("_rows"),
        *[F.count_if(~rule).alias(f"_{i}") for i, (_, _, rule) in enumerate(named)],
    )
    return _stack(
        counted,
        [
            {
                "TableName": F.lit(table),
                "Rule": F.lit(name),
                "CheckedRows": F.col("_rows"),
                "Violations": F.col(f"_{i}"),
            }
            for i, (table, name, _) in enumerate(named)
        ],
    )


def check_rules(df: DataFrame, table: str, rules: Rules) -> DataFrame:
    """The rules of one table, checked in one pass."""
    return check_rule_sets(df, {table: rules})


def check_formats(df: DataFrame, table: str, patterns: Mapping[str, str]) -> DataFrame:
    """Values that do not match the pattern of their column."""
    return check_rules(df, table, {name: F.col(name).rlike(p) for name, p in patterns.items()})


def check_not_null(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """TableName, ColumnName, CheckedRows, Nulls; all columns in one pass."""
    counted = df.agg(
        F.count("*").alias("_rows"), *[F.count(F.col(c)).alias(f"_{c}") for c in columns]
    )
    return _stack(
        counted,
        [
            {
                "TableName": F.lit(table),
                "ColumnName": F.lit(name),
                "CheckedRows": F.col("_rows"),
                "Nulls": F.col("_rows") - F.col(f"_{name}"),
            }
            for name in columns
        ],
    )


def check_unique(df: DataFrame, table: str, key: Sequence[str]) -> DataFrame:
    """Rows, distinct keys and how many keys occur more than once.

    Rows are counted per key before the shuffle, so a key that fills the table
    arrives as one row per task.
    """
    return (
        df.groupBy(*key)
        .agg(F.count("*").alias("_n"))
        .agg(
            F.coalesce(F.sum("_n"), F.lit(0)).alias("CheckedRows"),
            F.count("*").alias("DistinctKeys"),
            F.count_if(F.col("_n") > 1).alias("DuplicatedKeys"),
        )
        .select(
            F.lit(table).alias("TableName"),
            F.lit(",".join(key)).alias("KeyColumns"),
            "CheckedRows",
            "DistinctKeys",
            "DuplicatedKeys",
        )
    )


def check_reference(
    child: DataFrame, table: str, column: str, parent: DataFrame, parent_table: str, key: str
) -> DataFrame:
    """Child rows whose reference has no parent; NULL refers to nothing.

    Child rows are counted per referenced key first: the anti join then sees
    each key once.
    """
    orphans = (
        child.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("_key"))
        .agg(F.count("*").alias("_n"))
        .join(parent.select(F.col(key).alias("_key")), "_key", "left_anti")
    )
    return orphans.agg(
        F.count("*").alias("OrphanKeys"),
        F.coalesce(F.sum("_n"), F.lit(0)).alias("OrphanRows"),
    ).select(
        F.lit(f"{table}.{column}").alias("Child"),
        F.lit(f"{parent_table}.{key}").alias("Parent"),
        "OrphanKeys",
        "OrphanRows",
    )


def check_group_size(
    df: DataFrame, rule: str, key: Sequence[str], size: Column, expected: Column
) -> DataFrame:
    """Groups whose ``size`` is not the expected one; both are aggregates."""
    return (
        df.groupBy(*key)
        .agg(size.alias("_size"), expected.alias("_expected"))
        .agg(
            F.count("*").alias("Groups"),
            F.count_if(~F.col("_size").eqNullSafe(F.col("_expected"))).alias("WrongGroups"),
        )
        .select(F.lit(rule).alias("Rule"), "Groups", "WrongGroups")
    )


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def fill_defaults(df: DataFrame, table: str) -> DataFrame:
    """Replace NULLs by the catalogued defaults and add missing columns that have one."""
    filled = {}
    for name, default in schemas.defaults(table).items():
        kind = next(c.type for c in schemas.columns(table) if c.name == name)
        value = F.expr(default).cast(kind)
        filled[name] = F.coalesce(F.col(name), value) if name in df.columns else value
    return df.withColumns(filled)


def require(
    df: DataFrame,
    rows: int | None = None,
    unique: Sequence[str] = (),
    rules: Mapping[str, str] | None = None,
) -> None:
    """Raise ValueError unless row count, unique columns and row rules hold; one job."""
    rules = rules or {}
    found = df.agg(
        F.count("*").alias("rows"),
        *[F.count_distinct(name).alias(f"u_{name}") for name in unique],
        *[F.count_if(~F.expr(rule)).alias(f"r_{name}") for name, rule in rules.items()],
    ).first()
    if rows is not None and found["rows"] != rows:
        raise ValueError(f"Expected {rows} rows, got {found['rows']}")
    for name in unique:
        if found[f"u_{name}"] != found["rows"]:
            raise ValueError(f"Duplicate values in {name}")
    for name in rules:
        if found[f"r_{name}"]:
            raise ValueError(f"{found[f'r_{name}']} rows violate {name}")


def table_report(df: DataFrame, table: str, parents: Mapping[str, DataFrame]) -> DataFrame:
    """Everything the catalogue says about one table, checked.

    Kind, Subject, Violations: mandatory columns, row rules, unique keys, and
    references to those parents that are given. A column that one of these needs
    and the table does not carry is a violation of its own.
    """
    present = set(df.columns)
    needed = [
        *schemas.required_columns(table),
        *(c for key in constraints.unique_keys(table) for c in key),
        *(ref.column for ref in constraints.references(table)),
        *(c for rule in constraints.checks(table).values() for c in sorted(_columns_of(rule, table))),
    ]
    absent = [c for c in dict.fromkeys(needed) if c not in present]
    mandatory = [c for c in schemas.required_columns(table) if c in present]
    parts = []
    if absent:
        names = F.explode(F.array(*[F.lit(c) for c in absent]))
        parts.append(
            df.sparkSession.range(1).select(
                F.lit("absent column").alias("Kind"), names.alias("Subject"), F.lit(1).cast("bigint").alias("Violations")
            )
        )
    if mandatory:
        parts.append(
            check_not_null(df, table, mandatory).select(
                F.lit("not null").alias("Kind"), F.col("ColumnName").alias("Subject"),
                F.col("Nulls").alias("Violations"),
            )
        )
    rules = {
        name: rule
        for name, rule in constraints.checks(table).items()
        if _columns_of(rule, table) <= present
    }
    if rules:
        parts.append(
            check_rules(df, table, rules).select(
                F.lit("check").alias("Kind"), F.col("Rule").alias("Subject"), "Violations"
            )
        )
    for key in constraints.unique_keys(table):
        if set(key) <= present:
            parts.append(
                check_unique(df, table, key).select(
                    F.lit("unique").alias("Kind"), F.col("KeyColumns").alias("Subject"),
                    F.col("DuplicatedKeys").alias("Violations"),
                )
            )
    for ref in constraints.references(table):
        if ref.column in present and ref.parent in parents:
            parts.append(
                check_reference(
                    df, table, ref.column, parents[ref.parent], ref.parent, ref.parent_key
                ).select(
                    F.lit("reference").alias("Kind"),
                    F.concat_ws(" -> ", F.lit(ref.column), F.lit(ref.parent)).alias("Subject"),
                    F.col("OrphanRows").alias("Violations"),
                )
            )
    return union_all(parts).select(F.lit(table).alias("TableName"), "Kind", "Subject", "Violations")


def _columns_of(rule: str, table: str) -> set[str]:
    words = set(re.findall(r"\w+", rule))
    return {c.name for c in schemas.columns(table)} & words
