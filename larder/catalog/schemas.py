"""Table schemas read from the column lists."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import cache

from pyspark.sql import types as T

from larder.catalog.columns import TABLES

_COLUMN = re.compile(r"(?P<name>\w+) (?P<type>[\w(),]+)(?P<mandatory> not null)?( default (?P<default>.+))?$")


@dataclass(frozen=True)
class Column:
    name: str
    type: str
    nullable: bool
    default: str | None


def _column(line: str) -> Column:
    part = _COLUMN.match(line.strip())
    if part is None:
        raise ValueError(f"bad column: {line}")
    return Column(part["name"], part["type"], part["mandatory"] is None, part["default"])


@cache
def tables() -> dict[str, tuple[Column, ...]]:
    """``schema.Table`` -> columns, for every catalogued table."""
    return {name: tuple(_column(line) for line in text.strip().splitlines()) for name, text in TABLES.items()}


def columns(table: str) -> tuple[Column, ...]:
    try:
        return tables()[table]
    except KeyError:
        raise ValueError(f"unknown table: {table}") from None


def struct_type(table: str) -> T.StructType:
    return T.StructType(
        [T.StructField(c.name, T.DataType.fromDDL(c.type), c.nullable) for c in columns(table)]
    )


def primary_key(table: str) -> str:
    return columns(table)[0].name


def required_columns(table: str) -> list[str]:
    return [c.name for c in columns(table) if not c.nullable]


def defaults(table: str) -> dict[str, str]:
    """Column -> SQL text of its default."""
    return {c.name: c.default for c in columns(table) if c.default is not None}
