"""Run queries on Spark and DuckDB and compare columns, types and all values."""

from __future__ import annotations

import os
import sys
import time
from collections import Counter

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]
SPARK_TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
               "boolean": "BOOLEAN"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in filter(lambda t: os.path.exists(f"{sf_dir}/{t}.parquet"), TABLES):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def compare(df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    relation = con.sql(sql)
    ours = {name: SPARK_TYPES.get(kind, kind) for name, kind in df.dtypes}
    theirs = {name: str(kind) for name, kind in zip(relation.columns, relation.types)}
    if ours != theirs:
        return f"schema: {sorted(ours.items() - theirs.items())} vs {sorted(theirs.items() - ours.items())}"
    names = sorted(ours)
    left = Counter(tuple(row[n] for n in names) for row in df.collect())
    right = Counter(relation.select(*[f'"{n}"' for n in names]).fetchall())
    if left != right:
        only_left, only_right = left - right, right - left
        return (
            f"rows {left.total()} vs {right.total()}, "
            f"{only_left.total()} only here e.g. {next(iter(only_left), None)}, "
            f"{only_right.total()} only there e.g. {next(iter(only_right), None)} ({names})"
        )
    return None if left else "no rows"


def main() -> None:
    from conftest import make_spark

    sys.path.insert(0, __file__.rsplit("/", 2)[0])
    import __spark_entry__ as entry

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark, con = make_spark(), connect(sf_dir)
    oracles = entry.oracle_sql()
    bad = 0
    for name, run in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            problem = compare(df, con, oracles[name]) if name in oracles else f"no oracle, {df.count()} rows"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{name:26s} {time.time() - start:6.2f}s {problem or 'ok'}", flush=True)
    print("differences:", bad)


if __name__ == "__main__":
    main()
