"""Order-insensitive comparison of a Spark result with its DuckDB counterpart."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duckdb_over(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _cell(value: object) -> str:
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, int | float):
        return repr(float(value) + 0.0)
    return str(value)


def canonical(columns: list[str], rows: list[tuple]) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def assert_same(spark_df, con: duckdb.DuckDBPyConnection, statement: str) -> None:
    result = con.execute(statement)
    expected_columns = [d[0] for d in result.description]
    expected = canonical(expected_columns, result.fetchall())
    actual = canonical(spark_df.columns, [tuple(row) for row in spark_df.collect()])
    assert sorted(spark_df.columns) == sorted(expected_columns)
    assert len(actual) == len(expected)
    columns = sorted(spark_df.columns)
    for mine, theirs in zip(actual, expected, strict=True):
        different = [(c, a, e) for c, a, e in zip(columns, mine, theirs, strict=True) if a != e]
        assert not different, f"first differing row: {different}"
