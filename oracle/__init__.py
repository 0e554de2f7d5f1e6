"""DuckDB SQL with the expected result of every query."""

from __future__ import annotations


def sql() -> dict[str, str]:
    from oracle import queries

    return {name: queries.complete(select) for name, select in queries.SQL.items()}
