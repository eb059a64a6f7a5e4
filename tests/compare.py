"""Run a query in Spark and its SQL counterpart in DuckDB and compare the rows."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    return str(value) if value is not None else None


def canonical(columns: list[str], rows: list[tuple]) -> list[tuple]:
    """Columns by name, rows as sorted text, so that only contents are compared."""
    order = sorted(range(len(columns)), key=lambda i: columns[i].lower())
    cells = [tuple(_cell(row[i]) for i in order) for row in rows]
    return sorted(cells, key=lambda row: [(c is not None, c or "") for c in row])


_KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "date": "DATE",
}


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Problems found; an empty list means names, types and rows agree."""
    result = con.execute(sql)
    theirs = {d[0]: str(d[1]) for d in result.description}
    ours = {name: _KINDS[kind] for name, kind in df.dtypes}
    if ours != theirs:
        return [f"schema {ours} != {theirs}"]
    expected = canonical(list(theirs), result.fetchall())
    found = canonical(df.columns, [tuple(row) for row in df.collect()])
    if len(found) != len(expected):
        return [f"{len(found)} rows, expected {len(expected)}"]
    wrong = [(a, b) for a, b in zip(found, expected, strict=True) if a != b]
    return [f"{len(wrong)} of {len(found)} rows differ: {wrong[:2]}"] if wrong else []
