"""Order-insensitive comparison of a query with its SQL."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"create view {path.stem} as select * from '{path}'")
    return connection


TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "timestamp": "TIMESTAMP", "boolean": "BOOLEAN"}


def _rows(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


def difference(df: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty when both sides have the same columns and the same rows."""
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    types = {d[0]: str(d[1]) for d in result.description}
    wrong = {c: (k, types[c]) for c, k in df.dtypes if TYPES.get(k, k.upper() if k.startswith("decimal") else None) != types[c]}
    if wrong:
        return f"types {wrong}"
    want = _rows(names, result.fetchall())
    have = _rows(df.columns, df.collect())
    if have == want:
        return ""
    return f"only in spark {list((have - want).items())[:3]}, only in sql {list((want - have).items())[:3]}"
