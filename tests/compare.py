"""Compare a Spark result with a DuckDB result, values and kinds."""

from __future__ import annotations

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _sorted(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def mismatch(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if both hold the same rows under the same column names."""
    cursor = con.execute(sql)
    their_columns = [d[0] for d in cursor.description]
    theirs = _sorted(their_columns, cursor.fetchall())
    ours = _sorted(df.columns, [tuple(r) for r in df.collect()])
    if sorted(df.columns) != sorted(their_columns):
        return f"columns {sorted(df.columns)} != {sorted(their_columns)}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows != {len(theirs)}"
    for a, b in zip(ours, theirs):
        if repr(a) != repr(b):
            return f"{a} != {b}"
    return None
