"""Run a query in Spark and its SQL in DuckDB, and compare names, types and sorted values."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
KINDS = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
    "timestamp": "TIMESTAMP",
    "date": "DATE",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return (0, "")
    return (1, repr(float(value)) if isinstance(value, float) else str(value))


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(df, con, sql: str) -> list[str]:
    """Differences as text; empty when Spark and DuckDB agree."""
    result = con.execute(sql)
    theirs_names = [d[0] for d in result.description]
    theirs_kinds = {d[0]: str(d[1]) for d in result.description}
    theirs = result.fetchall()
    ours = [tuple(r) for r in df.collect()]
    problems = []
    if sorted(df.columns) != sorted(theirs_names):
        return [f"columns {sorted(df.columns)} != {sorted(theirs_names)}"]
    for name, kind in df.dtypes:
        if KINDS.get(kind, kind) != theirs_kinds[name]:
            problems.append(f"type of {name}: {kind} != {theirs_kinds[name]}")
    if len(ours) != len(theirs):
        problems.append(f"rows {len(ours)} != {len(theirs)}")
    a, b = _rows(df.columns, ours), _rows(theirs_names, theirs)
    if a != b:
        left, right = set(a), set(b)
        gone, extra = sorted(left - right)[:2], sorted(right - left)[:2]
        problems.append(f"{len(left - right)} values differ; spark {[[c[1] for c in r] for r in gone]} sql {[[c[1] for c in r] for r in extra]}")
    return problems
