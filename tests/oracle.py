"""Compare a query's Spark result with its SQL on DuckDB, values and types."""

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def duck(folder):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{Path(folder) / name}.parquet'")
    return connection


def _sortable(row):
    return tuple(
        (value is None, "nan" if isinstance(value, float) and math.isnan(value) else value or 0)
        if not isinstance(value, str) else (False, value)
        for value in row
    )


def compare(spark, query, sql, folder):
    """Return a list of differences; empty when equal."""
    frame = query(spark, folder)
    result = duck(folder).execute(sql)
    described = {d[0]: str(d[1]) for d in result.description}
    names = sorted(frame.columns)
    problems = []
    if names != sorted(described):
        return [f"columns {names} and {sorted(described)}"]
    for name, kind in frame.dtypes:
        if TYPES.get(kind) != described[name]:
            problems.append(f"{name}: {kind} and {described[name]}")
    order = [list(described).index(n) for n in names]
    left = sorted((tuple(r) for r in frame.select(*names).collect()), key=_sortable)
    right = sorted((tuple(r[i] for i in order) for r in result.fetchall()), key=_sortable)
    if len(left) != len(right):
        problems.append(f"{len(left)} and {len(right)} rows")
    if not right:
        problems.append("no rows")
    different = [(a, b) for a, b in zip(left, right) if _sortable(a) != _sortable(b)]
    if different:
        a, b = different[0]
        problems.append(f"{len(different)} rows differ, first {str(a)[:400]} and {str(b)[:400]}")
    return problems
