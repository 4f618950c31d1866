"""Compare a Spark result with a DuckDB result, whatever the order of rows and columns."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

# Both sides are rounded to six decimals. A value on the edge between two roundings may go either
# way with the order in which its terms were added, so one unit of the last decimal is allowed.
_TOLERANCE = 1.01e-6


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def _missing(value) -> bool:
    return value is None or (isinstance(value, float) and math.isnan(value))


def _sort_key(row):
    """Exact cells first: they identify a row; then the numbers."""
    exact = tuple((_missing(v), repr(v)) for v in row if not isinstance(v, float))
    return exact, tuple((_missing(v), 0.0 if _missing(v) else v) for v in row if isinstance(v, float) or v is None)


def _table(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return [columns[i] for i in order], sorted((tuple(row[i] for i in order) for row in rows), key=_sort_key)


def _same(a, b) -> bool:
    if _missing(a) or _missing(b):
        return _missing(a) and _missing(b)
    if isinstance(a, float) and isinstance(b, float):
        return abs(a - b) <= _TOLERANCE
    return type(a) is type(b) and a == b


def differences(spark_df, connection, sql: str) -> list[str]:
    """Empty when both sides agree in columns, rows and values."""
    expected = connection.execute(sql)
    want_columns, want = _table([d[0] for d in expected.description], expected.fetchall())
    have_columns, have = _table(spark_df.columns, [tuple(row) for row in spark_df.collect()])
    if have_columns != want_columns:
        return [f"columns {have_columns} instead of {want_columns}"]
    if len(have) != len(want):
        return [f"{len(have)} rows instead of {len(want)}"]
    return [f"{h} instead of {w}" for h, w in zip(have, want) if not all(map(_same, h, w))]
