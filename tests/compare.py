"""Order-free comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import contextlib
import datetime as dt
import io
import math
from decimal import Decimal
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duckdb_over(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        path = Path(sf_dir) / f"{table}.parquet"
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else value + 0.0
    if isinstance(value, dt.datetime):
        return value.isoformat(" ")
    return value


def normalised(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=lambda r: tuple((v is None, str(v)) for v in r))


def differences(spark_df, con, sql: str) -> list[str]:
    relation = con.sql(sql)
    left_columns, right_columns = list(spark_df.columns), list(relation.columns)
    if sorted(left_columns) != sorted(right_columns):
        return [f"columns {sorted(left_columns)} != {sorted(right_columns)}"]
    left = normalised(left_columns, spark_df.collect())
    right = normalised(right_columns, relation.fetchall())
    found = []
    if len(left) != len(right):
        found.append(f"{len(left)} rows != {len(right)} rows")
    names = sorted(left_columns)
    for a, b in zip(left, right):
        for name, x, y in zip(names, a, b):
            if x != y or type(x) is not type(y):
                found.append(f"{name}: {x!r} != {y!r} in {a}")
    return found


def plan_of(df) -> str:
    """The physical plan as text."""
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()
