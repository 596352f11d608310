"""Run a named query in Spark and its oracle in DuckDB and compare the rows."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    db.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        db.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return db


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def rows_of(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def difference(df, db, sql: str) -> str | None:
    """None if both give the same rows, else what differs."""
    cursor = db.execute(sql)
    want_names = [d[0] for d in cursor.description]
    want = rows_of(want_names, cursor.fetchall())
    got = rows_of(df.columns, df.collect())
    if sorted(df.columns) != sorted(want_names):
        return f"columns {sorted(df.columns)} != {sorted(want_names)}"
    if got == want:
        return None
    extra, missing = got - want, want - got
    return (f"{sum(got.values())} rows, expected {sum(want.values())}; {sum(extra.values())} unexpected such as "
            f"{next(iter(extra), None)}; {sum(missing.values())} missing such as {next(iter(missing), None)}")
