"""Run queries in Spark and DuckDB and compare the rows as sorted tuples."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"create view {file.stem} as select * from read_parquet('{file}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    made = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(made, key=lambda t: [(v is None, str(type(v)), v) for v in t])


def difference(df, con, sql: str) -> str | None:
    """None if equal, else what differs."""
    spark_rows = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    duck_rows = rows_of(names, result.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} / {sorted(names)}"
    if len(spark_rows) != len(duck_rows):
        return f"rows {len(spark_rows)} / {len(duck_rows)}"
    wrong = [(a, b) for a, b in zip(spark_rows, duck_rows) if repr(a) != repr(b)]
    if wrong:
        return f"{len(wrong)} of {len(spark_rows)} rows, first {wrong[0][0]} / {wrong[0][1]}"
    return None
