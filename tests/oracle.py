"""Compare a registered query with its SQL on the same parquet files."""

from __future__ import annotations

import glob
import math
import os

import duckdb
import pandas as pd


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in sorted(glob.glob(f"{folder}/*.parquet")):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(v):
    if v is None or v is pd.NaT:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9) + 0.0
    if hasattr(v, "isoformat"):
        return (v.replace(tzinfo=None) if hasattr(v, "hour") else v).isoformat()
    return v


def rows_of(table) -> list[tuple]:
    names = sorted(table.column_names)
    columns = [[_cell(v) for v in table.column(n).to_pylist()] for n in names]
    rows = list(zip(*columns)) if columns else []
    return sorted(rows, key=lambda r: tuple((x is None, str(type(x)), str(x)) for x in r))


def exact_types(table) -> dict[str, str]:
    return {f.name: str(f.type).split("[")[0].replace("large_", "") for f in table.schema}


def compare(spark_df, sql: str, con) -> list[str]:
    """Differences as text; empty when equal."""
    mine = spark_df.toArrow()
    theirs = con.sql(sql).to_arrow_table()
    problems = []
    if sorted(mine.column_names) != sorted(theirs.column_names):
        return [f"columns {sorted(mine.column_names)} != {sorted(theirs.column_names)}"]
    a, b = exact_types(mine), exact_types(theirs)
    wrong = {n: (a[n], b[n]) for n in a if a[n] != b[n] and "null" not in (a[n], b[n])}
    if wrong:
        problems.append(f"types {wrong}")
    left, right = rows_of(mine), rows_of(theirs)
    if len(left) != len(right):
        problems.append(f"rows {len(left)} != {len(right)}")
    if left != right:
        bad = [(x, y) for x, y in zip(left, right) if x != y]
        problems.append(f"{len(bad)} rows differ, first: {bad[:2]}")
    return problems
