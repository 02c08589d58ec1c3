"""Run a catalogue query in Spark and its SQL in DuckDB, and compare the rows."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _sortable(row: tuple) -> tuple:
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def _same(a, b) -> bool:
    if type(a) is not type(b):
        return False
    if isinstance(a, float):
        return (math.isnan(a) and math.isnan(b)) or a == b
    return a == b


def differences(spark, con, query, sql: str, sf_dir: str) -> list[str]:
    """What differs, in words; empty when both results are the same bag of rows."""
    frame = query(spark, sf_dir)
    columns = sorted(frame.columns)
    mine = [tuple(r) for r in frame.select(*columns).collect()]
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != columns:
        return [f"columns: {columns} vs {sorted(names)}"]
    order = [names.index(c) for c in columns]
    theirs = [tuple(row[i] for i in order) for row in result.fetchall()]
    if len(mine) != len(theirs):
        return [f"rows: {len(mine)} vs {len(theirs)}"]
    mine.sort(key=_sortable)
    theirs.sort(key=_sortable)
    out = []
    for a, b in zip(mine, theirs):
        if not all(map(_same, a, b)):
            out.append(f"{dict(zip(columns, a))} vs {dict(zip(columns, b))}")
            if len(out) == 3:
                break
    return out
