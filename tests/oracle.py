"""Run queries in Spark and their SQL in DuckDB and compare the rows."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(folder: str):
    con = duckdb.connect()
    for f in sorted(glob.glob(f"{folder}/*.parquet")):
        name = os.path.splitext(os.path.basename(f))[0]
        con.execute(f"create view {name} as select * from read_parquet('{f}')")
    return con


def _plain(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else v
    return v


def _rows(columns, rows):
    at = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(([_plain(r[i]) for i in at] for r in rows), key=lambda r: [(v is None, str(type(v)), str(v)) for v in r])


KINDS = {
    "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "int": "INTEGER",
}


def compare(df, con, sql: str) -> list[str]:
    """Differences between a Spark result and a SQL result, as messages."""
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    kinds = {r[0]: r[1] for r in con.execute(f"describe {sql}").fetchall()}
    theirs = con.execute(sql).fetchall()
    ours = [tuple(r) for r in df.collect()]
    problems = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    for c, kind in df.dtypes:
        if KINDS.get(kind) != kinds[c]:
            problems.append(f"type of {c}: {kind} != {kinds[c]}")
    if len(ours) != len(theirs):
        problems.append(f"rows {len(ours)} != {len(theirs)}")
    if not ours:
        problems.append("no rows")
    a, b = _rows(df.columns, ours), _rows(names, theirs)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        problems.append(f"{len(bad)} rows differ, first: spark {bad[0][0]} sql {bad[0][1]}")
    return problems
