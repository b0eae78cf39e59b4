"""Run a query on Spark and its SQL on DuckDB over the same tables and compare the rows."""

from __future__ import annotations

import datetime
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{folder}/{t}.parquet"
        if os.path.exists(path):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{path}'")
    return con


def _plain(v):
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return v


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in data), key=repr)


KINDS = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN"}


def compare(df, sql: str, con) -> list[str]:
    """Differences as text; empty when rows, names and types agree."""
    rel = con.sql(sql)
    if sorted(df.columns) != sorted(rel.columns):
        return [f"columns {sorted(df.columns)} / {sorted(rel.columns)}"]
    out = []
    theirs = dict(zip(rel.columns, map(str, rel.types)))
    for c, kind in df.dtypes:
        if KINDS.get(kind, kind.upper()).replace("DECIMAL(38,0)", "x") != theirs[c].replace("DECIMAL(38,0)", "x"):
            out.append(f"type of {c}: {kind} / {theirs[c]}")
    a, b = rows(df.columns, df.collect()), rows(rel.columns, rel.fetchall())
    if a != b:
        out.append(f"{len(a)} / {len(b)} rows")
        only_a, only_b = [x for x in set(a) - set(b)][:3], [x for x in set(b) - set(a)][:3]
        out.append(f"only Spark {only_a}\nonly SQL   {only_b}")
    if not b:
        out.append("no rows")
    return out
