"""Run a registered query and its SQL twin and compare schema and values."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    return con


def _value(x):
    if isinstance(x, float):
        if math.isnan(x):
            return "nan"
        return x + 0.0  # -0.0 and 0.0 are one value
    return x


def _bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return Counter(tuple(_value(row[i]) for i in order) for row in rows)


SPARK_KIND = {"bigint": "int", "double": "float", "string": "str", "boolean": "bool"}
DUCK_KIND = {"BIGINT": "int", "INTEGER": "int", "DOUBLE": "float", "VARCHAR": "str", "BOOLEAN": "bool"}


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when equal, else what differs."""
    kinds = {name: SPARK_KIND.get(t, t) for name, t in df.dtypes}
    columns = df.columns
    ours = _bag(columns, df.collect())
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    types = {d[0]: DUCK_KIND.get(str(d[1]), str(d[1])) for d in result.description}
    theirs = _bag(names, result.fetchall())
    if sorted(columns) != sorted(names):
        return f"columns {sorted(columns)} != {sorted(names)}"
    if kinds != types:
        return f"types {kinds} != {types}"
    if ours != theirs:
        missing, extra = theirs - ours, ours - theirs
        return (
            f"{sum(ours.values())} rows, {sum(theirs.values())} expected; "
            f"missing {sum(missing.values())}: {str(list(missing)[:2])[:600]}; extra {sum(extra.values())}: {str(list(extra)[:2])[:600]}"
        )
    return None
