"""Compare a query with its SQL twin: same columns, kinds of types and rows."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def difference(result: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty if equal, else what differs."""
    expected = con.execute(sql)
    names = [d[0] for d in expected.description]
    if sorted(names) != sorted(result.columns):
        return f"columns {sorted(result.columns)} != {sorted(names)}"
    kinds = {d[0]: _kind(str(d[1])) for d in expected.description}
    ours = {f.name: _kind(f.dataType.simpleString()) for f in result.schema}
    if kinds != ours:
        return f"types {ours} != {kinds}"
    order = sorted(names)
    theirs = Counter(_row(dict(zip(names, r, strict=True)), order) for r in expected.fetchall())
    mine = Counter(_row(r.asDict(), order) for r in result.collect())
    if mine == theirs:
        return ""
    return (
        f"{mine.total()} rows against {theirs.total()}; "
        f"extra {list((mine - theirs).items())[:3]}; missing {list((theirs - mine).items())[:3]}"
    )


def _row(values: dict, order: list[str]) -> tuple:
    return tuple("NaN" if isinstance(v := values[n], float) and math.isnan(v) else v for n in order)


def _kind(name: str) -> str:
    name = name.lower()
    for kind, words in {
        "text": ("string", "varchar"),
        "float": ("float", "double"),
        "int": ("int", "long"),
        "bool": ("bool",),
        "date": ("date",),
    }.items():
        if any(word in name for word in words):
            return kind
    return name
