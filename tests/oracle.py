"""Run a registered query and its SQL side by side."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        if Path(f"{folder}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        return format(value.normalize(), "f") if value else "0"
    if isinstance(value, dt.datetime | dt.date):
        return value.isoformat()
    return repr(value)


def normalized(names: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(names)), key=names.__getitem__)
    return [names[i] for i in order], sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def type_mismatches(df, described) -> list[str]:
    """Columns whose Spark and DuckDB types differ in kind."""
    kinds = {
        "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
        "date": "DATE", "timestamp_ntz": "TIMESTAMP",
    }
    theirs = {name: str(kind) for name, kind, *_ in described}
    wrong = []
    for name, kind in df.dtypes:
        want = kinds.get(kind, kind.upper())
        if want != theirs.get(name):
            wrong.append(f"{name}: {kind} vs {theirs.get(name)}")
    return wrong
