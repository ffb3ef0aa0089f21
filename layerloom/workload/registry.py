"""Query registration and the inputs several queries share.

Inputs are derived from whole tables. Where a query needs an earlier and a
later state of a table, both are cut by business status and together cover
every row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

FIRST_TS = "2024-01-01 00:30:00"
SECOND_TS = "2024-01-02 00:30:00"
THIRD_TS = "2024-01-03 00:30:00"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(build: Query) -> Query:
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def by_value(column: str, choices: dict[str, str | Column | None], default: str | Column | None = None) -> Column:
    """CASE column WHEN value THEN result ... ELSE default END."""

    def wrap(value: str | Column | None) -> Column:
        return value if isinstance(value, Column) else F.lit(value)

    chain = F.lit(None) if default is None else wrap(default)
    for value, result in reversed(choices.items()):
        chain = F.when(F.col(column) == value, wrap(result)).otherwise(chain)
    return chain
