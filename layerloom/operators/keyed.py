"""Keyed row operators: latest version, upsert, insert-if-absent."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def moment(value: datetime | str | Column) -> Column:
    """A run timestamp without zone, whatever the session zone is."""
    if isinstance(value, Column):
        return value
    text = value.isoformat(sep=" ") if isinstance(value, datetime) else value
    return F.lit(text).cast("timestamp_ntz")


def skew_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi join on ``keys`` (NULL never matches) that AQE can split on a hot left key.

    ``right`` holds one row per key and is usually grouped by key already.
    Spark would then join it without a shuffle of its own, and skips skew
    handling for such a join. The hash as an extra key gives both sides their
    own exchange; the right side is the narrow one. Below the broadcast
    threshold neither side is shuffled at all.
    """
    spread = F.xxhash64(*keys)
    joined = left.withColumn("_spread", spread).join(right.withColumn("_spread", spread), ["_spread", *keys], how)
    return joined.drop("_spread")


def unmatched(source: DataFrame, target: DataFrame, on: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Source rows, unique by ``keys``, with no target row equal in ``on``.

    The target is first cut to the matching keys: a semi join over narrow
    columns, which broadcasts a small source instead of shuffling the target.
    What is left is at most one row per source key and joins on ``keys``
    alone, so a source partitioned by its keys stays where it is.
    """
    matched = skew_safe_join(target.select(*on), source.select(*on), on, "left_semi")
    return source.join(matched.select(*keys).distinct(), list(keys), "left_anti")


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of each key under ``order``; NULL keys form one group.

    ``order`` must be total for a repeatable result. The row limit runs before
    the shuffle too (WindowGroupLimit), so a key that owns a third of the
    table leaves each map task as a single row.
    """
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter("_rank = 1").drop("_rank")


def _tagged(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(c).alias(f"_new_{c}") for c in columns], F.lit(True).alias("_hit"))


def upsert(
    base: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    update_columns: Sequence[str],
    insert_columns: Sequence[str] | None = None,
) -> DataFrame:
    """``base`` with matching rows updated and unmatched ``updates`` added.

    Only ``update_columns`` change on a match; an added row takes
    ``insert_columns`` (all of them by default) and NULL elsewhere.
    ``updates`` holds at most one row per key.
    """
    incoming = _tagged(updates, [*keys, *[c for c in update_columns if c not in keys]])
    on = [F.col(k) == F.col(f"_new_{k}") for k in keys]
    joined = base.join(incoming, on, "left")
    kept = joined.select(
        *[
            F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)
            if c in update_columns
            else F.col(c)
            for c in base.columns
        ]
    )
    added_names = set(insert_columns if insert_columns is not None else base.columns) | set(keys)
    added = unmatched(updates, base, keys, keys).select(
        *[
            (F.col(f.name) if f.name in added_names else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in base.schema
        ]
    )
    return kept.unionByName(added)


def insert_absent(base: DataFrame, rows: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """``base`` plus the first row of every key it does not hold yet."""
    first = latest_per_key(rows, keys, order)
    return base.unionByName(unmatched(first, base, keys, keys).select(*base.columns))
