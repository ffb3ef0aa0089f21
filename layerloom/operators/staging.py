"""Staging layer: array columns split, every cell cast, run columns added."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerloom.constants import HASHDIFF, ROW_POSITION, RUN_ID, VALID_FROM
from layerloom.functions.casts import array_part, extent_parts, rejected, trimmed_element, trimmed_scalar
from layerloom.functions.hashing import hashdiff
from layerloom.operators.catalog import TargetColumn
from layerloom.operators.keyed import moment


def _cells(raw: DataFrame, columns: Sequence[TargetColumn], keep: Sequence[str], trim: bool) -> DataFrame:
    """``keep`` plus one text cell ``_cell_<i>`` per target column.

    A packed column is split once, not once per element. The steps stay
    separate projections of one stage: Spark does not merge projections whose
    results are used more than once.
    """
    packed = list(dict.fromkeys(c.source for c in columns if c.element))
    scalars = list(dict.fromkeys(c.source for c in columns if not c.element))
    split = raw.select(
        *[F.col(f"`{k}`") for k in keep],
        *[F.col(f"`{s}`").alias(f"_whole_{i}") for i, s in enumerate(scalars)],
        *[extent_parts(F.col(f"`{s}`")).alias(f"_parts_{i}") for i, s in enumerate(packed)],
    )

    def cell(column: TargetColumn) -> Column:
        if not column.element:
            return F.col(f"_whole_{scalars.index(column.source)}")
        return array_part(F.col(f"_parts_{packed.index(column.source)}"), column.element)

    texts = [cell(c) for c in columns]
    return split.select(*keep, *[(F.trim(t) if trim else t).alias(f"_cell_{i}") for i, t in enumerate(texts)])


def split_extents(raw: DataFrame, columns: Sequence[TargetColumn], keep: Sequence[str] = ()) -> DataFrame:
    """Array columns split into text elements, other columns as they are."""
    cells = _cells(raw, columns, keep, trim=False)
    return cells.select(*keep, *[F.col(f"_cell_{i}").alias(c.name) for i, c in enumerate(columns)])


def typed(
    raw: DataFrame, columns: Sequence[TargetColumn], keep: Sequence[str] = (), lenient: bool = False
) -> DataFrame:
    """All target columns split and cast, whatever the table's width."""
    cells = _cells(raw, columns, keep, trim=True)
    rules = [
        (trimmed_element if c.element else trimmed_scalar)(F.col(f"_cell_{i}"), c.sql_type, lenient).alias(c.name)
        for i, c in enumerate(columns)
    ]
    return cells.select(*keep, *rules)


def with_cast_error(raw: DataFrame, columns: Sequence[TargetColumn], name: str = "_error") -> DataFrame:
    """``raw`` plus a message naming every cell that cannot be cast, NULL for a clean row."""
    keep = raw.columns
    messages = F.array_compact(
        F.array(
            *[
                F.when(
                    rejected(F.col(f"_cell_{i}"), c.sql_type), F.lit(f"invalid {c.sql_type} in column '{c.name}'")
                )
                for i, c in enumerate(columns)
            ]
        )
    )
    found = _cells(raw, columns, keep, trim=True).select(*keep, messages.alias("_messages"))
    return found.select(*keep, F.when(F.size("_messages") > 0, F.array_join("_messages", "; ")).alias(name))


def to_staging(
    raw: DataFrame,
    columns: Sequence[TargetColumn],
    run_id: str,
    valid_from: datetime | str | Column,
    hash_columns: Sequence[str] | None = None,
    lenient: bool = False,
) -> DataFrame:
    """Raw rows typed and stamped with the run.

    With ``hash_columns`` the content hash is computed in the same pass, so a
    later merge reads key and hash only.
    """
    rows = typed(raw, columns, keep=[c for c in ROW_POSITION if c in raw.columns], lenient=lenient)
    extra = [F.lit(run_id).alias(RUN_ID), moment(valid_from).alias(VALID_FROM)]
    if hash_columns is not None:
        extra.append(hashdiff(hash_columns).alias(HASHDIFF))
    return rows.select("*", *extra)
