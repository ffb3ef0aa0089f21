"""Declared column types and their Spark counterparts."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_PRECISION = 38
# A NUMERIC without precision keeps any value; this is the widest Spark form.
UNSIZED_NUMERIC = "decimal(38,18)"

# --- fixed values: declared type names ---------------------------------------
BOOLEAN_NAMES = ("BOOLEAN", "BIT", "LOGICAL")
INTEGER_NAMES = ("INTEGER", "BIGINT")
TEMPORAL_NAMES = ("DATE", "TIMESTAMP")
SPARK_NAMES = {
    "INTEGER": "int",
    "BIGINT": "bigint",
    "SMALLINT": "smallint",
    "REAL": "float",
    "DOUBLE PRECISION": "double",
    "DATE": "date",
    "TIMESTAMP": "timestamp_ntz",
    "TIMESTAMP WITH TIME ZONE": "timestamp",
}
TEXT_NAMES = ("TEXT", "VARCHAR", "CHAR", "CHARACTER", "CHARACTER VARYING")
ALIASES = {
    "INT": "INTEGER",
    "INT4": "INTEGER",
    "INT8": "BIGINT",
    "INT2": "SMALLINT",
    "BOOL": "BOOLEAN",
    "FLOAT": "DOUBLE PRECISION",
    "FLOAT4": "REAL",
    "FLOAT8": "DOUBLE PRECISION",
    "DOUBLE": "DOUBLE PRECISION",
    "TIMESTAMPTZ": "TIMESTAMP WITH TIME ZONE",
    "TIMESTAMP WITHOUT TIME ZONE": "TIMESTAMP",
    "STRING": "TEXT",
}
VARCHAR_LIMIT = 10_000
ELEMENT_NUMERIC_PRECISION = 17
# --- end of fixed values -----------------------------------------------------

_SIZED = re.compile(r"^\s*([A-Z][A-Z0-9 ]*?)\s*(?:\(\s*(\d+)\s*(?:,\s*(\d+)\s*)?\))?\s*$")


def _parts(sql_type: str) -> tuple[str, int | None, int | None]:
    match = _SIZED.match(sql_type.upper())
    if match is None:
        raise ValueError(f"not a declared type: {sql_type!r}")
    name, first, second = match.groups()
    name = ALIASES.get(name, name)
    return name, int(first) if first else None, int(second) if second else None


def family(sql_type: str) -> str:
    """``numeric``, ``boolean``, ``temporal`` or ``other``: which cast rule applies."""
    name = _parts(sql_type)[0]
    if name == "NUMERIC" or name in INTEGER_NAMES:
        return "numeric"
    if name in BOOLEAN_NAMES:
        return "boolean"
    if name in TEMPORAL_NAMES:
        return "temporal"
    return "other"


def spark_type(sql_type: str) -> str:
    """Spark DDL type of a declared type; precision and scale are clamped to 38."""
    name, first, second = _parts(sql_type)
    if name in ("NUMERIC", "DECIMAL"):
        if first is None:
            return UNSIZED_NUMERIC
        precision = min(first, MAX_PRECISION)
        return f"decimal({precision},{min(second or 0, precision)})"
    if name in BOOLEAN_NAMES:
        return "boolean"
    if name in TEXT_NAMES:
        return "string"
    if name not in SPARK_NAMES:
        raise ValueError(f"unknown declared type: {sql_type!r}")
    return SPARK_NAMES[name]


def text_length(sql_type: str) -> int | None:
    """Length limit of a character type, if it has one."""
    name, first, _ = _parts(sql_type)
    return first if name in ("VARCHAR", "CHAR", "CHARACTER", "CHARACTER VARYING") else None


def _by_kind(kind: Column, choices: dict[str, Column | str]) -> Column:
    chain = None
    for name, value in choices.items():
        value = F.lit(value) if isinstance(value, str) else value
        chain = F.when(kind == name, value) if chain is None else chain.when(kind == name, value)
    return chain.otherwise(F.lit("TEXT"))


def _sized(name: str, *sizes: Column) -> Column:
    digits = F.concat_ws(",", *[s.cast("string") for s in sizes])
    return F.concat(F.lit(f"{name}("), digits, F.lit(")"))


def element_type(source_type: Column, extent: Column, width: Column, scale: Column) -> Column:
    """Declared type of one element of an array column.

    The catalog stores the width of the whole packed column, so an element
    gets an equal share of it.
    """
    share = F.when((extent > 0) & (width > 0), F.floor(width / extent).cast("int"))
    text = F.when((share > 0) & (share < VARCHAR_LIMIT), _sized("VARCHAR", share)).otherwise("TEXT")
    number = (
        F.when((share > 0) & scale.isNotNull(), _sized("NUMERIC", share, scale))
        .when(scale.isNotNull(), _sized("NUMERIC", F.lit(ELEMENT_NUMERIC_PRECISION), scale))
        .otherwise("NUMERIC")
    )
    return _by_kind(
        F.lower(F.coalesce(source_type, F.lit("character"))),
        {
            "character": text,
            "clob": text,
            "integer": "INTEGER",
            "int64": "BIGINT",
            "decimal": number,
            "logical": "BOOLEAN",
            "date": "DATE",
            "datetime": "TIMESTAMP",
            "datetime-tz": "TIMESTAMP",
        },
    )


def scalar_type(source_type: Column, extent: Column, width: Column, scale: Column) -> Column:
    """Declared type of a whole column; a packed array column is plain text."""
    text = F.when((width > 0) & (width < VARCHAR_LIMIT), _sized("VARCHAR", width)).otherwise("TEXT")
    number = F.when((width > 0) & (scale > 0), _sized("NUMERIC", width, scale)).otherwise("NUMERIC")
    mapped = _by_kind(
        F.lower(source_type),
        {
            "character": text,
            "clob": "TEXT",
            "integer": "INTEGER",
            "int64": "BIGINT",
            "decimal": number,
            "logical": "BOOLEAN",
            "date": "DATE",
            "datetime": "TIMESTAMP",
            "datetime-tz": "TIMESTAMP WITH TIME ZONE",
            "recid": "BIGINT",
        },
    )
    return F.when(extent > 0, F.lit("TEXT")).otherwise(mapped)
