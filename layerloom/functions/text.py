"""Cell text for the raw layer."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values: what the raw layer removes --------------------------------
FORBIDDEN_CHARACTERS = r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F-\x9F]"
NULL_TOKENS = ("None", "<NA>", "nan", "NaT")
# --- end of fixed values -----------------------------------------------------

REPLACEMENT = "�"


def valid_utf8(text: Column) -> Column:
    """Drop undecodable bytes; well-formed text passes through untouched."""
    repaired = F.replace(F.make_valid_utf8(text), F.lit(REPLACEMENT), F.lit(""))
    return F.when(F.is_valid_utf8(text), text).otherwise(repaired)


def sanitize(text: Column) -> Column:
    """Remove control characters a text column cannot hold (tab, LF and CR stay)."""
    return F.regexp_replace(valid_utf8(text), FORBIDDEN_CHARACTERS, "")


def blank_null_tokens(text: Column) -> Column:
    """NULL and the usual spellings of a missing value become ``''``."""
    return F.when(text.isNull() | text.isin(*NULL_TOKENS), F.lit("")).otherwise(text)


def positional(text: Column) -> Column:
    """The text of a floating number without exponent (``1.23456789E8`` to ``123456789.0``).

    Spark prints an exponent below 10^-3 and from 10^7 on, which numeric
    columns of other systems spell out. Outside [1e-4, 1e16) it is kept.
    """
    size = F.abs(text.try_cast("double"))
    digits = F.rtrim(text.try_cast("decimal(38,18)").cast("string"), F.lit("0"))
    plain = F.when(digits.endswith("."), F.concat(digits, F.lit("0"))).otherwise(digits)
    return F.when(text.contains("E") & (size >= 1e-4) & (size < 1e16), plain).otherwise(text)


def base_text(cell: Column, data_type: T.DataType) -> Column:
    """First step to raw-layer text: the cell's characters."""
    if isinstance(data_type, (T.StringType, T.BinaryType)):
        return sanitize(cell.cast("string"))
    if isinstance(data_type, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(cell)
    return cell.cast("string")


def final_text(text: Column, data_type: T.DataType) -> Column:
    """Second step, on a plain column holding :func:`base_text`: missing values blanked."""
    if isinstance(data_type, (T.StringType, T.BinaryType)):
        return blank_null_tokens(text)
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return F.when(text.isNull() | (text == "NaN"), F.lit("")).otherwise(positional(text))
    return F.coalesce(text, F.lit(""))
