"""Text cells to typed values.

Every rule works on the trimmed cell. ``lenient=True`` yields NULL where the
strict form fails the query; :func:`rejected` tells such a NULL from a cell
that is empty by rule.

The ``trimmed_*`` rules take a cell that is trimmed already. Pass them a plain
column: each refers to its cell several times, and Spark would evaluate a
nested expression that often.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from layerloom.constants import EXTENT_DELIMITER
from layerloom.functions.types import family, spark_type, text_length

# --- fixed values: accepted spellings ----------------------------------------
EMPTY_MARKS = ("", "?")
TRUE_MARKS = ("true", "t", "1", "yes")
FALSE_MARKS = ("false", "f", "0", "no", "")
SLASH_DATE = r"^\d{2}/\d{2}/\d{4}$"
# --- end of fixed values -----------------------------------------------------


def extent_parts(packed: Column) -> Column:
    """All elements of a packed cell as an array."""
    return F.split(packed, EXTENT_DELIMITER, -1)


def array_part(parts: Column, index: int) -> Column:
    """Element ``index`` (from 1); a missing element is ``''``, NULL stays NULL."""
    return F.when(parts.isNotNull(), F.coalesce(F.get(parts, F.lit(index - 1)), F.lit("")))


def extent_part(packed: Column, index: int) -> Column:
    """Element ``index`` (from 1) straight from the packed cell."""
    return F.split_part(packed, F.lit(EXTENT_DELIMITER), F.lit(index))


def _cast(cell: Column, sql_type: str, lenient: bool) -> Column:
    target = spark_type(sql_type)
    return cell.try_cast(target) if lenient else cell.cast(target)


def trimmed_number(cell: Column, sql_type: str, lenient: bool = False) -> Column:
    return F.when(~cell.isin(*EMPTY_MARKS), _cast(cell, sql_type, lenient))


def trimmed_boolean(cell: Column) -> Column:
    mark = F.lower(cell)
    return F.when(mark.isin(*TRUE_MARKS), True).when(mark.isin(*FALSE_MARKS), False)


def trimmed_temporal(cell: Column, sql_type: str, lenient: bool = False) -> Column:
    # MM/DD/YYYY is put in ISO order: the ISO cast is far cheaper than a pattern parser
    iso = F.concat_ws("-", F.substring(cell, 7, 4), F.substring(cell, 1, 2), F.substring(cell, 4, 2))
    ordered = F.when(cell.rlike(SLASH_DATE), iso).otherwise(cell)
    return F.when(~cell.isin(*EMPTY_MARKS), _cast(ordered, sql_type, lenient))


def trimmed_text(cell: Column, sql_type: str = "TEXT", lenient: bool = False) -> Column:
    filled = F.nullif(cell, F.lit(""))
    limit = text_length(sql_type)
    if limit is not None:
        # a cast to varchar(n) does not cut in Spark SQL
        return F.left(filled, F.lit(limit))
    return filled if spark_type(sql_type) == "string" else _cast(filled, sql_type, lenient)


def trimmed_scalar(cell: Column, sql_type: str, lenient: bool = False) -> Column:
    """The rule for an ordinary column."""
    kind = family(sql_type)
    if kind == "numeric":
        return trimmed_number(cell, sql_type, lenient)
    if kind == "boolean":
        return trimmed_boolean(cell)
    if kind == "temporal":
        return trimmed_temporal(cell, sql_type, lenient)
    return trimmed_text(cell, sql_type, lenient)


def trimmed_element(cell: Column, sql_type: str, lenient: bool = False) -> Column:
    """The rule for an array element: as scalars, but text stays ``''`` and uncut."""
    return cell if family(sql_type) == "other" else trimmed_scalar(cell, sql_type, lenient)


def to_number(cell: Column, sql_type: str, lenient: bool = False) -> Column:
    return trimmed_number(F.trim(cell), sql_type, lenient)


def to_boolean(cell: Column) -> Column:
    """Unknown spellings give NULL, an empty cell gives FALSE."""
    return trimmed_boolean(F.trim(cell))


def to_temporal(cell: Column, sql_type: str, lenient: bool = False) -> Column:
    return trimmed_temporal(F.trim(cell), sql_type, lenient)


def to_text(cell: Column, sql_type: str = "TEXT", lenient: bool = False) -> Column:
    """Trimmed, empty is NULL, cut to the declared length."""
    return trimmed_text(F.trim(cell), sql_type, lenient)


def rejected(cell: Column, sql_type: str) -> Column:
    """True where the strict cast of a trimmed ``cell`` would fail."""
    kind = family(sql_type)
    if kind == "boolean" or (kind == "other" and spark_type(sql_type) == "string"):
        return F.lit(False)
    blank = ("",) if kind == "other" else EMPTY_MARKS
    filled = cell.isNotNull() & ~cell.isin(*blank)
    return filled & trimmed_scalar(cell, sql_type, lenient=True).isNull()
