"""Content hash that decides whether a row changed."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from layerloom.constants import HASH_EXCLUDED, NO_HASH

SAFE_SEPARATOR = "\x1f"
SAFE_NULL = "\x00"


def hashed_names(names: Iterable[str], exclude: Iterable[str] = HASH_EXCLUDED) -> list[str]:
    """The columns that count as content, in the order given."""
    skip = set(exclude)
    return [n for n in names if n not in skip and not n.startswith("_etl_")]


def hashdiff(names: Iterable[str], exclude: Iterable[str] = HASH_EXCLUDED, separated: bool = False) -> Column:
    """MD5 over the text of the content columns, NULL read as ``''``.

    The compatible form has no separator, so ``('ab','')`` and ``('a','b')``
    hash alike; ``separated=True`` keeps them and NULL apart. Cast doubles to
    decimal first: their text form differs between engines.
    """
    content = hashed_names(names, exclude)
    if not content:
        return F.lit(NO_HASH)
    null_text = F.lit(SAFE_NULL if separated else "")
    cells = [F.coalesce(F.col(f"`{n}`").cast("string"), null_text) for n in content]
    joined = F.concat_ws(SAFE_SEPARATOR, *cells) if separated else F.concat(*cells)
    return F.md5(joined)


# Longer than the 16 bytes of a packed hash, so the two kinds never meet.
_AS_IS = b"\x00" * 17


def packed(value: str) -> Column:
    """A hash column for a shuffle: 32 lowercase hex digits as 16 bytes, any other text marked and unchanged; null stays null."""
    text = F.col(value)
    raw = F.unhex(text)
    plain = (F.length(text) == 32) & F.coalesce(F.lower(F.hex(raw)) == text, F.lit(False))
    return F.when(plain, raw).otherwise(F.concat(F.lit(_AS_IS), text.cast("binary")))


def unpacked(value: Column) -> Column:
    """The text that was :func:`packed`."""
    rest = F.substring(value, len(_AS_IS) + 1, 2**31 - 1)
    return F.when(F.length(value) == 16, F.lower(F.hex(value))).otherwise(rest.cast("string"))
