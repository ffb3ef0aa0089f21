"""Raw layer: every cell as sanitized text plus lineage, bad rows set aside."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerloom.constants import FILE_LOG_ID, LOADED_AT, RAW_LINEAGE_COLUMNS, ROW_POSITION, SOURCE_FILE
from layerloom.functions.text import base_text, final_text
from layerloom.operators.keyed import moment

# --- fixed values: error row layout ------------------------------------------
CHUNK_ROWS = 50_000
MESSAGE_LENGTH = 500
SAMPLE_LENGTH = 200
# The largest text value the original row store accepts.
MAX_CELL_BYTES = 1_073_741_823
# --- end of fixed values -----------------------------------------------------


def raw_table_name(table_name: str, config_name: str | None = None) -> str:
    return f"raw_{(config_name or table_name).lower()}"


def to_raw(
    df: DataFrame,
    loaded_at: datetime | str | Column,
    source_file: str | Column,
    log_id: str | Column | None,
    drop: Sequence[str] = (),
) -> DataFrame:
    """The raw form of an extract: two projections of one stage, no shuffle.

    Pass ``F.col("_metadata.file_name")`` as ``source_file`` to record the
    file of each row when many files are read at once. Columns that say where
    a row stands in its file set (``ROW_POSITION``) stay as they are; columns
    to ``drop`` serve the lineage only.
    """
    file = source_file if isinstance(source_file, Column) else F.lit(source_file)
    log = log_id if isinstance(log_id, Column) else F.lit(log_id).cast("string")
    lineage = [moment(loaded_at), file, log]
    data = [f for f in df.schema if f.name not in (*ROW_POSITION, *drop)]
    position = [c for c in ROW_POSITION if c in df.columns]
    based = df.select(
        *[base_text(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in data],
        *position,
        *[c.alias(n) for c, n in zip(lineage, RAW_LINEAGE_COLUMNS, strict=True)],
    )
    return based.select(
        *[final_text(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in data], *RAW_LINEAGE_COLUMNS, *position
    )


def data_columns(raw: DataFrame) -> list[str]:
    return [c for c in raw.columns if c not in (*RAW_LINEAGE_COLUMNS, *ROW_POSITION)]


def oversized(raw: DataFrame, limit: int = MAX_CELL_BYTES) -> Column:
    """Message for the first cell a text column could not hold, else NULL."""
    return F.coalesce(
        *[
            F.when(F.octet_length(f"`{c}`") > limit, F.lit(f"value too long in column '{c}'"))
            for c in data_columns(raw)
        ]
    )


def accepted(checked: DataFrame, error: str = "_error") -> DataFrame:
    """Rows without an error, the error column dropped."""
    return checked.filter(F.col(error).isNull()).drop(error)


def load_errors(checked: DataFrame, table_name: str, row_index: Column, error: str = "_error") -> DataFrame:
    """Rows with an error, in the error table's layout.

    ``row_index`` counts from 0 within the source file
    (``_metadata.row_index`` on a parquet scan).
    """
    sample = F.to_json(F.struct(*[c for c in data_columns(checked) if not c.startswith("_")]))
    return checked.filter(F.col(error).isNotNull()).select(
        F.lit(table_name).alias("table_name"),
        F.col(SOURCE_FILE).alias("source_file"),
        F.col(FILE_LOG_ID).alias("sftp_log_id"),
        (F.floor(row_index / CHUNK_ROWS) + 1).cast("bigint").alias("chunk_number"),
        (row_index % CHUNK_ROWS).cast("bigint").alias("row_number_in_chunk"),
        F.left(F.col(error), F.lit(MESSAGE_LENGTH)).alias("error_message"),
        F.left(sample, F.lit(SAMPLE_LENGTH)).alias("row_data_sample"),
        F.col(LOADED_AT).alias("error_timestamp"),
    )
