"""Landed extracts: inventory, validation, duplicate resolution."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerloom.constants import FULL, FULL_RESET, INCREMENTAL, READY_STATES, SEPARATE_FILE_TABLES
from layerloom.operators.keyed import moment, skew_safe_join

FILE_SCHEMA = "base_name string, file_name string, path string, size_bytes bigint"
METADATA_SCHEMA = (
    "base_name string, readable boolean, table_name string, config_name string, physical_name string, "
    "load_mode string, row_count bigint, column_count int, extract_timestamp string, source string, "
    "checksum_md5 string"
)
STATUS_SCHEMA = "base_name string, readable boolean, status string, error string, load_mode string"
CONTENT_SCHEMA = "base_name string, readable boolean, actual_row_count bigint, actual_md5 string"

# --- fixed values: row count tolerance and size classes ----------------------
TOLERANCE_ROWS = 10
TOLERANCE_SHARE = 0.01
SMALL_BELOW_MB = 5.0
LARGE_FROM_MB = 50.0
# --- end of fixed values -----------------------------------------------------
MEGABYTE = 1024 * 1024


def row_count_mismatch(actual: Column, expected: Column) -> Column:
    """True when the counts differ by more than 10 rows and more than 1 percent."""
    tolerance = F.greatest(F.lit(float(TOLERANCE_ROWS)), expected * F.lit(TOLERANCE_SHARE))
    return F.coalesce((expected > 0) & (F.abs(actual - expected) > tolerance), F.lit(False))


def check_files(expected: DataFrame, content: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Validate files by readability, row count, then checksum.

    ``expected`` carries ``base_name, row_count, checksum_md5``; ``content``
    what was measured (:data:`CONTENT_SCHEMA`, and columns to ``carry`` along).
    """
    joined = expected.select("base_name", "row_count", "checksum_md5").join(content, "base_name", "left")
    unreadable = ~F.coalesce(F.col("readable"), F.lit(False))
    rows_off = row_count_mismatch(F.col("actual_row_count"), F.col("row_count"))
    sum_off = F.coalesce(F.col("checksum_md5") != F.col("actual_md5"), F.lit(False))
    problem = (
        F.when(unreadable, F.lit("unreadable"))
        .when(rows_off, F.lit("row_count_mismatch"))
        .when(sum_off, F.lit("checksum_mismatch"))
    )
    return joined.select(
        "base_name",
        F.col("row_count").alias("expected_row_count"),
        "actual_row_count",
        problem.alias("problem"),
        problem.isNull().alias("is_valid"),
        *carry,
    )


def inventory(
    files: DataFrame,
    metadata: DataFrame,
    status: DataFrame,
    content: DataFrame | None = None,
    run_ts: datetime | str | Column = "1970-01-01 00:00:00",
    tables: Sequence[str] | None = None,
    dated: bool = False,
) -> DataFrame:
    """Every landed file with ``skip_reason``, NULL for a file that may be loaded.

    The sidecars are joined on the base name. ``content`` is what
    :func:`check_files` needs; without it files are not validated. An
    unreadable extract timestamp falls back to ``run_ts``; with ``dated``,
    ``is_dated`` says which files have a readable one.
    """
    meta = metadata.select(
        "base_name", *[F.col(c).alias(f"m_{c}") for c in metadata.columns if c != "base_name"], F.lit(True).alias("m_hit")
    )
    state = status.select(
        "base_name", *[F.col(c).alias(f"s_{c}") for c in status.columns if c != "base_name"], F.lit(True).alias("s_hit")
    )
    joined = files.join(meta, "base_name", "left").join(state, "base_name", "left")
    if content is not None:
        expected = metadata.select("base_name", "row_count", "checksum_md5")
        checked = check_files(expected, content).select("base_name", "actual_row_count", "problem")
        joined = joined.join(checked, "base_name", "left")
    else:
        joined = joined.withColumns(
            {"actual_row_count": F.lit(None).cast("bigint"), "problem": F.lit(None).cast("string")}
        )

    has_metadata = F.coalesce(F.col("m_hit") & F.col("m_readable"), F.lit(False))
    complete = reduce(
        lambda a, b: a & b,
        [F.col(f"m_{c}").isNotNull() for c in ("table_name", "column_count", "row_count", "load_mode")],
    )
    state_readable = F.coalesce(F.col("s_hit") & F.col("s_readable"), F.lit(False))
    ready = ~state_readable | F.coalesce(F.col("s_status"), F.lit("completed")).isin(*READY_STATES)
    skip = (
        F.when(~has_metadata, F.lit("no_metadata"))
        .when(~complete, F.lit("invalid_metadata"))
        .when(~ready, F.lit("not_completed"))
        .when(F.col("problem").isNotNull(), F.lit("validation_failed"))
    )
    override = F.when(state_readable, F.col("s_load_mode"))
    result = joined.select(
        *files.columns,
        F.col("m_table_name").alias("table_name"),
        F.col("m_config_name").alias("config_name"),
        F.coalesce("m_physical_name", "m_config_name", "m_table_name").alias("physical_name"),
        F.coalesce(override, F.col("m_load_mode"), F.lit(INCREMENTAL)).alias("load_mode"),
        F.coalesce(F.col("m_extract_timestamp").try_cast("timestamp_ntz"), moment(run_ts)).alias("extraction_date"),
        F.col("m_row_count").alias("row_count"),
        "actual_row_count",
        F.col("m_column_count").alias("column_count"),
        F.coalesce("m_source", F.lit("unknown")).alias("source"),
        F.coalesce("s_hit", F.lit(False)).alias("has_status"),
        F.when(state_readable & ~ready, F.coalesce("s_error", F.concat(F.lit("Status: "), "s_status"))).alias(
            "status_error"
        ),
        skip.alias("skip_reason"),
        *([F.col("m_extract_timestamp").try_cast("timestamp_ntz").isNotNull().alias("is_dated")] if dated else []),
    )
    return result if tables is None else result.filter(F.col("table_name").isin(*tables))


def validated(listing: DataFrame, metadata: DataFrame, content: DataFrame) -> DataFrame:
    """An inventory made without content, after the files it lets through were opened; adds ``schema_print``."""
    expected = metadata.select("base_name", "row_count", "checksum_md5")
    checked = check_files(expected, content, carry=["schema_print"])
    found = checked.select("base_name", F.col("actual_row_count").alias("_rows"), "problem", "schema_print")
    joined = listing.join(found, "base_name", "left")
    values = {
        "actual_row_count": F.col("_rows"),
        "skip_reason": F.coalesce("skip_reason", F.when(F.col("problem").isNotNull(), F.lit("validation_failed"))),
    }
    return joined.select(*[values.get(c, F.col(c)).alias(c) for c in listing.columns], "schema_print")


def discovered(listing: DataFrame) -> DataFrame:
    return listing.filter(F.col("skip_reason").isNull()).drop("skip_reason", "status_error")


def skip_counts(listing: DataFrame) -> DataFrame:
    return listing.groupBy("skip_reason").agg(F.count(F.lit(1)).alias("file_count"))


def _file_order() -> Column:
    return F.struct("extraction_date", "file_name")


def duplicate_files(files: DataFrame) -> DataFrame:
    """Tables with more than one file, with the newest of them."""
    return (
        files.groupBy("physical_name")
        .agg(F.count(F.lit(1)).alias("file_count"), F.max(_file_order()).alias("newest"))
        .filter(F.col("file_count") > 1)
        .select(
            "physical_name",
            "file_count",
            F.col("newest.file_name").alias("latest_file"),
            F.col("newest.extraction_date").alias("latest_extraction"),
        )
    )


def part_of_extract(mode: Column) -> Column:
    """Files that share their table, mode and time with others are parts of one extract: only full ones with a time of their own."""
    return mode.isin(FULL, FULL_RESET) & F.coalesce(F.col("is_dated"), F.lit(False))


def mark_incomplete(listing: DataFrame) -> DataFrame:
    """``is_incomplete``: another part of the file's extract is there and may not be loaded."""
    extract = ["physical_name", "load_mode", "extraction_date"]
    held = listing.filter(part_of_extract(F.col("load_mode")) & F.col("skip_reason").isNotNull())
    held = held.groupBy(*extract).agg(F.lit(True).alias("_held"))
    marked = listing.join(held, extract, "left")
    return marked.select(*listing.columns, (F.coalesce("_held", F.lit(False)) & F.coalesce("is_dated", F.lit(False))).alias("is_incomplete"))


def resolve_file_sets(
    files: DataFrame,
    group_by: str = "table_name",
    separate_tables: Sequence[str] = SEPARATE_FILE_TABLES,
    since_last_full: bool = False,
    in_parts: bool = False,
) -> DataFrame:
    """``resolution`` of every file: kept, superseded or consolidated.

    The newest file's mode decides for its table: FULL and FULL_RESET keep the
    newest file only, INCREMENTAL takes them all (with ``since_last_full``,
    none older than the last full extract). Files of ``separate_tables`` are
    all kept on their own.

    With ``in_parts`` an extract may lie in several files: full ones of one
    time and mode (:func:`part_of_extract`, which needs ``is_dated``) are kept
    or superseded together.

    The per-table facts are aggregated before the shuffle and joined back, so
    a table that owns most of the files is not gathered in one task.
    """
    full = F.col("load_mode").isin(FULL, FULL_RESET)
    facts = files.groupBy(group_by).agg(
        F.count(F.lit(1)).alias("_files"),
        F.max(F.struct("extraction_date", "file_name", "load_mode")).alias("_newest"),
        F.max(F.when(full, F.struct("extraction_date", "file_name", "load_mode"))).alias("_last_full"),
    )
    joined = skew_safe_join(files, facts, [group_by], "left")

    def belongs_to(fact: str) -> Column:
        """The file of that fact, or a part of the same extract."""
        same = F.col("file_name") == F.col(f"{fact}.file_name")
        if in_parts:
            same |= part_of_extract(F.col("load_mode")) & (F.col("load_mode") == F.col(f"{fact}.load_mode"))
        return (F.col("extraction_date") == F.col(f"{fact}.extraction_date")) & same

    newest_mode = F.col("_newest.load_mode")
    resolution = (
        F.when(F.col("_files") == 1, F.lit("kept"))
        .when(F.col(group_by).isin(*separate_tables), F.lit("kept"))
        .when(newest_mode.isin(FULL, FULL_RESET), F.when(belongs_to("_newest"), F.lit("kept")).otherwise(F.lit("superseded")))
    )
    if since_last_full:
        older = _file_order() < F.struct("_last_full.extraction_date", "_last_full.file_name")
        resolution = resolution.when(older & ~F.coalesce(belongs_to("_last_full"), F.lit(False)), F.lit("superseded"))
    resolution = resolution.otherwise(F.lit("consolidated"))
    effective = F.when(resolution == "consolidated", F.lit(INCREMENTAL)).otherwise(F.col("load_mode"))
    return joined.select(*files.columns, resolution.alias("resolution"), effective.alias("effective_mode"))


def consolidate(extracts: Sequence[DataFrame]) -> DataFrame:
    """All extracts of one table, in the order given; differing schemas are an error."""
    first = [(f.name, f.dataType) for f in extracts[0].schema]
    for other in extracts[1:]:
        if [(f.name, f.dataType) for f in other.schema] != first:
            raise ValueError(f"extract schemas differ: {extracts[0].schema} and {other.schema}")
    return reduce(DataFrame.unionByName, extracts)


def mode_stats(files: DataFrame) -> DataFrame:
    """Files and megabytes per load mode."""
    return files.groupBy("load_mode").agg(
        F.count(F.lit(1)).alias("file_count"),
        (F.sum("size_bytes") / F.lit(float(MEGABYTE))).alias("total_size_mb"),
    )


def size_bucket(size_bytes: Column) -> Column:
    megabytes = size_bytes / F.lit(float(MEGABYTE))
    return (
        F.when(megabytes < SMALL_BELOW_MB, F.lit("small"))
        .when(megabytes < LARGE_FROM_MB, F.lit("medium"))
        .otherwise(F.lit("large"))
    )


def size_buckets(files: DataFrame) -> DataFrame:
    """Files and bytes per size class."""
    return files.groupBy(size_bucket(F.col("size_bytes")).alias("size_bucket")).agg(
        F.count(F.lit(1)).alias("file_count"), F.sum("size_bytes").cast("bigint").alias("total_bytes")
    )


def name_prefix(file_name: Column) -> Column:
    """Table identifier in a file name: the text before the first underscore."""
    return F.split_part(file_name, F.lit("_"), F.lit(1))
