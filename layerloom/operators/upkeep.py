"""Retention, log statistics, replay and consistency."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerloom.constants import COMPLETED, FULL
from layerloom.operators.keyed import moment
from layerloom.operators.scd2 import History, current_view, merge, metric, one_row

# --- fixed values: retention periods in days ---------------------------------
LOG_RETENTION_DAYS = 90
FILE_LOG_RETENTION_DAYS = 180
RECENT_DAYS = 30
# --- end of fixed values -----------------------------------------------------


def cutoff(run_ts: datetime | str, days: int) -> Column:
    return moment(run_ts) - F.make_dt_interval(F.lit(days))


def expired_logs(run_ts: datetime | str, ts_column: str, days: int = LOG_RETENTION_DAYS) -> Column:
    """True for rows to purge; a row without timestamp is never purged."""
    return F.coalesce(F.col(ts_column) < cutoff(run_ts, days), F.lit(False))


def expired_files(run_ts: datetime | str, days: int = FILE_LOG_RETENTION_DAYS) -> Column:
    """File log entries to purge: old and completed."""
    return F.coalesce(
        (F.col("detected_at") < cutoff(run_ts, days)) & (F.col("processing_status") == COMPLETED), F.lit(False)
    )


def purge(log: DataFrame, expired: Column) -> DataFrame:
    """The rows that stay."""
    return log.filter(~expired)


def purge_counts(log: DataFrame, expired: Column) -> DataFrame:
    return log.agg(F.count_if(expired).alias("deleted_records"), F.count_if(~expired).alias("kept_records"))


def log_stats(log: DataFrame, log_name: str, ts_column: str, today: str) -> DataFrame:
    """Total rows and rows of the last 30 days."""
    since = F.date_sub(F.lit(today).cast("date"), RECENT_DAYS).cast("timestamp_ntz")
    return log.agg(
        F.count(F.lit(1)).alias("total_rows"), F.count_if(F.col(ts_column) > since).alias("recent_rows")
    ).select(F.lit(log_name).alias("log_name"), "*")


def replay(history: DataFrame, staging: DataFrame, table: History, run_ts: datetime | str, run_id: str) -> DataFrame:
    """Rebuild the live state from staging: a FULL merge, refused on empty staging.

    An empty batch would soft-delete the whole table; the check reads one row.
    """
    if staging.isEmpty():
        raise ValueError("no staging rows to replay")
    return merge(history, staging, table, FULL, run_ts, run_id)


def consistency_check(staging: DataFrame, history: DataFrame) -> DataFrame:
    """Staging rows against live history rows."""
    counts = one_row(
        [metric(staging, "staging_count"), metric(current_view(history), "ods_count")], ("staging_count", "ods_count")
    )
    return counts.withColumn("is_consistent", F.col("staging_count") == F.col("ods_count"))
