"""Load monitoring: file log, run and table statistics, anomalies, metrics."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerloom.constants import COMPLETED, FAILED, PENDING
from layerloom.operators.keyed import insert_absent, latest_per_key, moment

# --- fixed values: thresholds and messages -----------------------------------
SPIKE_FACTOR = 1.2
SLOW_SECONDS = 600
GOOD_QUALITY = 0.9
FAIR_QUALITY = 0.7
ERROR_LENGTH = 500
NOTHING_LOADED = ("ERROR", "rows_loaded", "Source has rows but nothing loaded")
VOLUME_SPIKE = ("WARNING", "volume_spike", "Loaded rows unusually high")
NOTHING_CHANGED = ("WARNING", "no_op_merge", "Staging has rows but the history did not change")
SLOW_TABLE = ("WARNING", "duration", "Table processing very slow")
# --- end of fixed values -----------------------------------------------------


TABLE_STAT_SCHEMA = (
    "run_id string, layer string, table_name string, rows_source bigint, rows_loaded bigint, "
    "rows_failed bigint, duration_sec double, load_mode string, status string, error_message string"
)


def file_log_id(path: Column, run_id: str) -> Column:
    return F.md5(F.concat(path, F.lit(run_id)))


def file_log_rows(files: DataFrame, run_id: str, run_ts: datetime | str) -> DataFrame:
    """Log entries for landed files; the id is a hash of path and run."""
    return files.select(
        file_log_id(F.col("path"), run_id).alias("log_id"),
        "file_name",
        F.col("path").alias("file_path"),
        "table_name",
        "load_mode",
        F.col("size_bytes").alias("file_size_bytes"),
        F.lit(PENDING).alias("processing_status"),
        moment(run_ts).alias("detected_at"),
        F.lit(None).cast("timestamp_ntz").alias("processed_at"),
        F.lit(None).cast("bigint").alias("row_count"),
        F.lit(None).cast("string").alias("error_message"),
    )


def update_file_status(log: DataFrame, updates: DataFrame) -> DataFrame:
    """The log after status updates (``log_id, status, row_count, error_message, updated_at``).

    The newest update of a file wins. A row count of NULL keeps the old one,
    and only a final status sets the processing time.
    """
    order = [F.desc_nulls_last(c) for c in ("updated_at", "status", "row_count", "error_message")]
    newest = latest_per_key(updates, ["log_id"], order).select(
        F.col("log_id").alias("_id"),
        F.col("status").alias("_status"),
        F.col("row_count").alias("_rows"),
        F.col("error_message").alias("_error"),
        F.col("updated_at").alias("_at"),
    )
    joined = log.join(newest, F.col("log_id") == F.col("_id"), "left")
    hit = F.col("_id").isNotNull()
    final = F.col("_status").isin(COMPLETED, FAILED)
    changed = {
        "processing_status": F.when(hit, F.col("_status")).otherwise(F.col("processing_status")),
        "row_count": F.coalesce("_rows", "row_count"),
        "error_message": F.when(hit, F.col("_error")).otherwise(F.col("error_message")),
        "processed_at": F.when(final, F.col("_at")).otherwise(F.col("processed_at")),
    }
    return joined.select(*[changed.get(c, F.col(c)).alias(c) for c in log.columns])


TABLE_STAT_COLUMNS = (
    "run_id",
    "layer",
    "table_name",
    "rows_source",
    "rows_loaded",
    "duration_sec",
    "load_mode",
    "status",
    "error_message",
)


def table_stats(loads: DataFrame) -> DataFrame:
    """Per-table statistics rows in the log's layout."""
    return loads.select(*TABLE_STAT_COLUMNS)


def run_stats(stats: DataFrame, pipeline: str, started_at: datetime | str | Column) -> DataFrame:
    """One row per run out of its table statistics."""
    failed = F.count_if(F.col("status") == FAILED)
    return stats.groupBy("run_id").agg(
        F.lit(pipeline).alias("pipeline"),
        F.when(failed > 0, F.lit(FAILED)).otherwise(F.lit(COMPLETED)).alias("status"),
        F.countDistinct("table_name").alias("tables_processed"),
        F.coalesce(F.sum("rows_loaded"), F.lit(0)).cast("bigint").alias("total_rows"),
        F.max(moment(started_at)).alias("started_at"),
    )


def record_runs(stored: DataFrame, runs: DataFrame) -> DataFrame:
    """Stored runs plus the unseen ones; a known run id is left alone."""
    return insert_absent(stored, runs, ["run_id"], [F.asc("started_at"), F.asc("pipeline")])


def anomalies(stats: DataFrame) -> DataFrame:
    """One row per broken rule of a table load; the rules are independent."""
    source, loaded = F.col("rows_source"), F.col("rows_loaded")

    def rule(hit: Column, finding: tuple[str, str, str]) -> Column:
        fields = zip(finding, ("level", "metric", "message"), strict=True)
        return F.when(hit, F.struct(*[F.lit(text).alias(name) for text, name in fields]))

    rules = F.array(
        rule((source > 0) & (loaded == 0), NOTHING_LOADED),
        rule(loaded > source * F.lit(SPIKE_FACTOR), VOLUME_SPIKE),
        rule(F.col("duration_sec") > SLOW_SECONDS, SLOW_TABLE),
    )
    found = stats.select("run_id", "layer", "table_name", F.explode(F.array_compact(rules)).alias("a"))
    return found.select("run_id", "layer", "table_name", "a.level", "a.metric", "a.message")


def silent_merges(stats: DataFrame) -> DataFrame:
    """History merges that changed nothing although staging had rows."""
    return stats.filter((F.col("layer") == "ods") & (F.col("rows_source") > 0) & (F.col("rows_loaded") == 0))


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part.cast("double") / whole)


def load_volumetry(loads: DataFrame) -> DataFrame:
    """Derived metrics of each load: success rate, delta, throughput, quality band."""
    loaded, failed = F.col("rows_loaded"), F.col("rows_failed")
    total = loaded + failed
    seconds, score = F.col("duration_sec"), F.col("quality_score")
    differs = (F.col("rows_source") > 0) & (F.col("rows_source") != total)
    return loads.select(
        "run_id",
        "layer",
        "table_name",
        "load_mode",
        loaded,
        failed,
        total.alias("total_rows_processed"),
        F.round(F.coalesce(_share(loaded * 100, total), F.lit(0.0)), 2).alias("success_rate_pct"),
        F.when(differs, loaded - F.col("rows_source")).alias("row_delta"),
        F.round(seconds, 2).alias("duration_seconds"),
        F.coalesce(F.floor(_share(loaded, seconds)), F.lit(0)).cast("bigint").alias("throughput_rows_per_sec"),
        F.round(score, 3).alias("quality_score"),
        F.when(score > GOOD_QUALITY, F.lit("good"))
        .when(score > FAIR_QUALITY, F.lit("fair"))
        .when(score.isNotNull(), F.lit("poor"))
        .alias("quality_band"),
        F.left("error_message", F.lit(ERROR_LENGTH)).alias("error"),
        F.when(F.col("error_message").isNotNull(), F.lit(FAILED)).otherwise(F.lit(COMPLETED)).alias("status"),
    )


def run_metrics(events: DataFrame) -> DataFrame:
    """Totals per run and layer; a table loaded in several layers counts once in each."""
    return events.groupBy("run_id", "layer").agg(
        F.count(F.lit(1)).alias("tables_count"),
        F.count_if(F.col("rows_failed") == 0).alias("success_count"),
        F.count_if(F.col("rows_failed") > 0).alias("failed_count"),
        F.coalesce(F.sum("rows_loaded"), F.lit(0)).cast("bigint").alias("total_rows_loaded"),
        F.coalesce(F.sum("rows_failed"), F.lit(0)).cast("bigint").alias("total_rows_failed"),
        F.sum("duration_sec").alias("total_duration"),
        F.avg("quality_score").alias("avg_quality"),
    )


def run_metrics_by_table(events: DataFrame) -> DataFrame:
    """The last event of each table in a run, with a status text."""
    last = events.groupBy("run_id", "table_name").agg(
        F.max(F.struct("event_time", "event_id", "rows_loaded", "rows_failed", "duration_sec", "quality_score")).alias("e")
    )
    failed = F.col("e.rows_failed")
    status = F.when(failed == 0, F.lit("ok")).otherwise(
        F.concat(F.lit("warning ("), failed.cast("string"), F.lit(" errors)"))
    )
    return last.select(
        "run_id",
        "table_name",
        "e.rows_loaded",
        "e.rows_failed",
        "e.duration_sec",
        "e.quality_score",
        status.alias("status"),
    )


def scd2_run_totals(merges: DataFrame) -> DataFrame:
    """Merge counters summed over the tables of a run."""
    names = ("total_rows", "new_records", "updated_records", "closed_records", "deleted_records")
    return merges.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("tables_count"),
        *[F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias(n) for n in names],
    )


def build_result_summary(results: DataFrame) -> DataFrame:
    """Model and test counts of a build: ``unique_id`` starts with the node kind."""
    kind = F.split_part("unique_id", F.lit("."), F.lit(1))
    model, test = kind == "model", kind == "test"
    good_model, good_test = F.col("status") == "success", F.col("status") == "pass"
    return results.groupBy("run_id").agg(
        F.count_if(model).alias("models_total"),
        F.count_if(model & good_model).alias("models_success"),
        F.count_if(model & ~good_model).alias("models_failed"),
        F.count_if(test).alias("tests_total"),
        F.count_if(test & good_test).alias("tests_passed"),
        F.count_if(test & ~good_test).alias("tests_failed"),
    )
