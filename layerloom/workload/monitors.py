"""Monitoring and upkeep queries: every event stands for one table load."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerloom.operators import monitoring, upkeep
from layerloom.session import work_dir
from layerloom.sources.layers import Layers
from layerloom.workload.landings import FILES_SQL, landed_files
from layerloom.workload.registry import FIRST_TS, SECOND_TS, by_value, query, table

LOADS_SQL = """loads AS (SELECT 'run-' || strftime(ts, '%Y%m%d') AS run_id,
  CASE event_type WHEN 'view' THEN 'raw' WHEN 'click' THEN 'staging' ELSE 'ods' END AS layer, 'user_' || user_id AS table_name,
  cast(json_extract(props, '$.k') AS BIGINT) AS rows_source,
  CASE event_type WHEN 'error' THEN 0 ELSE cast(floor(value) AS BIGINT) END AS rows_loaded,
  CASE event_type WHEN 'error' THEN cast(json_extract(props, '$.k') AS BIGINT) ELSE 0 END AS rows_failed,
  cast(floor(value) * 8 AS DOUBLE) AS duration_sec,
  CASE event_type WHEN 'signup' THEN NULL ELSE cast(json_extract(props, '$.k') AS DOUBLE) / 64 END AS quality_score,
  CASE event_type WHEN 'purchase' THEN 'FULL' ELSE 'INCREMENTAL' END AS load_mode,
  CASE event_type WHEN 'error' THEN 'FAILED' ELSE 'COMPLETED' END AS status,
  CASE event_type WHEN 'error' THEN 'failed with ' || props END AS error_message, ts AS event_time, event_id FROM events)"""


def load_events(spark: SparkSession, folder: str) -> DataFrame:
    k = F.get_json_object("props", "$.k")
    loaded = F.floor("value")
    is_error = F.col("event_type") == "error"
    return table(spark, folder, "events").select(
        F.concat(F.lit("run-"), F.date_format("ts", "yyyyMMdd")).alias("run_id"),
        by_value("event_type", {"view": "raw", "click": "staging"}, "ods").alias("layer"),
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("table_name"),
        k.cast("bigint").alias("rows_source"),
        F.when(is_error, 0).otherwise(loaded).cast("bigint").alias("rows_loaded"),
        F.when(is_error, k.cast("bigint")).otherwise(0).alias("rows_failed"),
        (loaded * 8).cast("double").alias("duration_sec"),
        F.when(F.col("event_type") != "signup", k.cast("double") / 64).alias("quality_score"),
        by_value("event_type", {"purchase": "FULL"}, "INCREMENTAL").alias("load_mode"),
        by_value("event_type", {"error": "FAILED"}, "COMPLETED").alias("status"),
        F.when(is_error, F.concat(F.lit("failed with "), "props")).alias("error_message"),
        F.col("ts").alias("event_time"),
        "event_id",
    )


@query("table_stats", f"WITH {LOADS_SQL} SELECT {', '.join(monitoring.TABLE_STAT_COLUMNS)} FROM loads")
def table_stats(spark: SparkSession, folder: str) -> DataFrame:
    return monitoring.table_stats(load_events(spark, folder))


_RUNS_SQL = f"""SELECT run_id, 'nightly' AS pipeline,
  CASE WHEN count(*) FILTER (status = 'FAILED') > 0 THEN 'FAILED' ELSE 'COMPLETED' END AS status,
  count(DISTINCT table_name) AS tables_processed, cast(coalesce(sum(rows_loaded), 0) AS BIGINT) AS total_rows"""


@query(
    "run_stats_insert_once",
    f"""WITH {LOADS_SQL}, stored AS ({_RUNS_SQL}, TIMESTAMP '{FIRST_TS}' AS started_at FROM loads
    WHERE event_time < TIMESTAMP '2024-01-15' AND layer = 'raw' GROUP BY run_id),
runs AS ({_RUNS_SQL}, TIMESTAMP '{SECOND_TS}' AS started_at FROM loads GROUP BY run_id)
SELECT * FROM stored UNION ALL
SELECT * FROM runs r WHERE NOT EXISTS (SELECT 1 FROM stored s WHERE s.run_id = r.run_id)""",
)
def run_stats_insert_once(spark: SparkSession, folder: str) -> DataFrame:
    loads = load_events(spark, folder)
    early = loads.filter((F.col("event_time") < F.lit("2024-01-15").cast("timestamp_ntz")) & (F.col("layer") == "raw"))
    stored = monitoring.run_stats(early, "nightly", FIRST_TS)
    return monitoring.record_runs(stored, monitoring.run_stats(loads, "nightly", SECOND_TS))


@query(
    "anomalies",
    f"""WITH {LOADS_SQL}
SELECT run_id, layer, table_name, 'ERROR' AS level, 'rows_loaded' AS metric, 'Source has rows but nothing loaded' AS message
FROM loads WHERE rows_source > 0 AND rows_loaded = 0
UNION ALL SELECT run_id, layer, table_name, 'WARNING', 'volume_spike', 'Loaded rows unusually high' FROM loads
WHERE rows_loaded > cast(rows_source AS DOUBLE) * cast(1.2 AS DOUBLE)
UNION ALL SELECT run_id, layer, table_name, 'WARNING', 'duration', 'Table processing very slow' FROM loads WHERE duration_sec > 600""",
)
def anomalies(spark: SparkSession, folder: str) -> DataFrame:
    return monitoring.anomalies(load_events(spark, folder))


@query(
    "silent_merges",
    f"""WITH {LOADS_SQL} SELECT {", ".join(monitoring.TABLE_STAT_COLUMNS)} FROM loads
WHERE layer = 'ods' AND rows_source > 0 AND rows_loaded = 0""",
)
def silent_merges(spark: SparkSession, folder: str) -> DataFrame:
    return monitoring.silent_merges(monitoring.table_stats(load_events(spark, folder)))


@query(
    "load_volumetry",
    f"""WITH {LOADS_SQL}, t AS (SELECT *, rows_loaded + rows_failed AS total FROM loads)
SELECT run_id, layer, table_name, load_mode, rows_loaded, rows_failed, total AS total_rows_processed,
  round(CASE WHEN total > 0 THEN cast(rows_loaded * 100 AS DOUBLE) / total ELSE 0 END, 2) AS success_rate_pct,
  CASE WHEN rows_source > 0 AND rows_source <> total THEN rows_loaded - rows_source END AS row_delta,
  round(duration_sec, 2) AS duration_seconds,
  CASE WHEN duration_sec > 0 THEN cast(floor(rows_loaded / duration_sec) AS BIGINT) ELSE 0 END AS throughput_rows_per_sec,
  round(quality_score, 3) AS quality_score,
  CASE WHEN quality_score > 0.9 THEN 'good' WHEN quality_score > 0.7 THEN 'fair' WHEN quality_score IS NOT NULL THEN 'poor' END AS quality_band,
  left(error_message, 500) AS error, CASE WHEN error_message IS NULL THEN 'COMPLETED' ELSE 'FAILED' END AS status FROM t""",
)
def load_volumetry(spark: SparkSession, folder: str) -> DataFrame:
    return monitoring.load_volumetry(load_events(spark, folder))


@query(
    "run_metrics",
    f"""WITH {LOADS_SQL} SELECT run_id, layer, count(*) AS tables_count, count(*) FILTER (rows_failed = 0) AS success_count,
  count(*) FILTER (rows_failed > 0) AS failed_count, cast(sum(rows_loaded) AS BIGINT) AS total_rows_loaded,
  cast(sum(rows_failed) AS BIGINT) AS total_rows_failed, sum(duration_sec) AS total_duration, avg(quality_score) AS avg_quality
FROM loads GROUP BY run_id, layer""",
)
def run_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return monitoring.run_metrics(load_events(spark, folder))


@query(
    "run_metrics_by_table",
    f"""WITH {LOADS_SQL} SELECT run_id, table_name, rows_loaded, rows_failed, duration_sec, quality_score,
  CASE WHEN rows_failed = 0 THEN 'ok' ELSE 'warning (' || rows_failed || ' errors)' END AS status FROM loads
QUALIFY row_number() OVER (PARTITION BY run_id, table_name ORDER BY event_time DESC, event_id DESC) = 1""",
)
def run_metrics_by_table(spark: SparkSession, folder: str) -> DataFrame:
    return monitoring.run_metrics_by_table(load_events(spark, folder))


@query(
    "build_result_summary",
    """WITH r AS (SELECT 'run-' || strftime(ts, '%Y%m%d') AS run_id,
    CASE event_type WHEN 'view' THEN 'seed' WHEN 'click' THEN 'test' WHEN 'error' THEN 'test' ELSE 'model' END AS kind,
    CASE WHEN event_type = 'error' THEN 'fail' WHEN event_type = 'click' THEN 'pass' WHEN value > 10 THEN 'success' ELSE 'error' END AS status
    FROM events)
SELECT run_id, count(*) FILTER (kind = 'model') AS models_total, count(*) FILTER (kind = 'model' AND status = 'success') AS models_success,
  count(*) FILTER (kind = 'model' AND status <> 'success') AS models_failed, count(*) FILTER (kind = 'test') AS tests_total,
  count(*) FILTER (kind = 'test' AND status = 'pass') AS tests_passed, count(*) FILTER (kind = 'test' AND status <> 'pass') AS tests_failed
FROM r GROUP BY run_id""",
)
def build_result_summary(spark: SparkSession, folder: str) -> DataFrame:
    kind = by_value("event_type", {"view": "seed", "click": "test", "error": "test"}, "model")
    good = F.when(F.col("value") > 10, "success").otherwise("error")
    results = table(spark, folder, "events").select(
        F.concat(F.lit("run-"), F.date_format("ts", "yyyyMMdd")).alias("run_id"),
        F.concat_ws(".", kind, F.lit("warehouse"), F.concat(F.lit("node_"), "user_id")).alias("unique_id"),
        by_value("event_type", {"error": "fail", "click": "pass"}, good).alias("status"),
    )
    return monitoring.build_result_summary(results)


# -- file log ------------------------------------------------------------------------


@query(
    "file_log_append",
    f"""WITH {FILES_SQL} SELECT md5('/landing/' || file_name || 'run-1') AS log_id, file_name, '/landing/' || file_name AS file_path,
  table_name, load_mode, size_bytes AS file_size_bytes, 'PENDING' AS processing_status, TIMESTAMP '{FIRST_TS}' AS detected_at,
  cast(NULL AS TIMESTAMP) AS processed_at, cast(NULL AS BIGINT) AS row_count, cast(NULL AS VARCHAR) AS error_message FROM files""",
)
def file_log_append(spark: SparkSession, folder: str) -> DataFrame:
    files = landed_files(spark, folder).withColumn("path", F.concat(F.lit("/landing/"), "file_name"))
    return monitoring.file_log_rows(files, "run-1", FIRST_TS)


@query(
    "file_status_update",
    """WITH log AS (SELECT cast(o_orderkey AS VARCHAR) AS log_id, o_orderpriority AS table_name,
    CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' ELSE 'PENDING' END AS processing_status, o_orderdate AS detected_at,
    CASE o_orderstatus WHEN 'F' THEN o_orderdate END AS processed_at, o_custkey AS row_count, cast(NULL AS VARCHAR) AS error_message FROM orders),
u AS (SELECT cast(l_orderkey AS VARCHAR) AS log_id, CASE l_returnflag WHEN 'A' THEN 'COMPLETED' WHEN 'R' THEN 'FAILED' ELSE 'IN_PROGRESS' END AS status,
    CASE WHEN l_linestatus = 'O' THEN cast(l_quantity AS BIGINT) END AS row_count, CASE WHEN l_returnflag = 'R' THEN 'line ' || l_linenumber END AS error_message,
    l_shipdate AS updated_at FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY updated_at DESC, status DESC, row_count DESC NULLS LAST, error_message DESC NULLS LAST) = 1)
SELECT log.log_id, log.table_name, CASE WHEN u.log_id IS NULL THEN processing_status ELSE u.status END AS processing_status, detected_at,
  CASE WHEN u.status IN ('COMPLETED', 'FAILED') THEN u.updated_at ELSE processed_at END AS processed_at,
  coalesce(u.row_count, log.row_count) AS row_count,
  CASE WHEN u.log_id IS NULL THEN log.error_message ELSE u.error_message END AS error_message
FROM log LEFT JOIN u ON log.log_id = u.log_id""",
)
def file_status_update(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as log entries, their lines as status updates."""
    done = F.col("o_orderstatus") == "F"
    log = table(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("log_id"),
        F.col("o_orderpriority").alias("table_name"),
        F.when(done, "COMPLETED").otherwise("PENDING").alias("processing_status"),
        F.col("o_orderdate").alias("detected_at"),
        F.when(done, F.col("o_orderdate")).alias("processed_at"),
        F.col("o_custkey").alias("row_count"),
        F.lit(None).cast("string").alias("error_message"),
    )
    failed = F.col("l_returnflag") == "R"
    updates = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("log_id"),
        by_value("l_returnflag", {"A": "COMPLETED", "R": "FAILED"}, "IN_PROGRESS").alias("status"),
        F.when(F.col("l_linestatus") == "O", F.col("l_quantity").cast("bigint")).alias("row_count"),
        F.when(failed, F.concat(F.lit("line "), F.col("l_linenumber").cast("string"))).alias("error_message"),
        F.col("l_shipdate").alias("updated_at"),
    )
    return monitoring.update_file_status(log, updates)


# -- retention -------------------------------------------------------------------------

NOW = "2024-04-14 06:00:00"


@query(
    "retention_logs",
    f"SELECT * FROM events WHERE NOT (ts < TIMESTAMP '{NOW}' - INTERVAL 90 DAY)",
)
def retention_logs(spark: SparkSession, folder: str) -> DataFrame:
    return upkeep.purge(table(spark, folder, "events"), upkeep.expired_logs(NOW, "ts"))


_FILE_LOG_SQL = """log AS (SELECT o_orderkey AS log_id, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderdate END AS detected_at,
  CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'O' THEN 'PENDING' END AS processing_status FROM orders)"""
FILE_NOW = "1999-07-01 00:00:00"


def _file_log(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("log_id"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderdate")).alias("detected_at"),
        by_value("o_orderstatus", {"F": "COMPLETED", "O": "PENDING"}).alias("processing_status"),
    )


@query(
    "retention_file_log",
    f"""WITH {_FILE_LOG_SQL} SELECT * FROM log
WHERE NOT coalesce(detected_at < TIMESTAMP '{FILE_NOW}' - INTERVAL 180 DAY AND processing_status = 'COMPLETED', false)""",
)
def retention_file_log(spark: SparkSession, folder: str) -> DataFrame:
    return upkeep.purge(_file_log(spark, folder), upkeep.expired_files(FILE_NOW))


@query(
    "retention_counts",
    f"""WITH {_FILE_LOG_SQL}, x AS (SELECT coalesce(detected_at < TIMESTAMP '{FILE_NOW}' - INTERVAL 180 DAY
    AND processing_status = 'COMPLETED', false) AS expired FROM log)
SELECT count(*) FILTER (expired) AS deleted_records, count(*) FILTER (NOT expired) AS kept_records FROM x""",
)
def retention_counts(spark: SparkSession, folder: str) -> DataFrame:
    return upkeep.purge_counts(_file_log(spark, folder), upkeep.expired_files(FILE_NOW))


@query(
    "log_stats",
    """SELECT 'etl_run_log' AS log_name, count(*) AS total_rows, count(*) FILTER (ts > DATE '2024-02-14' - INTERVAL 30 DAY) AS recent_rows
FROM events UNION ALL SELECT 'load_step_log', count(*), count(*) FILTER (o_orderdate > DATE '1999-07-01' - INTERVAL 30 DAY) FROM orders""",
)
def log_stats(spark: SparkSession, folder: str) -> DataFrame:
    runs = upkeep.log_stats(table(spark, folder, "events"), "etl_run_log", "ts", "2024-02-14")
    steps = upkeep.log_stats(table(spark, folder, "orders"), "load_step_log", "o_orderdate", "1999-07-01")
    return runs.unionByName(steps)


@query("retention_stored_log", f"SELECT * FROM events WHERE NOT (ts < TIMESTAMP '{NOW}' - INTERVAL 90 DAY)")
def retention_stored_log(spark: SparkSession, folder: str) -> DataFrame:
    """A log stored day by day in two loads: old days go as folders, the day of the cutoff is rewritten."""
    layers = Layers(spark, work_dir(spark, "stored-log"))
    events = table(spark, folder, "events")
    layers.append_log("events", events.filter("event_type <> 'error'"), "run-1", "ts")
    layers.append_log("events", events.filter("event_type = 'error' OR event_type IS NULL"), "run-2", "ts")
    layers.purge_log("events", upkeep.expired_logs(NOW, "ts"), upkeep.cutoff(NOW, upkeep.LOG_RETENTION_DAYS))
    return layers.log_rows("events")
