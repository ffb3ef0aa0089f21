"""A whole run: landing folder to history, table by table.

The driver holds the manifest (one entry per table to load) and starts one
chain of Spark jobs per entry; rows never pass through it. A failing table is
recorded and the others go on.
"""

from __future__ import annotations

import time
from collections import Counter
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerloom.constants import COMPLETED, EXTRACT_FILE, FAILED, FILE_LOG_ID, FULL_RESET, ROW_POSITION, SOURCE_ROW
from layerloom.operators import landing, monitoring, quality, raw, staging
from layerloom.operators.catalog import TableSpec, enrich, load_spec
from layerloom.operators.scd2 import History
from layerloom.plans.history_load import load_history
from layerloom.sources.landing_files import SCANNED_PATH, positioned, read_file_set, scan_landing
from layerloom.sources.layers import Layers

# Tables loaded at a time.
CONCURRENT_TABLES = 4

OUTCOME_SCHEMA = "path string, status string, error_message string"


@dataclass(frozen=True)
class FileSet:
    """The files of one table that one load reads.

    ``load_id`` is the run id, with a number added where a run loads the same
    table more than once.
    """

    load_id: str
    table_name: str
    config_name: str | None
    physical_name: str
    load_mode: str
    paths: tuple[str, ...]
    extracted: tuple[datetime, ...] = ()
    schemas: int = 1
    incomplete: bool = False


def history_of(spec: TableSpec) -> History:
    """Newest row wins: the file of the latest extraction, then the later row of a file; over all loads."""
    return History(
        keys=spec.primary_keys,
        as_of=ROW_POSITION,
        columns=tuple(c.name for c in spec.columns),
        hash_columns=spec.hash_columns(),
    )


def file_sets(resolved: DataFrame, run_id: str) -> list[FileSet]:
    """The manifest: consolidated files of a table together, so the parts of one extract; other kept files one by one."""
    joint = F.col("resolution") == "consolidated"
    part = landing.part_of_extract(F.col("effective_mode"))
    rows = (
        resolved.filter(F.col("resolution") != "superseded")
        .groupBy(
            "physical_name",
            F.when(joint | part, F.lit(None)).otherwise(F.col("path")).alias("single"),
            F.when(part, F.struct("extraction_date", "effective_mode")).alias("extract"),
        )
        .agg(
            F.max(F.struct("extraction_date", "file_name", "table_name", "config_name", "effective_mode")).alias("m"),
            F.array_sort(F.collect_list(F.struct("extraction_date", "file_name", "path"))).alias("files"),
            F.count_distinct("schema_print").alias("schemas"),
            F.bool_or(part & F.col("is_incomplete")).alias("incomplete"),
        )
        .orderBy("physical_name", "m.extraction_date", "m.file_name")
    )
    seen: Counter[str] = Counter()
    sets = []
    for r in rows.collect():
        newest = r["m"]
        name = r["physical_name"]
        load_id = f"{run_id}.{seen[name]}" if seen[name] else run_id
        seen[name] += 1
        paths, extracted = (tuple(f[c] for f in r["files"]) for c in ("path", "extraction_date"))
        names = newest["table_name"], newest["config_name"], name
        sets.append(FileSet(load_id, *names, newest["effective_mode"], paths, extracted, r["schemas"], r["incomplete"]))
    return sets


def quality_report(layers: Layers, extract: DataFrame, name: str, load_id: str) -> None:
    """All issues of the whole extract, and its report; a bad report does not stop the load. One scan of the extract."""
    file = F.col("_metadata.file_name")
    found = quality.findings(extract, F.col("_metadata.row_index") + 1, extract.columns, file)
    layers.append("monitoring", "quality_findings", found, f"{load_id}-{name}")
    stored = layers.load_rows("monitoring", "quality_findings", f"{load_id}-{name}")
    layers.append("monitoring", "quality_issues", quality.issues_of(stored, name), f"{load_id}-{name}")
    layers.append("monitoring", "quality_reports", quality.report(quality.summary_of(stored), name), f"{load_id}-{name}")


def load_table(
    layers: Layers,
    files: FileSet,
    spec: TableSpec,
    run_id: str,
    run_ts: str,
    quarantine: bool = False,
    check_quality: bool = False,
) -> list[tuple]:
    """One table through raw, staging and history; its statistics rows."""
    spark, name = layers.spark, spec.physical_name
    stats: list[tuple] = []

    def record(layer: str, source: int, loaded: int, failed: int, started: float) -> None:
        seconds = time.monotonic() - started
        stats.append((run_id, layer, name, source, loaded, failed, seconds, files.load_mode, COMPLETED, None))

    started = time.monotonic()
    if files.incomplete:
        raise ValueError(f"other parts of the extract may not be loaded: {', '.join(files.paths)}")
    if files.schemas > 1:
        raise ValueError(f"the files of one set have different schemas: {', '.join(files.paths)}")
    extract = read_file_set(spark, files.paths, checked=True)
    if check_quality:
        quality_report(layers, extract, name, files.load_id)
    placed = positioned(extract, files.paths, files.extracted)
    raw_name = raw.raw_table_name(spec.table_name, spec.config_name)
    rows = raw.to_raw(placed, run_ts, F.col(EXTRACT_FILE), monitoring.file_log_id(F.col(SCANNED_PATH), run_id), drop=(SCANNED_PATH,))
    layers.replace("raw", raw_name, rows)
    stored = layers.read("raw", raw_name)
    raw_count = stored.count()
    counts = stored.groupBy(F.col(FILE_LOG_ID).alias("log_id")).agg(F.count(F.lit(1)).alias("row_count"))
    layers.append("monitoring", "file_rows", counts, f"{files.load_id}-{name}")
    record("raw", raw_count, raw_count, 0, started)

    started = time.monotonic()
    good, failed = stored, 0
    if quarantine:
        checked = staging.with_cast_error(stored, spec.columns)
        bad = raw.load_errors(checked, name, F.col(SOURCE_ROW))
        layers.append("raw", "raw_load_errors", bad, f"{files.load_id}-{name}")
        good = raw.accepted(checked)
        failed = layers.load_rows("raw", "raw_load_errors", f"{files.load_id}-{name}").count()
    table = history_of(spec)
    typed = staging.to_staging(good, spec.columns, files.load_id, run_ts, table.hash_columns)
    batch = layers.stage(name, typed, files.load_id, reset=files.load_mode == FULL_RESET)
    staged = batch.count()
    record("staging", raw_count, staged, failed, started)

    started = time.monotonic()
    merged = load_history(layers, name, batch, table, files.load_mode, run_ts, files.load_id)
    record("ods", staged, merged["total_rows"], 0, started)
    return stats


def findings_of(stats: DataFrame) -> DataFrame:
    """Anomalies of recorded table statistics, and a warning for each merge that changed nothing."""
    silent = monitoring.silent_merges(stats).select(
        "run_id", "layer", "table_name", *[F.lit(text).alias(n) for text, n in zip(monitoring.NOTHING_CHANGED, ("level", "metric", "message"), strict=True)]
    )
    return monitoring.anomalies(stats).unionByName(silent)


def status_updates(layers: Layers, outcomes: DataFrame, run_id: str) -> DataFrame:
    """File status updates of a run: the outcome of each loaded file and its rows in the raw layer."""
    updates = outcomes.select(
        monitoring.file_log_id(F.col("path"), run_id).alias("log_id"),
        "status",
        "error_message",
        F.current_timestamp().cast("timestamp_ntz").alias("updated_at"),
    )
    counted = layers.find("monitoring", "file_rows")
    if counted is None:
        return updates.withColumn("row_count", F.lit(None).cast("bigint"))
    return updates.join(counted.groupBy("log_id").agg(F.max("row_count").alias("row_count")), "log_id", "left")


def run(
    spark: SparkSession,
    landing_root: str,
    layers: Layers,
    tables: DataFrame,
    columns: DataFrame,
    run_id: str,
    run_ts: str,
    only: list[str] | None = None,
    quarantine: bool = False,
    check_quality: bool = False,
    concurrent_tables: int = CONCURRENT_TABLES,
) -> DataFrame:
    """Load everything that has landed; returns the run's table statistics.

    Tables are loaded ``concurrent_tables`` at a time, each in a scheduler pool
    of its own name, so small tables fill the cores that the tail of a large
    one leaves idle. Loads of one table keep their order.
    """
    # the inventory may have read every landed byte, so it is stored once and read back
    scanned = scan_landing(spark, landing_root, run_ts, tables=only)
    layers.append("monitoring", "inventory", scanned, run_id)
    listing = layers.load_rows("monitoring", "inventory", run_id, scanned.schema)
    ready = enrich(landing.discovered(landing.mark_incomplete(listing)), tables)
    resolved = landing.resolve_file_sets(ready, group_by="physical_name", in_parts=True)
    log = monitoring.file_log_rows(ready, run_id, run_ts)
    layers.append("monitoring", "file_log", log, run_id)

    def load_sets(sets: list[FileSet]) -> list[tuple[FileSet, list[tuple], str | None]]:
        """The file sets of one table, in their order; a failure is kept to its set."""
        done = []
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", sets[0].physical_name)
        for files in sets:
            started = time.monotonic()
            try:
                spec = load_spec(tables, columns, files.table_name, files.config_name)
                if spec is None:
                    raise LookupError(f"table not in catalog: {files.physical_name}")
                done.append((files, load_table(layers, files, spec, run_id, run_ts, quarantine, check_quality), None))
            except Exception as error:  # noqa: BLE001 - one table must not stop the run
                seconds = time.monotonic() - started
                message = str(error)[: monitoring.ERROR_LENGTH]
                failed = (run_id, "run", files.physical_name, 0, 0, 0, seconds, files.load_mode, FAILED, message)
                done.append((files, [failed], message))
        return done

    by_table: dict[str, list[FileSet]] = {}
    for files in file_sets(resolved, run_id):
        by_table.setdefault(raw.raw_table_name(files.table_name, files.config_name), []).append(files)
    with ThreadPoolExecutor(max_workers=max(1, concurrent_tables)) as pool:
        loads = [load for chain in pool.map(inheritable_thread_target(spark)(load_sets), by_table.values()) for load in chain]
    stats = [row for _, rows, _ in loads for row in rows]
    outcomes = [(path, COMPLETED if error is None else FAILED, error) for files, _, error in loads for path in files.paths]

    updates = status_updates(layers, spark.createDataFrame(outcomes, OUTCOME_SCHEMA), run_id)
    layers.append("monitoring", "file_log", monitoring.update_file_status(log, updates), run_id)
    rows = spark.createDataFrame(stats, monitoring.TABLE_STAT_SCHEMA)
    layers.append("monitoring", "table_stats", rows, run_id)
    recorded = layers.load_rows("monitoring", "table_stats", run_id)
    layers.append("monitoring", "runs", monitoring.run_stats(recorded, "full_load", run_ts), run_id)
    layers.append("monitoring", "anomalies", findings_of(recorded), run_id)
    return recorded
