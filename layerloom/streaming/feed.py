"""Landed files as a stream of history loads.

The file source's checkpoint tracks which files are done; each micro-batch is
one history load whose run id is the batch id, so a batch replayed after a
failure is recognised and skipped.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from layerloom.constants import COMPLETED, EXTRACT_FILE, EXTRACTED_AT, INCREMENTAL, SOURCE_ROW
from layerloom.operators.scd2 import History
from layerloom.plans.history_load import load_history
from layerloom.operators.monitoring import TABLE_STAT_SCHEMA
from layerloom.sources.layers import Layers

STREAM_STATS = "stream_stats"


def _now(_: int) -> datetime:
    return datetime.now(UTC).replace(tzinfo=None)


def landed_stream(spark: SparkSession, path: str, schema, max_files: int | None = None) -> DataFrame:
    """New parquet files under ``path``, oldest first.

    Rows carry ROW_POSITION: when their file was written, its path, and the row
    in it, so files of one micro-batch have an order too.
    """
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    written = F.col("_metadata.file_modification_time")
    return reader.parquet(path).select(
        "*",
        F.convert_timezone(F.current_timezone(), F.lit("UTC"), written.cast("timestamp_ntz")).alias(EXTRACTED_AT),
        F.col("_metadata.file_path").alias(EXTRACT_FILE),
        F.col("_metadata.row_index").alias(SOURCE_ROW),
    )


def feed_history(
    stream: DataFrame,
    layers: Layers,
    name: str,
    table: History,
    checkpoint: str,
    prepare: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    run_ts: Callable[[int], datetime | str] = _now,
    mode: str = INCREMENTAL,
    interval: str | None = None,
) -> StreamingQuery:
    """Start the feed: everything available once, or every ``interval``.

    ``prepare`` turns the landed rows into staging rows and keeps ROW_POSITION,
    by which the newest row of a key wins within a batch. A table with
    ``as_of=ROW_POSITION`` also holds against files that come late. Each batch
    adds its rows and duration to the stored log ``STREAM_STATS``, in the layout
    of table statistics, so anomalies can be looked for there as well.
    """

    def load(rows: DataFrame, batch_id: int) -> None:
        # The query's id is part of the run's: a new checkpoint counts its batches from 0 again.
        query_id = rows.sparkSession.read.json(f"{checkpoint}/metadata").first()["id"]
        run_id = f"{name}-{query_id}-batch-{batch_id}"
        started = time.monotonic()
        merged = load_history(layers, name, prepare(rows), table, mode, run_ts(batch_id), run_id)
        seconds = time.monotonic() - started
        entry = (run_id, "stream", name, merged["total_rows"], merged["total_rows"], 0, seconds, mode, COMPLETED, None)
        layers.append("monitoring", STREAM_STATS, rows.sparkSession.createDataFrame([entry], TABLE_STAT_SCHEMA), run_id)

    writer = stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.trigger(**trigger).start()
