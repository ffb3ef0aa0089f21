"""Stored logs by day, quality findings from one scan, catalog dumps in their order."""

from __future__ import annotations

import json
import os

from conftest import rows
from pyspark.sql import functions as F

from layerloom.operators import catalog, quality, upkeep
from layerloom.sources import landing_files
from layerloom.sources.layers import Layers

NOW = "2024-04-14 06:00:00"


def test_purge_drops_days_and_rewrites_the_mixed_one(spark, tmp_path):
    layers = Layers(spark, str(tmp_path))
    stamps = ["2024-01-03 01:00:00", "2024-01-15 05:59:59", "2024-01-15 06:00:00", "2024-02-01 00:00:00", None]
    log = spark.createDataFrame([(k, t) for k, t in enumerate(stamps)], "id int, t string").withColumn("ts", F.col("t").cast("timestamp_ntz"))
    layers.append_log("log", log, "run-1", "ts")
    layers.append_log("log", log.filter("id < 3").withColumn("id", F.col("id") + 10), "run-2", "ts")
    layers.append_log("log", log.filter("id = 3").withColumn("id", F.col("id") + 10), "run-2", "ts")  # the run again: its rows are replaced
    expired = upkeep.expired_logs(NOW, "ts")
    assert rows(layers.log_rows("log").select("id")) == [(0,), (1,), (13,), (2,), (3,), (4,)]
    later = tmp_path / "monitoring" / "log" / "_day=2024-02-01"
    before = sorted(p.stat().st_mtime_ns for p in later.rglob("*.parquet"))
    done = layers.purge_log("log", expired, upkeep.cutoff(NOW, 90))
    assert done == {"deleted_records": 2, "rewritten_days": 1}
    assert rows(layers.log_rows("log").select("id")) == [(13,), (2,), (3,), (4,)]
    assert not (tmp_path / "monitoring" / "log" / "_day=2024-01-03").exists()
    assert sorted(p.stat().st_mtime_ns for p in later.rglob("*.parquet")) == before
    assert not list((tmp_path / "monitoring" / "log").glob("_old-*"))
    assert layers.purge_log("log", expired, upkeep.cutoff(NOW, 90)) == {"deleted_records": 0, "rewritten_days": 0}
    # a condition beside the age keeps rows of old days
    layers.append_log("files", log.withColumn("done", F.col("id") == 0), "run-1", "ts")
    layers.purge_log("files", F.coalesce(expired & F.col("done"), F.lit(False)), upkeep.cutoff(NOW, 90))
    assert rows(layers.log_rows("files").select("id")) == [(1,), (2,), (3,), (4,)]


def test_findings_equal_the_cell_checks(spark):
    data = [
        ("a;b|c\t", 'say "x"', 1),
        (None, "plain", None),
        ("x" * 100_001, "back\\slash\n", 2),
        ("", "tab\there;", 3),
        ("[bracket] ^ -", "fine", 4),
    ]
    df = spark.createDataFrame(data, "`a.b` string, c string, n int").withColumn("row", F.monotonically_increasing_id())
    bad = df.withColumn("c", F.when(F.col("n") == 4, F.expr("cast(X'61ff62' as string)")).otherwise(F.col("c")))
    names = ["a.b", "c", "n"]
    tall = quality.cells(bad, F.col("row"), names)
    found = quality.findings(bad, F.col("row"), names, F.lit("f.parquet"))
    assert rows(quality.issues_of(found, "t").drop("file_name")) == rows(quality.issues(tall, "t"))
    assert rows(quality.summary_of(found)) == rows(quality.summary(tall))
    assert {r[0] for r in quality.issues_of(found, "t").filter("row_number > 0").select("file_name").collect()} == {"f.parquet"}
    empty = quality.findings(bad.limit(0), F.col("row"), names)
    assert quality.issues_of(empty, "t").isEmpty() and quality.summary_of(empty).isEmpty()


def test_findings_read_the_extract_once(spark, tmp_path):
    path = str(tmp_path / "extract")
    spark.createDataFrame([(1, "a;b"), (2, 'c"')], "id int, v string").write.parquet(path)
    found = quality.findings(spark.read.parquet(path), F.col("_metadata.row_index"), ["id", "v"], F.col("_metadata.file_name"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan and "Generate" not in plan


def test_the_last_repeat_of_a_dumped_column_counts(spark, tmp_path):
    def dump(name, age, *columns):
        path = tmp_path / f"{name}.metadata.json"
        path.write_text(json.dumps({"table_name": "client", "columns": [{"name": n, "type": t} for n, t in columns]}))
        os.utime(path, (1_700_000_000 + age, 1_700_000_000 + age))

    dump("z", 0, ("id", "ZZ"), ("old", "ZZ"))
    dump("a", 10, ("id", "YY"), ("id", "BB"))
    rows_of_dump = landing_files.read_catalog_dump(spark, str(tmp_path), ordered=True)
    known = spark.createDataFrame([("client", "id", "AA", "integer", True, 1, 1, 0, 5)], catalog.COLUMN_CATALOG_SCHEMA)
    got = catalog.catalog_upsert(known, rows_of_dump)
    assert rows(got.select("column_name", "data_type", "progress_order")) == [("id", "BB", 5), ("old", "ZZ", 0)]


def test_timed_stream_records_its_batches(spark, tmp_path):
    """Two intervals of a timed trigger, one file each; the log of batches can be searched for anomalies."""
    import time

    import pyarrow as pa
    import pyarrow.parquet as pq

    from layerloom.constants import ROW_POSITION
    from layerloom.operators import monitoring
    from layerloom.operators.scd2 import History
    from layerloom.streaming.feed import STREAM_STATS, feed_history, landed_stream

    landing, layers = tmp_path / "landing", Layers(spark, str(tmp_path / "warehouse"))
    landing.mkdir()
    stream = landed_stream(spark, str(landing), "id int, v string")
    table = History(keys=("id",), columns=("id", "v"), as_of=ROW_POSITION)
    feed = feed_history(stream, layers, "t", table, str(tmp_path / "checkpoint"), interval="1 second")

    def wait_for(loads):
        end = time.monotonic() + 90
        while time.monotonic() < end and len(layers.log("t")) < loads:
            time.sleep(0.3)

    try:
        for k, values in enumerate((["a", "b"], ["A"])):
            pq.write_table(pa.table({"id": pa.array(range(len(values)), pa.int32()), "v": values}), tmp_path / "f")
            os.rename(tmp_path / "f", landing / f"f{k}.parquet")
            wait_for(k + 1)
        feed.processAllAvailable()
    finally:
        feed.stop()
    assert rows(layers.live("t").select("id", "v")) == [(0, "A"), (1, "b")]
    stats = layers.read("monitoring", STREAM_STATS)
    assert rows(stats.select("layer", "rows_loaded")) == [("stream", 2), ("stream", 2)]
    slow = stats.withColumn("duration_sec", F.lit(601.0))
    assert monitoring.anomalies(stats).isEmpty() and monitoring.anomalies(slow).count() == 2
