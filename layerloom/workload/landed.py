"""Queries over real landing files, written from the given tables: inventory, whole runs, replay, late files, the stream."""

from __future__ import annotations

import json
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerloom.constants import EXTRACT_FILE, EXTRACTED_AT, FULL, INCREMENTAL, ROW_POSITION, RUN_ID, SOURCE_ROW
from layerloom.operators import catalog
from layerloom.plans.full_run import run
from layerloom.plans.history_load import load_history, replay_from_staging
from layerloom.session import work_dir
from layerloom.sources.landing_files import scan_landing
from layerloom.sources.layers import Layers
from layerloom.streaming.feed import feed_history, landed_stream
from layerloom.workload.histories import ORDER_COLUMNS, ORDERS, ORDERS_SQL, _hash_sql, orders_extract
from layerloom.workload.registry import FIRST_TS, SECOND_TS, THIRD_TS, query, table

GUARDED = replace(ORDERS, as_of=ROW_POSITION)
NAMES = ", ".join(ORDER_COLUMNS)


class LandingFolder:
    """Lays tables out as an extractor does: parquet files with JSON sidecars, through Hadoop's file system."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _move(self, source, target: str) -> None:
        self._fs.mkdirs(self._path(target).getParent())
        self._fs.rename(source, self._path(target))

    def write(self, target: str, content: bytes) -> None:
        out = self._fs.create(self._path(f"{self.root}/{target}"))
        out.write(bytearray(content))
        out.close()

    def put(self, base: str, rows: DataFrame) -> list[str]:
        """Base names of the extracts that hold the rows, one per partition."""
        part = f"{self.root}/part-{base}"
        rows.write.parquet(part)
        found = sorted(self._fs.globStatus(self._path(f"{part}/*.parquet")), key=lambda s: s.getPath().getName())
        names = [f"{base}_{k:05d}" for k in range(len(found))]
        for name, status in zip(names, found, strict=True):
            self._move(status.getPath(), f"{self.root}/parquet/{name}.parquet")
        return names

    def counts(self, names: list[str]) -> dict[str, int]:
        """Rows of landed files."""
        files = self.spark.read.parquet(*[f"{self.root}/parquet/{n}.parquet" for n in names])
        per_file = files.groupBy(F.col("_metadata.file_name").alias("f")).agg(F.count(F.lit(1)).alias("n"))
        return {r["f"].removesuffix(".parquet"): r["n"] for r in per_file.collect()}

    def describe(self, base: str, table_name: str, mode: str, extracted: str, rows: int, **more) -> None:
        metadata = {"table_name": table_name, "columns": [], "row_count": rows, "load_mode": mode, "extract_timestamp": extracted}
        self.write(f"metadata/{base}_metadata.json", json.dumps(metadata | more).encode())

    def land(self, base: str, table_name: str, rows: DataFrame, mode: str, extracted: str) -> list[str]:
        names = self.put(base, rows)
        counts = self.counts(names)
        for name in names:
            self.describe(name, table_name, mode, extracted, counts.get(name, 0))
        return names


# -- inventory of real files -----------------------------------------------------------


@query(
    "landing_scan",
    """SELECT 'customer' AS table_name, cast(NULL AS VARCHAR) AS skip_reason, count(*) AS actual_rows, 1 AS schemas FROM customer
UNION ALL SELECT 'lineitem', NULL, count(*), 1 FROM lineitem
UNION ALL SELECT 'orders', 'validation_failed', count(*), 1 FROM orders
UNION ALL SELECT 'part', 'validation_failed', count(*), 1 FROM part
UNION ALL SELECT 'events', 'validation_failed', NULL, 0
UNION ALL SELECT 'supplier', 'not_completed', NULL, 0
UNION ALL SELECT NULL, 'no_metadata', NULL, 0""",
)
def landing_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Sound extracts, one with a right checksum; a wrong count, a wrong checksum, damage, an unfinished one, one without sidecar."""
    landing = LandingFolder(spark, work_dir(spark, "landing-scan"))
    names = {t: landing.put(t, table(spark, folder, t)) for t in ("customer", "lineitem", "orders", "part", "supplier", "nation")}
    sums = spark.read.format("binaryFile").load([f"{landing.root}/parquet/{n}.parquet" for n in names["lineitem"]])
    sums = {r[0].rsplit("/", 1)[1].removesuffix(".parquet"): r[1] for r in sums.select("path", F.md5("content")).collect()}
    for table_name in ("customer", "lineitem", "orders", "part", "supplier"):
        for name, rows in landing.counts(names[table_name]).items():
            expected = rows * 2 + 100 if table_name == "orders" else rows
            checksum = {"lineitem": sums.get(name), "part": "0" * 32, "supplier": sums.get(name)}.get(table_name)
            more = {"file_info": {"checksum_md5": checksum}} if checksum else {}
            landing.describe(name, table_name, FULL, "2024-01-01T00:10:00", expected, **more)
            if table_name == "supplier":
                landing.write(f"status/{name}_status.json", json.dumps({"status": "extracting"}).encode())
    landing.write("parquet/events_0.parquet", b"PAR1 this is none PAR1")
    landing.describe("events_0", "events", FULL, "2024-01-01T00:10:00", 10)
    listing = scan_landing(spark, landing.root, FIRST_TS)
    return listing.groupBy("table_name", "skip_reason").agg(
        F.sum("actual_row_count").alias("actual_rows"), F.count_distinct("schema_print").cast("int").alias("schemas")
    )


# -- one order of versions over all loads -------------------------------------------------
# Three extracts of orders: all; the unsettled ones, dearer by 1; the urgent ones, dearer by 2.


def _dearer(rows: DataFrame, by: int) -> DataFrame:
    return rows.withColumn("o_totalprice", (F.col("o_totalprice") + by).cast("decimal(15,2)"))


def _placed(rows: DataFrame, extracted: str, file: str) -> DataFrame:
    at = {EXTRACTED_AT: F.lit(extracted).cast("timestamp_ntz"), EXTRACT_FILE: F.lit(file), SOURCE_ROW: F.col("o_orderkey")}
    return rows.withColumns(at)


def three_extracts(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    every = orders_extract(spark, folder)
    return every, _dearer(every.filter("o_orderstatus <> 'F'"), 1), _dearer(every.filter("o_orderpriority = '1-URGENT'"), 2)


def _newest_wins_sql(first: str, second: str, run: str) -> str:
    dearer = "CASE WHEN o_orderpriority = '1-URGENT' THEN 2 WHEN o_orderstatus <> 'F' THEN 1 ELSE 0 END"
    price = f"cast(o_totalprice + {dearer} AS DECIMAL(15,2)) AS o_totalprice"
    newest = ", ".join(price if c == "o_totalprice" else c for c in ORDER_COLUMNS)
    return f"""WITH {ORDERS_SQL},
newest AS (SELECT {newest}, {dearer} > 0 AS changed FROM extract)
SELECT e.{", e.".join(ORDER_COLUMNS)}, TIMESTAMP '{first}' AS _etl_valid_from,
       CASE WHEN changed THEN TIMESTAMP '{second}' END AS _etl_valid_to, NOT changed AS _etl_is_current,
       false AS _etl_is_deleted, {_hash_sql(tuple(f"e.{c}" for c in ORDER_COLUMNS))} AS _etl_hashdiff, 'run-1' AS _etl_run_id
FROM extract e JOIN newest n ON n.o_orderkey = e.o_orderkey
UNION ALL
SELECT {NAMES}, TIMESTAMP '{second}', NULL, true, false, {_hash_sql(ORDER_COLUMNS)}, '{run}' FROM newest WHERE changed"""


@query("replay_two_runs", _newest_wins_sql(FIRST_TS, THIRD_TS, "recovery-1"))
def replay_two_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Staging holds two runs, the first of two files; the history knows the first file only and is recovered."""
    layers = Layers(spark, work_dir(spark, "replay-two-runs"))
    first, second, third = three_extracts(spark, folder)
    one = _placed(first, "2024-01-01 00:10:00", "a")
    layers.stage("orders", one.unionByName(_placed(second, "2024-01-01 00:20:00", "b")), "run-1", reset=True)
    layers.stage("orders", _placed(third, "2024-01-02 00:10:00", "a"), "run-2", reset=False)
    load_history(layers, "orders", one, GUARDED, FULL, FIRST_TS, "run-1")
    replay_from_staging(layers, "orders", layers.read("staging", "orders"), GUARDED, THIRD_TS, "recovery-1")
    return layers.history("orders").drop(*ROW_POSITION)


@query(
    "late_file",
    f"""WITH {ORDERS_SQL}
SELECT {NAMES}, TIMESTAMP '{FIRST_TS}' AS _etl_valid_from, cast(NULL AS TIMESTAMP) AS _etl_valid_to, true AS _etl_is_current,
       false AS _etl_is_deleted, {_hash_sql(ORDER_COLUMNS)} AS _etl_hashdiff, 'run-1' AS _etl_run_id FROM extract WHERE o_orderstatus <> 'P'
UNION ALL
SELECT {NAMES}, TIMESTAMP '{THIRD_TS}', NULL, true, false, {_hash_sql(ORDER_COLUMNS)}, 'run-3'
FROM (SELECT {NAMES.replace("o_totalprice", "cast(o_totalprice + 1 AS DECIMAL(15,2)) AS o_totalprice")} FROM extract WHERE o_orderstatus = 'P')""",
)
def late_file(spark: SparkSession, folder: str) -> DataFrame:
    """An extract is confirmed by a second one; a third, taken between the two and loaded last, adds unknown keys only."""
    layers = Layers(spark, work_dir(spark, "late-file"))
    known = orders_extract(spark, folder).filter("o_orderstatus <> 'P'")
    late = _dearer(orders_extract(spark, folder), 1)
    load_history(layers, "orders", _placed(known, "2024-01-01 00:10:00", "a"), GUARDED, INCREMENTAL, FIRST_TS, "run-1")
    load_history(layers, "orders", _placed(known, "2024-01-03 00:10:00", "c"), GUARDED, INCREMENTAL, SECOND_TS, "run-2")
    load_history(layers, "orders", _placed(late, "2024-01-02 00:10:00", "b"), GUARDED, INCREMENTAL, THIRD_TS, "run-3")
    return layers.history("orders").drop(*ROW_POSITION)


@query("stream_two_files", f"SELECT * EXCLUDE (_etl_run_id) FROM ({_newest_wins_sql(FIRST_TS, SECOND_TS, 'run-2')})")
def stream_two_files(spark: SparkSession, folder: str) -> DataFrame:
    """One file, then two over the same keys in one micro-batch."""
    landing, files = LandingFolder(spark, work_dir(spark, "stream-two-files")), three_extracts(spark, folder)
    layers = Layers(spark, f"{landing.root}/layers")

    def drain(stamp: str) -> None:
        stream = landed_stream(spark, f"{landing.root}/parquet", files[0].schema)
        feed_history(stream, layers, "orders", GUARDED, f"{landing.root}/checkpoint", run_ts=lambda _: stamp).awaitTermination()

    landing.put("a", files[0])
    drain(FIRST_TS)
    # the newer file's name sorts first: its time of writing counts
    landing.put("z", files[1])
    landing.put("b", files[2])
    drain(SECOND_TS)
    return layers.history("orders").drop(*ROW_POSITION, RUN_ID)


# -- a whole run ------------------------------------------------------------------------------

RUN_COLUMNS = (
    ("o_orderkey", "BIGINT", "int64"), ("o_custkey", "BIGINT", "int64"), ("o_orderstatus", "TEXT", "character"),
    ("o_totalprice", "NUMERIC(15,2)", "decimal"), ("o_orderdate", "TIMESTAMP", "datetime"), ("o_orderpriority", "TEXT", "character"),
)


def _catalogs(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    tables = spark.createDataFrame([("orders", None, "o_orderkey", False, None, True)], catalog.TABLE_CATALOG_SCHEMA)
    columns = [
        ("orders", n, t, kind, False, 15 if kind == "decimal" else None, 2 if kind == "decimal" else None, 0, k)
        for k, (n, t, kind) in enumerate(RUN_COLUMNS)
    ]
    return tables, spark.createDataFrame(columns, catalog.COLUMN_CATALOG_SCHEMA)


@query(
    "full_run_incremental",
    f"SELECT * EXCLUDE (_etl_hashdiff, _etl_run_id), CASE _etl_run_id WHEN 'run-1' THEN 1 ELSE 2 END AS run FROM ({_newest_wins_sql(FIRST_TS, SECOND_TS, 'run-2')})",
)
def full_run_incremental(spark: SparkSession, folder: str) -> DataFrame:
    """Two runs over landing folders: a full extract, then two incremental ones of overlapping keys."""
    root = work_dir(spark, "full-run")
    layers, (first, second, third) = Layers(spark, f"{root}/warehouse"), three_extracts(spark, folder)
    one, two = LandingFolder(spark, f"{root}/day1"), LandingFolder(spark, f"{root}/day2")
    one.land("orders_a", "orders", first, FULL, "2024-01-01T00:10:00")
    run(spark, one.root, layers, *_catalogs(spark), "run-1", FIRST_TS)
    two.land("orders_z", "orders", second, INCREMENTAL, "2024-01-02T00:10:00")
    two.land("orders_b", "orders", third, INCREMENTAL, "2024-01-02T00:20:00")
    run(spark, two.root, layers, *_catalogs(spark), "run-2", SECOND_TS)
    ran: Column = F.when(F.col(RUN_ID) == "run-1", 1).otherwise(2).cast("int")
    return layers.history("orders").select(*ORDER_COLUMNS, "_etl_valid_from", "_etl_valid_to", "_etl_is_current", "_etl_is_deleted", ran.alias("run"))
