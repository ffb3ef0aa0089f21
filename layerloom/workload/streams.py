"""Stored histories: two loads through the store, and the file stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerloom.constants import FULL, INCREMENTAL, RUN_ID
from layerloom.plans.history_load import load_history
from layerloom.session import work_dir
from layerloom.sources.layers import Layers
from layerloom.streaming.feed import feed_history, landed_stream
from layerloom.workload.histories import (
    LINE_COLUMNS,
    LINE_KEYS,
    LINES,
    LINES_SQL,
    ORDER_COLUMNS,
    ORDERS,
    ORDERS_SQL,
    _hash_sql,
    _merge_sql,
    first_lines,
    first_orders,
    second_lines,
    second_orders,
)
from layerloom.workload.registry import FIRST_TS, SECOND_TS, query, table


@query("scd2_stored_history", _merge_sql(LINES_SQL, LINE_KEYS, LINE_COLUMNS, FULL))
def stored_history(spark: SparkSession, folder: str) -> DataFrame:
    layers = Layers(spark, work_dir(spark, "stored-history"))
    load_history(layers, "lines", first_lines(spark, folder), LINES, FULL, FIRST_TS, "run-1")
    load_history(layers, "lines", second_lines(spark, folder), LINES, FULL, SECOND_TS, "run-2")
    return layers.history("lines")


@query("scd2_compacted_history", _merge_sql(LINES_SQL, LINE_KEYS, LINE_COLUMNS, FULL))
def compacted_history(spark: SparkSession, folder: str) -> DataFrame:
    layers = Layers(spark, work_dir(spark, "compacted-history"))
    load_history(layers, "lines", first_lines(spark, folder), LINES, FULL, FIRST_TS, "run-1")
    load_history(layers, "lines", second_lines(spark, folder), LINES, FULL, SECOND_TS, "run-2", compact_after=1)
    return layers.history("lines")


@query("scd2_parted_history", _merge_sql(ORDERS_SQL, ORDERS.keys, ORDER_COLUMNS, INCREMENTAL))
def parted_history(spark: SparkSession, folder: str) -> DataFrame:
    """A history in many parts: a base, a load that touches all, compaction, removal of what is no longer reached."""
    layers = Layers(spark, work_dir(spark, "parted-history"), rows_per_part=1000)
    load_history(layers, "orders", first_orders(spark, folder), ORDERS, INCREMENTAL, FIRST_TS, "run-1")
    load_history(layers, "orders", second_orders(spark, folder), ORDERS, INCREMENTAL, SECOND_TS, "run-2", compact_after=1)
    layers.purge("orders", keep=0)
    return layers.history("orders")


@query(
    "stream_scd2",
    f"""WITH extract AS (SELECT o_orderkey, o_custkey, o_orderstatus, cast(o_totalprice AS DECIMAL(15,2)) AS o_totalprice,
       o_orderdate, o_orderpriority FROM orders)
SELECT {", ".join(ORDER_COLUMNS)}, TIMESTAMP '{FIRST_TS}' AS _etl_valid_from, cast(NULL AS TIMESTAMP) AS _etl_valid_to,
       true AS _etl_is_current, false AS _etl_is_deleted, {_hash_sql(ORDER_COLUMNS)} AS _etl_hashdiff FROM extract""",
)
def stream_scd2(spark: SparkSession, folder: str) -> DataFrame:
    root = work_dir(spark, "stream-scd2")
    layers = Layers(spark, f"{root}/layers")
    # a pattern, because the file source takes folders and patterns only
    stream = landed_stream(spark, f"{folder}/orders*.parquet", table(spark, folder, "orders").schema)

    def typed(rows: DataFrame) -> DataFrame:
        return rows.withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(15,2)"))

    feed = feed_history(stream, layers, "orders", ORDERS, f"{root}/checkpoint", typed, lambda _: FIRST_TS)
    feed.awaitTermination()
    return layers.live("orders").drop(RUN_ID)
