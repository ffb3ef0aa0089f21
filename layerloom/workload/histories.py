"""History queries over orders (unique key) and lineitem (repeated keys)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerloom.constants import FULL, FULL_RESET, HASHDIFF, INCREMENTAL
from layerloom.functions.hashing import hashdiff
from layerloom.operators import monitoring, scd2, upkeep
from layerloom.operators.keyed import latest_per_key
from layerloom.operators.scd2 import History
from layerloom.workload.registry import FIRST_TS, SECOND_TS, THIRD_TS, query, table

# -- orders: one row per key ----------------------------------------------------
# First extract: settled orders (O, F). Second extract: open ones (P, O), where
# urgent orders cost one more. So P is new, F is gone, urgent O changed.

ORDER_COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
ORDERS = History(keys=("o_orderkey",), columns=ORDER_COLUMNS)


def orders_extract(spark: SparkSession, folder: str) -> DataFrame:
    price = F.col("o_totalprice").cast("decimal(15,2)")
    return table(spark, folder, "orders").select(*ORDER_COLUMNS).withColumn("o_totalprice", price)


def first_orders(spark: SparkSession, folder: str) -> DataFrame:
    return orders_extract(spark, folder).filter(F.col("o_orderstatus") != "P")


def second_orders(spark: SparkSession, folder: str) -> DataFrame:
    raised = (F.col("o_totalprice") + 1).cast("decimal(15,2)")
    price = F.when(F.col("o_orderpriority") == "1-URGENT", raised).otherwise(F.col("o_totalprice"))
    return orders_extract(spark, folder).filter(F.col("o_orderstatus") != "F").withColumn("o_totalprice", price)


def orders_history(spark: SparkSession, folder: str) -> DataFrame:
    return scd2.open_versions(first_orders(spark, folder), ORDERS, FIRST_TS, "run-1")


def orders_merged(spark: SparkSession, folder: str, mode: str) -> DataFrame:
    return scd2.merge(
        orders_history(spark, folder), second_orders(spark, folder), ORDERS, mode, SECOND_TS, "run-2"
    )


# -- lineitem: several rows per key, some with a NULL key part ------------------
# First extract: returned or accepted lines, loaded without dedup. Second:
# open lines, newest ship date per key. Line number 7 stands for "unknown".

LINE_KEYS = ("l_orderkey", "l_linenumber")
LINE_COLUMNS = (*LINE_KEYS, "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag", "l_shipdate")
LINE_ORDER = ("l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_returnflag")
LINES = History(keys=LINE_KEYS, columns=LINE_COLUMNS, order=LINE_ORDER)


def lines_extract(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        *LINE_COLUMNS, "l_linestatus"
    ).withColumns(
        {
            "l_linenumber": F.nullif(F.col("l_linenumber"), F.lit(7)),
            "l_quantity": F.col("l_quantity").cast("decimal(15,2)"),
            "l_extendedprice": F.col("l_extendedprice").cast("decimal(15,2)"),
        }
    )


def first_lines(spark: SparkSession, folder: str) -> DataFrame:
    return lines_extract(spark, folder).filter(F.col("l_returnflag") != "N").select(*LINE_COLUMNS)


def second_lines(spark: SparkSession, folder: str) -> DataFrame:
    chosen = (F.col("l_linestatus") == "O") | (F.col("l_returnflag") == "N")
    return lines_extract(spark, folder).filter(chosen).select(*LINE_COLUMNS)


def lines_history(spark: SparkSession, folder: str) -> DataFrame:
    return scd2.open_versions(first_lines(spark, folder), LINES, FIRST_TS, "run-1")


# -- SQL counterparts ------------------------------------------------------------


def _hash_sql(columns: tuple[str, ...]) -> str:
    return "md5(" + " || ".join(f"coalesce(cast({c} AS VARCHAR), '')" for c in columns) + ")"


ORDERS_SQL = f"""
extract AS (SELECT o_orderkey, o_custkey, o_orderstatus, cast(o_totalprice AS DECIMAL(15,2)) AS o_totalprice,
                   o_orderdate, o_orderpriority FROM orders),
first AS (SELECT * FROM extract WHERE o_orderstatus <> 'P'),
second AS (SELECT o_orderkey, o_custkey, o_orderstatus,
                  cast(CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice + 1 ELSE o_totalprice END
                       AS DECIMAL(15,2)) AS o_totalprice,
                  o_orderdate, o_orderpriority FROM extract WHERE o_orderstatus <> 'F'),
ods AS (SELECT *, {_hash_sql(ORDER_COLUMNS)} AS h FROM first),
src AS (SELECT *, {_hash_sql(ORDER_COLUMNS)} AS h FROM second)"""

LINES_SQL = f"""
extract AS (SELECT l_orderkey, nullif(l_linenumber, 7) AS l_linenumber, l_partkey, l_suppkey,
                   cast(l_quantity AS DECIMAL(15,2)) AS l_quantity,
                   cast(l_extendedprice AS DECIMAL(15,2)) AS l_extendedprice,
                   l_returnflag, l_shipdate, l_linestatus FROM lineitem),
first AS (SELECT * EXCLUDE (l_linestatus) FROM extract WHERE l_returnflag <> 'N'),
second AS (SELECT * EXCLUDE (l_linestatus) FROM extract WHERE l_linestatus = 'O' OR l_returnflag = 'N'),
ods AS (SELECT *, {_hash_sql(LINE_COLUMNS)} AS h FROM first),
src AS (SELECT *, {_hash_sql(LINE_COLUMNS)} AS h FROM second
        QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                   ORDER BY {", ".join(f"{c} DESC" for c in LINE_ORDER)}) = 1)"""


def _versions(columns: tuple[str, ...], source: str, ts: str, run: str) -> str:
    return f"""SELECT {", ".join(columns)}, TIMESTAMP '{ts}' AS _etl_valid_from, cast(NULL AS TIMESTAMP) AS _etl_valid_to,
       true AS _etl_is_current, false AS _etl_is_deleted, h AS _etl_hashdiff, '{run}' AS _etl_run_id FROM {source}"""


def _flags(inputs: str, keys: tuple[str, ...], mode: str) -> str:
    """Which stored rows a merge closes or deletes, which source rows it inserts."""
    same_key = " AND ".join(f"o.{k} = s.{k}" for k in keys)
    null_key = " OR ".join(f"{k} IS NULL" for k in keys)
    missing = f"NOT EXISTS (SELECT 1 FROM src s WHERE {same_key})" if mode == FULL else "false"
    return f"""WITH {inputs},
flagged AS (SELECT o.*,
                   EXISTS (SELECT 1 FROM src s WHERE {same_key} AND o.h IS DISTINCT FROM s.h) AS closed,
                   {missing} AS missing
            FROM ods o),
inserted AS (SELECT s.*, {f"({null_key})" if mode == FULL else "false"} AS lost FROM src s
             WHERE NOT EXISTS (SELECT 1 FROM ods o WHERE {same_key} AND o.h = s.h))"""


def _merge_sql(inputs: str, keys: tuple[str, ...], columns: tuple[str, ...], mode: str) -> str:
    names = ", ".join(columns)
    return f"""{_flags(inputs, keys, mode)}
SELECT {names}, TIMESTAMP '{FIRST_TS}' AS _etl_valid_from,
       CASE WHEN closed OR missing THEN TIMESTAMP '{SECOND_TS}' END AS _etl_valid_to,
       NOT (closed OR missing) AS _etl_is_current, missing AS _etl_is_deleted,
       h AS _etl_hashdiff, 'run-1' AS _etl_run_id FROM flagged
UNION ALL
SELECT {names}, TIMESTAMP '{SECOND_TS}', CASE WHEN lost THEN TIMESTAMP '{SECOND_TS}' END,
       NOT lost, lost, h, 'run-2' FROM inserted"""


def _stats_sql(inputs: str, keys: tuple[str, ...], mode: str) -> str:
    same_key = " AND ".join(f"o.{k} = s.{k}" for k in keys)
    return f"""{_flags(inputs, keys, mode)},
n AS (SELECT (SELECT count(*) FROM flagged WHERE closed) AS closed,
             (SELECT count(*) FROM flagged WHERE missing) + (SELECT count(*) FROM inserted WHERE lost) AS deleted,
             (SELECT count(*) FROM inserted) AS inserted,
             (SELECT count(*) FROM src s WHERE NOT EXISTS (SELECT 1 FROM ods o WHERE {same_key})) AS fresh)
SELECT closed + inserted + deleted AS total_rows, fresh AS new_records, closed AS updated_records,
       closed AS closed_records, inserted AS inserted_records, deleted AS deleted_records FROM n"""


ORDERS_FULL_SQL = _merge_sql(ORDERS_SQL, ORDERS.keys, ORDER_COLUMNS, FULL)

# -- queries -----------------------------------------------------------------------


@query(
    "latest_per_key",
    """SELECT * FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC,
           l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) = 1""",
)
def latest_lines(spark: SparkSession, folder: str) -> DataFrame:
    order = (
        "l_shipdate l_partkey l_suppkey l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus".split()
    )
    return latest_per_key(table(spark, folder, "lineitem"), LINE_KEYS, [F.desc(c) for c in order])


@query(
    "hashdiff",
    f"""WITH {ORDERS_SQL}, c AS (SELECT c_custkey, c_name, c_nationkey, cast(c_acctbal AS DECIMAL(15,2)) AS c_acctbal,
       c_mktsegment FROM customer)
SELECT 'orders' AS table_name, o_orderkey AS row_key,
       {_hash_sql(tuple(c for c in ORDER_COLUMNS if c != "o_orderdate"))} AS _etl_hashdiff FROM extract
UNION ALL
SELECT 'customer', c_custkey,
       {_hash_sql(("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"))} FROM c""",
)
def content_hashes(spark: SparkSession, folder: str) -> DataFrame:
    orders = orders_extract(spark, folder).withColumnRenamed("o_orderdate", "dat_mod")
    customers = table(spark, folder, "customer").withColumn("c_acctbal", F.col("c_acctbal").cast("decimal(15,2)"))
    frames = (("orders", "o_orderkey", orders), ("customer", "c_custkey", customers))
    hashed = [
        df.select(F.lit(name).alias("table_name"), F.col(key).alias("row_key"), hashdiff(df.columns).alias(HASHDIFF))
        for name, key, df in frames
    ]
    return hashed[0].unionByName(hashed[1])


@query(
    "scd2_initial",
    f"""WITH {ORDERS_SQL}, every AS (SELECT *, {_hash_sql(ORDER_COLUMNS)} AS h FROM extract)
{_versions(ORDER_COLUMNS, "every", FIRST_TS, "run-1")}""",
)
def initial(spark: SparkSession, folder: str) -> DataFrame:
    return scd2.merge(None, orders_extract(spark, folder), ORDERS, INCREMENTAL, FIRST_TS, "run-1")


@query(
    "scd2_full_reset",
    f"""WITH {LINES_SQL}, every AS (SELECT * EXCLUDE (l_linestatus), {_hash_sql(LINE_COLUMNS)} AS h FROM extract)
{_versions(LINE_COLUMNS, "every", SECOND_TS, "run-2")}""",
)
def full_reset(spark: SparkSession, folder: str) -> DataFrame:
    batch = lines_extract(spark, folder).select(*LINE_COLUMNS)
    return scd2.merge(lines_history(spark, folder), batch, LINES, FULL_RESET, SECOND_TS, "run-2")


@query(
    "scd2_close",
    f"SELECT * FROM ({_merge_sql(LINES_SQL, LINE_KEYS, LINE_COLUMNS, INCREMENTAL)}) WHERE NOT _etl_is_current",
)
def close(spark: SparkSession, folder: str) -> DataFrame:
    return scd2.close_changed(lines_history(spark, folder), second_lines(spark, folder), LINES, SECOND_TS)


@query(
    "scd2_insert",
    f"SELECT * FROM ({_merge_sql(LINES_SQL, LINE_KEYS, LINE_COLUMNS, FULL)}) WHERE _etl_run_id = 'run-2'",
)
def insert(spark: SparkSession, folder: str) -> DataFrame:
    return scd2.insert_versions(
        lines_history(spark, folder), second_lines(spark, folder), LINES, SECOND_TS, "run-2", FULL
    )


@query(
    "scd2_soft_delete",
    f"""SELECT * FROM ({_merge_sql(LINES_SQL, LINE_KEYS, LINE_COLUMNS, FULL)})
WHERE _etl_is_deleted AND _etl_run_id = 'run-1'""",
)
def soft_delete(spark: SparkSession, folder: str) -> DataFrame:
    return scd2.soft_delete(lines_history(spark, folder), second_lines(spark, folder), LINES, SECOND_TS)


@query("scd2_merge_incremental", _merge_sql(ORDERS_SQL, ORDERS.keys, ORDER_COLUMNS, INCREMENTAL))
def merge_incremental(spark: SparkSession, folder: str) -> DataFrame:
    return orders_merged(spark, folder, INCREMENTAL)


@query("scd2_merge_full", ORDERS_FULL_SQL)
def merge_full(spark: SparkSession, folder: str) -> DataFrame:
    return orders_merged(spark, folder, FULL)


@query("scd2_merge_repeated_keys", _merge_sql(LINES_SQL, LINE_KEYS, LINE_COLUMNS, FULL))
def merge_repeated_keys(spark: SparkSession, folder: str) -> DataFrame:
    return scd2.merge(
        lines_history(spark, folder), second_lines(spark, folder), LINES, FULL, SECOND_TS, "run-2"
    )


@query("scd2_stats", _stats_sql(LINES_SQL, LINE_KEYS, FULL))
def stats(spark: SparkSession, folder: str) -> DataFrame:
    return scd2.merge_stats(lines_history(spark, folder), second_lines(spark, folder), LINES, FULL)


@query(
    "scd2_decision",
    f"""WITH {ORDERS_SQL}, merged AS ({ORDERS_FULL_SQL}),
newest AS (SELECT * FROM merged QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY _etl_valid_from DESC) = 1),
coming AS (SELECT o_orderkey, {_hash_sql(ORDER_COLUMNS)} AS incoming_hash FROM extract)
SELECT c.o_orderkey, n._etl_hashdiff AS existing_hash, c.incoming_hash,
       CASE WHEN n._etl_is_deleted THEN 'insert' WHEN n._etl_hashdiff IS NULL THEN 'insert'
            WHEN NOT n._etl_is_current THEN 'insert' WHEN n._etl_hashdiff <> c.incoming_hash THEN 'close'
            ELSE 'noop' END AS action
FROM coming c LEFT JOIN newest n ON c.o_orderkey = n.o_orderkey""",
)
def decision(spark: SparkSession, folder: str) -> DataFrame:
    return scd2.decisions(orders_merged(spark, folder, FULL), orders_extract(spark, folder), ORDERS)


@query("ods_current", f"SELECT * FROM ({ORDERS_FULL_SQL}) WHERE _etl_is_current AND NOT _etl_is_deleted")
def current(spark: SparkSession, folder: str) -> DataFrame:
    return scd2.current_view(orders_merged(spark, folder, FULL))


@query(
    "recovery_replay",
    f"""{_flags(ORDERS_SQL, ORDERS.keys, FULL)}
SELECT {", ".join(ORDER_COLUMNS)}, TIMESTAMP '{FIRST_TS}' AS _etl_valid_from,
       CASE WHEN closed THEN TIMESTAMP '{SECOND_TS}' WHEN missing THEN TIMESTAMP '{THIRD_TS}' END AS _etl_valid_to,
       NOT (closed OR missing) AS _etl_is_current, missing AS _etl_is_deleted,
       h AS _etl_hashdiff, 'run-1' AS _etl_run_id FROM flagged
UNION ALL
SELECT {", ".join(ORDER_COLUMNS)}, TIMESTAMP '{SECOND_TS}', NULL, true, false, h, 'run-2' FROM inserted""",
)
def replay(spark: SparkSession, folder: str) -> DataFrame:
    stored = orders_merged(spark, folder, INCREMENTAL)
    return upkeep.replay(stored, second_orders(spark, folder), ORDERS, THIRD_TS, "recovery-1")


@query(
    "consistency_check",
    f"""WITH {ORDERS_SQL}, merged AS ({ORDERS_FULL_SQL}),
n AS (SELECT (SELECT count(*) FROM second) AS staging_count,
             (SELECT count(*) FROM merged WHERE _etl_is_current AND NOT _etl_is_deleted) AS ods_count)
SELECT staging_count, ods_count, staging_count = ods_count AS is_consistent FROM n""",
)
def consistency(spark: SparkSession, folder: str) -> DataFrame:
    return upkeep.consistency_check(second_orders(spark, folder), orders_merged(spark, folder, FULL))


@query(
    "scd2_run_totals",
    f"""WITH o AS ({_stats_sql(ORDERS_SQL, ORDERS.keys, FULL)}), l AS ({_stats_sql(LINES_SQL, LINE_KEYS, FULL)}),
u AS (SELECT * FROM o UNION ALL SELECT * FROM l)
SELECT 'run-2' AS run_id, count(*) AS tables_count, cast(sum(total_rows) AS BIGINT) AS total_rows,
       cast(sum(new_records) AS BIGINT) AS new_records, cast(sum(updated_records) AS BIGINT) AS updated_records,
       cast(sum(closed_records) AS BIGINT) AS closed_records, cast(sum(deleted_records) AS BIGINT) AS deleted_records
FROM u""",
)
def run_totals(spark: SparkSession, folder: str) -> DataFrame:
    orders = scd2.merge_stats(orders_history(spark, folder), second_orders(spark, folder), ORDERS, FULL)
    lines = scd2.merge_stats(lines_history(spark, folder), second_lines(spark, folder), LINES, FULL)
    return monitoring.scd2_run_totals(orders.unionByName(lines).withColumn("run_id", F.lit("run-2")))
