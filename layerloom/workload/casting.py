"""Array splitting and cast rules over rendered text cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerloom.functions.casts import to_boolean, to_number, to_temporal, to_text
from layerloom.operators.catalog import TargetColumn
from layerloom.operators.staging import split_extents, typed
from layerloom.workload.registry import by_value, query, table

# -- array columns: the measures of a line packed into one text cell ------------

PACKED_SQL = """packed AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  concat_ws(';', cast(cast(l_quantity AS DECIMAL(15,2)) AS VARCHAR), ' ' || cast(cast(l_extendedprice AS DECIMAL(15,2)) AS VARCHAR),
            CASE WHEN l_discount = 0 THEN '?' ELSE cast(cast(l_discount AS DECIMAL(15,2)) AS VARCHAR) END,
            CASE WHEN l_tax = 0 THEN '' ELSE cast(cast(l_tax AS DECIMAL(15,2)) AS VARCHAR) END) AS measures,
  concat_ws(';', l_returnflag || ' ', l_linestatus, CASE l_returnflag WHEN 'R' THEN 'yes' WHEN 'A' THEN 'F' ELSE '?' END) AS marks,
  concat_ws(';', strftime(l_shipdate, '%m/%d/%Y'), strftime(l_shipdate, '%Y-%m-%d'), '?') AS days
  FROM lineitem)"""


def packed_lines(spark: SparkSession, folder: str) -> DataFrame:
    def money(name: str) -> Column:
        return F.col(name).cast("decimal(15,2)").cast("string")

    measures = F.concat_ws(
        ";",
        money("l_quantity"),
        F.concat(F.lit(" "), money("l_extendedprice")),
        F.when(F.col("l_discount") == 0, "?").otherwise(money("l_discount")),
        F.when(F.col("l_tax") == 0, "").otherwise(money("l_tax")),
    )
    flag = by_value("l_returnflag", {"R": "yes", "A": "F"}, "?")
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        measures.alias("measures"),
        F.concat_ws(";", F.concat("l_returnflag", F.lit(" ")), "l_linestatus", flag).alias("marks"),
        F.concat_ws(
            ";", F.date_format("l_shipdate", "MM/dd/yyyy"), F.date_format("l_shipdate", "yyyy-MM-dd"), F.lit("?")
        ).alias("days"),
    )


def elements(source: str, *types: str) -> list[TargetColumn]:
    return [TargetColumn(source, i, f"{source}_{i}", t) for i, t in enumerate(types, 1)]


LINE_ID = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query(
    "extent_split",
    f"""WITH {PACKED_SQL} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  {", ".join(f"split_part(measures, ';', {i}) AS measures_{i}" for i in range(1, 6))}, marks FROM packed""",
)
def extent_split(spark: SparkSession, folder: str) -> DataFrame:
    columns = [*elements("measures", *["TEXT"] * 5), TargetColumn("marks", 0, "marks", "TEXT")]
    return split_extents(packed_lines(spark, folder), columns, LINE_ID)


@query(
    "extent_typed",
    f"""WITH {PACKED_SQL}, p AS (SELECT *, trim(split_part(measures, ';', 1)) AS m1, trim(split_part(measures, ';', 2)) AS m2,
  trim(split_part(measures, ';', 3)) AS m3, trim(split_part(measures, ';', 4)) AS m4, trim(split_part(measures, ';', 5)) AS m5,
  lower(trim(split_part(marks, ';', 3))) AS b3 FROM packed)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  {", ".join(f"cast(CASE WHEN m{i} IN ('', '?') THEN NULL ELSE m{i} END AS DECIMAL(17,{s})) AS measures_{i}"
             for i, s in ((1, 2), (2, 2), (3, 4), (4, 1), (5, 2)))},
  trim(split_part(marks, ';', 1)) AS marks_1, trim(split_part(marks, ';', 2)) AS marks_2,
  CASE WHEN b3 IN ('true', 't', '1', 'yes') THEN true WHEN b3 IN ('false', 'f', '0', 'no', '') THEN false END AS flags_3,
  cast(strptime(split_part(days, ';', 1), '%m/%d/%Y') AS DATE) AS days_1,
  cast(split_part(days, ';', 2) AS TIMESTAMP) AS days_2, cast(NULL AS DATE) AS days_3 FROM p""",
)
def extent_typed(spark: SparkSession, folder: str) -> DataFrame:
    columns = [
        *elements("measures", "NUMERIC(17,2)", "NUMERIC(17,2)", "NUMERIC(17,4)", "NUMERIC(17,1)", "NUMERIC(17,2)"),
        *elements("marks", "VARCHAR(1)", "VARCHAR(1)"),
        TargetColumn("marks", 3, "flags_3", "BOOLEAN"),
        *elements("days", "DATE", "TIMESTAMP", "DATE"),
    ]
    return typed(packed_lines(spark, folder), columns, LINE_ID)


# -- scalar rules ------------------------------------------------------------------


@query(
    "cast_numeric",
    """WITH t AS (SELECT event_id, CASE event_type WHEN 'error' THEN '?' WHEN 'signup' THEN ''
         WHEN 'click' THEN '  ' || cast(cast(value AS DECIMAL(12,2)) AS VARCHAR) || ' '
         ELSE cast(cast(value AS DECIMAL(12,2)) AS VARCHAR) END AS amount,
       CASE event_type WHEN 'view' THEN ' ? ' ELSE cast(user_id AS VARCHAR) || ' ' END AS user_no FROM events)
SELECT event_id, cast(CASE WHEN trim(amount) IN ('', '?') THEN NULL ELSE trim(amount) END AS DECIMAL(12,1)) AS amount,
       cast(CASE WHEN trim(user_no) IN ('', '?') THEN NULL ELSE trim(user_no) END AS INTEGER) AS user_int,
       cast(CASE WHEN trim(user_no) IN ('', '?') THEN NULL ELSE trim(user_no) END AS BIGINT) AS user_long FROM t""",
)
def cast_numeric(spark: SparkSession, folder: str) -> DataFrame:
    value = F.col("value").cast("decimal(12,2)").cast("string")
    amount = by_value(
        "event_type", {"error": "?", "signup": "", "click": F.concat(F.lit("  "), value, F.lit(" "))}, value
    )
    user = by_value("event_type", {"view": " ? "}, F.concat(F.col("user_id").cast("string"), F.lit(" ")))
    return table(spark, folder, "events").select(
        "event_id",
        to_number(amount, "NUMERIC(12,1)").alias("amount"),
        to_number(user, "INTEGER").alias("user_int"),
        to_number(user, "BIGINT").alias("user_long"),
    )


@query(
    "cast_boolean",
    """WITH t AS (SELECT event_id, CASE event_type WHEN 'error' THEN ' TRUE ' WHEN 'signup' THEN 'No' WHEN 'click' THEN ' '
         WHEN 'view' THEN '?' END AS flag, CASE WHEN value < 10 THEN 't' WHEN value < 20 THEN '0' WHEN value < 40 THEN 'yes'
         WHEN value < 80 THEN 'F' ELSE 'maybe' END AS mark FROM events)
SELECT event_id, CASE WHEN lower(trim(flag)) IN ('true', 't', '1', 'yes') THEN true
            WHEN lower(trim(flag)) IN ('false', 'f', '0', 'no', '') THEN false END AS flag,
       CASE WHEN lower(trim(mark)) IN ('true', 't', '1', 'yes') THEN true
            WHEN lower(trim(mark)) IN ('false', 'f', '0', 'no', '') THEN false END AS mark FROM t""",
)
def cast_boolean(spark: SparkSession, folder: str) -> DataFrame:
    flag = by_value("event_type", {"error": " TRUE ", "signup": "No", "click": " ", "view": "?"})
    value = F.col("value")
    mark = (
        F.when(value < 10, "t").when(value < 20, "0").when(value < 40, "yes").when(value < 80, "F").otherwise("maybe")
    )
    return table(spark, folder, "events").select(
        "event_id", to_boolean(flag).alias("flag"), to_boolean(mark).alias("mark")
    )


@query(
    "cast_date",
    """WITH t AS (SELECT o_orderkey, o_orderpriority AS p, o_orderdate FROM orders)
SELECT o_orderkey,
  CASE WHEN p IN ('1-URGENT', '2-HIGH') THEN NULL ELSE cast(o_orderdate AS DATE) END AS order_day,
  CASE WHEN p IN ('1-URGENT', '2-HIGH') THEN NULL WHEN p = '3-MEDIUM' THEN date_trunc('day', o_orderdate)
       ELSE o_orderdate END AS order_time FROM t""",
)
def cast_date(spark: SparkSession, folder: str) -> DataFrame:
    slashed = F.concat(F.lit(" "), F.date_format("o_orderdate", "MM/dd/yyyy"))
    choices = {"1-URGENT": " ", "2-HIGH": "?", "3-MEDIUM": slashed}
    cell = by_value("o_orderpriority", choices, F.col("o_orderdate").cast("string"))
    return table(spark, folder, "orders").select(
        "o_orderkey", to_temporal(cell, "DATE").alias("order_day"), to_temporal(cell, "TIMESTAMP").alias("order_time")
    )


@query(
    "cast_text",
    """SELECT conv_id, turn, nullif(trim(CASE role WHEN 'system' THEN '  ' ELSE '  ' || role || ' ' END), '') AS role,
       nullif(trim(text), '') AS body, left(nullif(trim(text), ''), 120) AS headline FROM conversations""",
)
def cast_text(spark: SparkSession, folder: str) -> DataFrame:
    role = by_value("role", {"system": "  "}, F.concat(F.lit("  "), F.col("role"), F.lit(" ")))
    return table(spark, folder, "conversations").select(
        "conv_id",
        "turn",
        to_text(role).alias("role"),
        to_text(F.col("text"), "TEXT").alias("body"),
        to_text(F.col("text"), "VARCHAR(120)").alias("headline"),
    )
