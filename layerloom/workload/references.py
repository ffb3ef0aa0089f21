"""Reference table queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerloom.operators import refdata
from layerloom.workload.registry import FIRST_TS, SECOND_TS, query, table


@query(
    "dim_time",
    """WITH b AS (SELECT make_date(year(min(o_orderdate)), 1, 1) AS a, make_date(year(max(o_orderdate)), 12, 31) AS z FROM orders),
d AS (SELECT cast(unnest(generate_series(a::TIMESTAMP, z::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS date_key FROM b)
SELECT date_key, cast(year(date_key) AS INTEGER) AS year, cast(quarter(date_key) AS INTEGER) AS quarter,
  cast(month(date_key) AS INTEGER) AS month, cast(day(date_key) AS INTEGER) AS day, cast(isodow(date_key) AS INTEGER) AS day_of_week,
  dayname(date_key) AS day_name, cast(weekofyear(date_key) AS INTEGER) AS week_of_year, isodow(date_key) >= 6 AS is_weekend FROM d""",
)
def dim_time(spark: SparkSession, folder: str) -> DataFrame:
    """The calendar over the years the orders span."""
    years = table(spark, folder, "orders").agg(F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("z"))
    return refdata.calendar(years.select(*refdata.year_bounds(F.year("a"), F.year("z"))))


@query(
    "currency_codes",
    f"""SELECT upper(l_returnflag || p_type) AS code, max(p_type || ' ' || l_returnflag) AS name,
  TIMESTAMP '{FIRST_TS}' AS updated_at FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""",
)
def currency_codes(spark: SparkSession, folder: str) -> DataFrame:
    """Return flag and part type as a code list."""
    parts = table(spark, folder, "part").select("p_partkey", "p_type")
    lines = table(spark, folder, "lineitem").join(parts, F.col("l_partkey") == F.col("p_partkey"))
    codes = lines.select(
        F.upper(F.concat("l_returnflag", "p_type")).alias("code"), F.concat_ws(" ", "p_type", "l_returnflag").alias("name")
    )
    return refdata.currency_codes(codes, FIRST_TS)


@query(
    "rates_upsert",
    f"""WITH r AS (SELECT upper(substr(o_orderpriority, 3, 3)) AS currency_code, cast(o_orderdate AS DATE) AS rate_date,
    cast(cast(max(o_totalprice) AS DECIMAL(15,2)) / 1000 AS DECIMAL(18,6)) AS rate, o_orderstatus = 'F' AS stored
    FROM orders GROUP BY ALL),
s AS (SELECT * FROM r WHERE stored), u AS (SELECT * FROM r WHERE NOT stored)
SELECT coalesce(s.currency_code, u.currency_code) AS currency_code, coalesce(u.rate, s.rate) AS rate, 'EUR' AS base_currency,
  coalesce(s.rate_date, u.rate_date) AS rate_date,
  CASE WHEN u.rate IS NULL THEN TIMESTAMP '{FIRST_TS}' ELSE TIMESTAMP '{SECOND_TS}' END AS updated_at
FROM s FULL JOIN u ON s.currency_code = u.currency_code AND s.rate_date = u.rate_date""",
)
def rates_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """Settled orders give the stored rates, open ones the new rates."""
    stored = F.col("o_orderstatus") == "F"
    rates = (
        table(spark, folder, "orders")
        .groupBy(
            F.upper(F.substring("o_orderpriority", 3, 3)).alias("currency_code"),
            F.to_date("o_orderdate").alias("rate_date"),
            stored.alias("stored"),
        )
        .agg((F.max("o_totalprice").cast("decimal(15,2)") / 1000).cast("decimal(18,6)").alias("rate"))
    )
    old = refdata.rate_rows(rates.filter("stored"), FIRST_TS)
    return refdata.upsert_rates(old, rates.filter("not stored"), SECOND_TS)
