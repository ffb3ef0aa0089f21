"""Landing queries: every order stands for one landed file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerloom.operators import landing
from layerloom.operators.catalog import enrich
from layerloom.sources.landing_files import count_rows
from layerloom.workload.catalogs import TABLES_SQL, tables_catalog
from layerloom.workload.registry import FIRST_TS, by_value, query, table

FILES_SQL = """files AS (SELECT c_name AS table_name, CASE WHEN o_orderpriority = '2-HIGH' THEN 'cfg_' || c_name END AS config_name,
  coalesce(CASE WHEN o_orderpriority = '2-HIGH' THEN 'cfg_' || c_name END, c_name) AS physical_name,
  c_name || '_' || o_orderkey || '.parquet' AS file_name, o_orderdate AS extraction_date,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'FULL' WHEN '5-LOW' THEN 'FULL_RESET' ELSE 'INCREMENTAL' END AS load_mode,
  cast(cast(o_totalprice AS DECIMAL(15,2)) * 200 AS BIGINT) AS size_bytes
  FROM orders JOIN customer ON o_custkey = c_custkey)"""


def landed_files(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    customers = table(spark, folder, "customer").select("c_custkey", "c_name")
    config = F.when(F.col("o_orderpriority") == "2-HIGH", F.concat(F.lit("cfg_"), "c_name"))
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("c_name").alias("table_name"),
        config.alias("config_name"),
        F.coalesce(config, "c_name").alias("physical_name"),
        F.concat("c_name", F.lit("_"), F.col("o_orderkey").cast("string"), F.lit(".parquet")).alias("file_name"),
        F.col("o_orderdate").alias("extraction_date"),
        by_value("o_orderpriority", {"1-URGENT": "FULL", "5-LOW": "FULL_RESET"}, "INCREMENTAL").alias("load_mode"),
        (F.col("o_totalprice").cast("decimal(15,2)") * 200).cast("bigint").alias("size_bytes"),
    )


# Sidecars: an order with lines has metadata (no load mode if its priority is
# unspecified, an odd timestamp if it is low); a settled or pending order has a
# status file. The lines say how many rows the file holds.


@query(
    "landing_inventory",
    f"""WITH m AS (SELECT o_orderkey, min(o_orderpriority) AS p, min(o_orderdate) AS d, min(o_custkey) AS c, count(*) AS n,
    sum(cast(l_quantity AS BIGINT)) AS q, max(l_linenumber) AS w FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey),
f AS (SELECT o_orderkey, o_orderstatus AS s, o_orderpriority AS sp, 'c' || o_custkey || '_' || o_orderkey AS base_name,
    cast(cast(o_totalprice AS DECIMAL(15,2)) * 200 AS BIGINT) AS size_bytes FROM orders),
j AS (SELECT f.*, m.p, m.d, m.q, m.w, 'c' || m.c AS t, m.n * 25 AS expected, m.o_orderkey IS NOT NULL AS has_metadata,
    CASE WHEN m.w = 7 THEN 'c' || m.c || '_cfg' END AS config FROM f LEFT JOIN m ON f.o_orderkey = m.o_orderkey)
SELECT base_name, base_name || '.parquet' AS file_name, '/landing/' || base_name || '.parquet' AS path, size_bytes,
  t AS table_name, config AS config_name, coalesce(config, t) AS physical_name,
  coalesce(CASE WHEN s = 'F' AND sp = '1-URGENT' THEN 'FULL' END,
           CASE p WHEN '4-NOT SPECIFIED' THEN NULL WHEN '1-URGENT' THEN 'FULL_RESET' ELSE 'INCREMENTAL' END, 'INCREMENTAL') AS load_mode,
  CASE WHEN p IS NULL OR p = '5-LOW' THEN TIMESTAMP '{FIRST_TS}' ELSE d END AS extraction_date,
  expected AS row_count, cast(q AS BIGINT) AS actual_row_count, CASE WHEN has_metadata THEN w END AS column_count,
  CASE WHEN has_metadata THEN 'erp' ELSE 'unknown' END AS source, s <> 'O' AS has_status,
  CASE WHEN s = 'P' THEN 'Status: extracting' END AS status_error,
  CASE WHEN NOT has_metadata THEN 'no_metadata' WHEN p = '4-NOT SPECIFIED' THEN 'invalid_metadata' WHEN s = 'P' THEN 'not_completed'
       WHEN abs(q - expected) > greatest(10.0, expected * 0.01) THEN 'validation_failed' END AS skip_reason FROM j""",
)
def landing_inventory(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    base = F.concat(F.lit("c"), F.col("o_custkey").cast("string"), F.lit("_"), F.col("o_orderkey").cast("string"))
    named = orders.withColumn("base_name", base)
    file_name = F.concat("base_name", F.lit(".parquet"))
    files = named.select(
        "base_name",
        file_name.alias("file_name"),
        F.concat(F.lit("/landing/"), file_name).alias("path"),
        (F.col("o_totalprice").cast("decimal(15,2)") * 200).cast("bigint").alias("size_bytes"),
    )
    lines = table(spark, folder, "lineitem").groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("l_quantity").cast("bigint")).alias("q"),
        F.max("l_linenumber").alias("w"),
    )
    filled = named.join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
    owner = F.concat(F.lit("c"), F.col("o_custkey").cast("string"))
    low = F.col("o_orderpriority") == "5-LOW"
    modes = {"4-NOT SPECIFIED": None, "1-URGENT": "FULL_RESET"}
    metadata = filled.select(
        "base_name",
        F.lit(True).alias("readable"),
        owner.alias("table_name"),
        F.when(F.col("w") == 7, F.concat(owner, F.lit("_cfg"))).alias("config_name"),
        F.lit(None).cast("string").alias("physical_name"),
        by_value("o_orderpriority", modes, "INCREMENTAL").alias("load_mode"),
        (F.col("n") * 25).alias("row_count"),
        F.col("w").alias("column_count"),
        F.when(low, F.lit("unknown")).otherwise(F.col("o_orderdate").cast("string")).alias("extract_timestamp"),
        F.lit("erp").alias("source"),
        F.lit(None).cast("string").alias("checksum_md5"),
    )
    urgent = (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT")
    status = named.filter(F.col("o_orderstatus") != "O").select(
        "base_name",
        F.lit(True).alias("readable"),
        by_value("o_orderstatus", {"F": "completed", "P": "extracting"}).alias("status"),
        F.lit(None).cast("string").alias("error"),
        F.when(urgent, F.lit("FULL")).alias("load_mode"),
    )
    content = filled.select(
        "base_name",
        F.lit(True).alias("readable"),
        F.col("q").alias("actual_row_count"),
        F.lit(None).cast("string").alias("actual_md5"),
    )
    return landing.inventory(files, metadata, status, content, FIRST_TS)


# Files really on disk: the given tables, each declared with the row count of
# the table it should line up with.
DECLARED = {
    "customer": "customer",
    "orders": "orders",
    "lineitem": "lineitem",
    "events": "events",
    "documents": "documents",
    "labels": "documents",
    "embeddings": "documents",
    "conversations": "events",
    "supplier": "supplier",
    "part": "part",
    "nation": "nation",
    "region": "nation",
    "pages": "pages",
    "benchmark": "benchmark",
}


def _declared_sql() -> str:
    rows = [
        f"SELECT '{t}' AS base_name, (SELECT count(*) FROM {d}) AS e, (SELECT count(*) FROM {t}) AS a"
        for t, d in DECLARED.items()
    ]
    return " UNION ALL ".join(rows)


@query(
    "file_row_count_check",
    f"""WITH f AS ({_declared_sql()}),
c AS (SELECT *, e > 0 AND abs(a - e) > greatest(10.0, e * 0.01) AS off FROM f)
SELECT base_name, e AS expected_row_count, a AS actual_row_count, CASE WHEN off THEN 'row_count_mismatch' END AS problem,
       NOT off AS is_valid FROM c""",
)
def file_row_count_check(spark: SparkSession, folder: str) -> DataFrame:
    name = F.regexp_extract("file_path", r"([a-z]+)\.parquet", 1)
    # every table is one file or a folder of part files
    measured = count_rows(spark, *[f"{folder}/{t}.parquet" for t in DECLARED])
    content = measured.groupBy(name.alias("base_name")).agg(
        F.sum("actual_row_count").alias("actual_row_count"),
        F.lit(True).alias("readable"),
        F.lit(None).cast("string").alias("actual_md5"),
    )
    expected = None
    for owner, declared in DECLARED.items():
        row = table(spark, folder, declared).agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(owner).alias("base_name"), "row_count", F.lit(None).cast("string").alias("checksum_md5")
        )
        expected = row if expected is None else expected.unionByName(row)
    return landing.check_files(expected, content)


@query(
    "duplicate_files",
    f"""WITH {FILES_SQL} SELECT physical_name, count(*) AS file_count, arg_max(file_name, (extraction_date, file_name)) AS latest_file,
  max(extraction_date) AS latest_extraction FROM files GROUP BY physical_name HAVING count(*) > 1""",
)
def duplicate_files(spark: SparkSession, folder: str) -> DataFrame:
    return landing.duplicate_files(landed_files(spark, folder))


RESOLVE_SQL = f"""WITH {FILES_SQL}, r AS (SELECT *, count(*) OVER t AS n,
    first_value(load_mode) OVER (t ORDER BY extraction_date DESC, file_name DESC) AS newest_mode,
    row_number() OVER (t ORDER BY extraction_date DESC, file_name DESC) AS rn FROM files WINDOW t AS (PARTITION BY table_name)),
d AS (SELECT * EXCLUDE (n, newest_mode, rn), CASE WHEN n = 1 OR table_name = 'Customer#000000007' THEN 'kept'
    WHEN newest_mode IN ('FULL', 'FULL_RESET') THEN CASE WHEN rn = 1 THEN 'kept' ELSE 'superseded' END
    ELSE 'consolidated' END AS resolution FROM r)
SELECT *, CASE WHEN resolution = 'consolidated' THEN 'INCREMENTAL' ELSE load_mode END AS effective_mode FROM d"""


@query("resolve_file_sets", RESOLVE_SQL)
def resolve_file_sets(spark: SparkSession, folder: str) -> DataFrame:
    return landing.resolve_file_sets(landed_files(spark, folder), separate_tables=("Customer#000000007",))


@query(
    "consolidate_incremental",
    """WITH u AS (SELECT 'supplier' AS extract_name, s_suppkey AS party_key, s_name AS party_name, s_nationkey AS nation_key,
         cast(s_acctbal AS DECIMAL(15,2)) AS balance FROM supplier
  UNION ALL SELECT 'customer', c_custkey, c_name, c_nationkey, cast(c_acctbal AS DECIMAL(15,2)) FROM customer)
SELECT * FROM u""",
)
def consolidate_incremental(spark: SparkSession, folder: str) -> DataFrame:
    def extract(name: str, prefix: str, key: str) -> DataFrame:
        return table(spark, folder, name).select(
            F.lit(name).alias("extract_name"),
            F.col(f"{prefix}_{key}").alias("party_key"),
            F.col(f"{prefix}_name").alias("party_name"),
            F.col(f"{prefix}_nationkey").alias("nation_key"),
            F.col(f"{prefix}_acctbal").cast("decimal(15,2)").alias("balance"),
        )

    return landing.consolidate([extract("supplier", "s", "suppkey"), extract("customer", "c", "custkey")])


@query(
    "manifest_enriched",
    f"""WITH {FILES_SQL}, {TABLES_SQL}, a AS (SELECT coalesce(config_name, table_name) AS lookup_name, primary_key_cols,
    coalesce(has_timestamps, false) AS ts, coalesce(notes, '') AS description FROM tables WHERE is_active)
SELECT f.*, CASE WHEN a.primary_key_cols IS NULL THEN '' ELSE
    trim(split_part(primary_key_cols, ',', 1)) || '|' || trim(split_part(primary_key_cols, ',', 2)) END AS primary_keys,
  coalesce(ts, false) AS has_timestamps, false AS force_full, coalesce(description, '') AS table_description,
  a.lookup_name IS NOT NULL AS in_catalog
FROM files f LEFT JOIN a ON coalesce(f.config_name, f.table_name) = a.lookup_name""",
)
def manifest_enriched(spark: SparkSession, folder: str) -> DataFrame:
    rows = enrich(landed_files(spark, folder), tables_catalog(spark, folder))
    return rows.withColumn("primary_keys", F.array_join("primary_keys", "|"))


@query(
    "manifest_mode_stats",
    f"""WITH {FILES_SQL} SELECT load_mode, count(*) AS file_count, cast(sum(size_bytes) AS DOUBLE) / 1048576.0 AS total_size_mb
FROM files GROUP BY load_mode""",
)
def manifest_mode_stats(spark: SparkSession, folder: str) -> DataFrame:
    return landing.mode_stats(landed_files(spark, folder))


@query(
    "file_size_buckets",
    f"""WITH {FILES_SQL} SELECT CASE WHEN size_bytes / 1048576.0 < 5 THEN 'small' WHEN size_bytes / 1048576.0 < 50 THEN 'medium'
    ELSE 'large' END AS size_bucket, count(*) AS file_count, cast(sum(size_bytes) AS BIGINT) AS total_bytes FROM files GROUP BY 1""",
)
def file_size_buckets(spark: SparkSession, folder: str) -> DataFrame:
    return landing.size_buckets(landed_files(spark, folder))
