"""Catalog queries: customers stand for catalog tables, parts for catalog columns."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerloom.operators import catalog
from layerloom.workload.registry import by_value, query, table

TABLES_SQL = """tables AS (SELECT c_name AS table_name, CASE WHEN c_acctbal > 5000 THEN 'cfg_' || c_name END AS config_name,
  CASE WHEN c_mktsegment = 'MACHINERY' THEN NULL ELSE 'c_custkey , ' || lower(c_mktsegment) END AS primary_key_cols,
  CASE WHEN c_nationkey > 3 THEN c_nationkey > 12 END AS has_timestamps,
  CASE WHEN c_nationkey > 8 THEN c_mktsegment END AS notes, c_acctbal >= 0 AS is_active FROM customer)"""

COLUMNS_SQL = """columns AS (SELECT p_brand AS table_name, replace(p_name, ' ', '_') || '_' || p_partkey AS column_name,
  CASE p_type WHEN 'LARGE' THEN 'INTEGER' WHEN 'PROMO' THEN 'BIT' WHEN 'SMALL' THEN NULL ELSE 'TEXT' END AS data_type,
  CASE p_type WHEN 'MEDIUM' THEN 'character' WHEN 'STANDARD' THEN 'Decimal' WHEN 'LARGE' THEN 'integer' WHEN 'PROMO' THEN 'logical'
              WHEN 'SMALL' THEN 'date' WHEN 'ECONOMY' THEN 'datetime-tz' END AS progress_type,
  p_retailprice > 950 AS is_mandatory, cast(floor(p_retailprice) AS INTEGER) AS width,
  CASE WHEN p_size > 10 THEN cast(floor(p_size / 10) AS INTEGER) END AS scale,
  CASE WHEN p_size > 25 THEN p_size - 25 END AS extent, cast(p_partkey AS INTEGER) AS progress_order FROM part)"""


def tables_catalog(spark: SparkSession, folder: str) -> DataFrame:
    keys = F.concat(F.lit("c_custkey , "), F.lower("c_mktsegment"))
    return table(spark, folder, "customer").select(
        F.col("c_name").alias("table_name"),
        F.when(F.col("c_acctbal") > 5000, F.concat(F.lit("cfg_"), "c_name")).alias("config_name"),
        F.when(F.col("c_mktsegment") != "MACHINERY", keys).alias("primary_key_cols"),
        F.when(F.col("c_nationkey") > 3, F.col("c_nationkey") > 12).alias("has_timestamps"),
        F.when(F.col("c_nationkey") > 8, F.col("c_mktsegment")).alias("notes"),
        (F.col("c_acctbal") >= 0).alias("is_active"),
    )


def columns_catalog(spark: SparkSession, folder: str) -> DataFrame:
    kinds = {
        "MEDIUM": "character",
        "STANDARD": "Decimal",
        "LARGE": "integer",
        "PROMO": "logical",
        "SMALL": "date",
        "ECONOMY": "datetime-tz",
    }
    size = F.col("p_size")
    return table(spark, folder, "part").select(
        F.col("p_brand").alias("table_name"),
        F.concat_ws("_", F.replace("p_name", F.lit(" "), F.lit("_")), "p_partkey").alias("column_name"),
        by_value("p_type", {"LARGE": "INTEGER", "PROMO": "BIT", "SMALL": None}, "TEXT").alias("data_type"),
        by_value("p_type", kinds).alias("progress_type"),
        (F.col("p_retailprice") > 950).alias("is_mandatory"),
        F.floor("p_retailprice").cast("int").alias("width"),
        F.when(size > 10, F.floor(size / 10).cast("int")).alias("scale"),
        F.when(size > 25, size - 25).alias("extent"),
        F.col("p_partkey").cast("int").alias("progress_order"),
    )


@query(
    "catalog_lookup",
    f"""WITH {TABLES_SQL} SELECT coalesce(config_name, table_name) AS lookup_name, table_name, config_name,
  CASE WHEN primary_key_cols IS NULL THEN '' ELSE
    trim(split_part(primary_key_cols, ',', 1)) || '|' || trim(split_part(primary_key_cols, ',', 2)) END AS primary_keys,
  coalesce(has_timestamps, false) AS has_timestamps, false AS force_full, coalesce(notes, '') AS description
FROM tables WHERE is_active
QUALIFY row_number() OVER (PARTITION BY coalesce(config_name, table_name)
  ORDER BY table_name, config_name NULLS FIRST, coalesce(notes, '')) = 1""",
)
def catalog_lookup(spark: SparkSession, folder: str) -> DataFrame:
    found = catalog.catalog_lookup(tables_catalog(spark, folder))
    return found.withColumn("primary_keys", F.array_join("primary_keys", "|"))


@query(
    "active_tables",
    f"WITH {TABLES_SQL} SELECT coalesce(config_name, table_name) AS lookup_name FROM tables WHERE is_active ORDER BY table_name",
)
def active_tables(spark: SparkSession, folder: str) -> DataFrame:
    return catalog.active_tables(tables_catalog(spark, folder))


@query(
    "catalog_expand",
    f"""WITH {COLUMNS_SQL}, c AS (SELECT *, coalesce(extent, 0) AS n, lower(coalesce(progress_type, 'character')) AS kind,
    cast(floor(width / nullif(extent, 0)) AS INTEGER) AS share FROM columns),
e AS (SELECT c.*, unnest(CASE WHEN n > 0 THEN range(1, n + 1) ELSE [0] END) AS i FROM c)
SELECT table_name, progress_order, column_name AS source_column, cast(i AS INTEGER) AS element,
  CASE WHEN i > 0 THEN column_name || '_' || i ELSE column_name END AS target_column,
  CASE WHEN i = 0 THEN CASE WHEN upper(coalesce(data_type, 'TEXT')) IN ('BIT', 'LOGICAL') THEN 'BOOLEAN'
                            ELSE coalesce(data_type, 'TEXT') END
       WHEN kind IN ('character', 'clob') THEN CASE WHEN share > 0 AND share < 10000 THEN 'VARCHAR(' || share || ')' ELSE 'TEXT' END
       WHEN kind = 'integer' THEN 'INTEGER' WHEN kind = 'int64' THEN 'BIGINT'
       WHEN kind = 'decimal' THEN CASE WHEN share > 0 AND scale IS NOT NULL THEN 'NUMERIC(' || share || ',' || scale || ')'
            WHEN scale IS NOT NULL THEN 'NUMERIC(17,' || scale || ')' ELSE 'NUMERIC' END
       WHEN kind = 'logical' THEN 'BOOLEAN' WHEN kind = 'date' THEN 'DATE'
       WHEN kind IN ('datetime', 'datetime-tz') THEN 'TIMESTAMP' ELSE 'TEXT' END AS target_type,
  coalesce(is_mandatory, false) AS is_mandatory FROM e""",
)
def catalog_expand(spark: SparkSession, folder: str) -> DataFrame:
    return catalog.expand(columns_catalog(spark, folder))


@query(
    "catalog_widths",
    f"""WITH {COLUMNS_SQL} SELECT table_name, count(*) AS column_count, count(*) FILTER (coalesce(extent, 0) > 0) AS extent_column_count,
  cast(sum(CASE WHEN coalesce(extent, 0) > 0 THEN extent ELSE 1 END) AS BIGINT) AS expanded_column_count,
  count(*) FILTER (is_mandatory) AS mandatory_column_count FROM columns GROUP BY table_name""",
)
def catalog_widths(spark: SparkSession, folder: str) -> DataFrame:
    return catalog.widths(columns_catalog(spark, folder))


@query(
    "catalog_validate",
    f"""WITH {COLUMNS_SQL}, tables AS (SELECT s_name AS table_name FROM supplier UNION ALL SELECT DISTINCT table_name FROM columns)
SELECT table_name, cast(NULL AS INTEGER) AS progress_order, 'Empty columns list' AS error FROM tables t
WHERE NOT EXISTS (SELECT 1 FROM columns c WHERE c.table_name = t.table_name)
UNION ALL SELECT table_name, progress_order, 'missing field ''column_name''' FROM columns WHERE column_name IS NULL
UNION ALL SELECT table_name, progress_order, 'missing field ''data_type''' FROM columns WHERE data_type IS NULL
UNION ALL SELECT table_name, progress_order, 'missing field ''progress_type''' FROM columns WHERE progress_type IS NULL""",
)
def catalog_validate(spark: SparkSession, folder: str) -> DataFrame:
    columns = columns_catalog(spark, folder)
    suppliers = table(spark, folder, "supplier").select(F.col("s_name").alias("table_name"))
    return catalog.validate(suppliers.unionByName(columns.select("table_name").distinct()), columns)


@query(
    "catalog_upsert",
    f"""WITH {COLUMNS_SQL}, dump AS (
  SELECT table_name, column_name, 'NUMERIC(' || width || ',2)' AS data_type, CASE WHEN scale > 2 THEN true END AS is_mandatory,
         width + 1 AS width, 2 AS scale, progress_order + 100 AS progress_order FROM columns WHERE extent IS NULL
  UNION ALL SELECT 'supplier', s_name, 'TEXT', s_acctbal > 0, s_nationkey, NULL, NULL FROM supplier)
SELECT c.table_name, c.column_name, CASE WHEN d.column_name IS NULL THEN c.data_type ELSE d.data_type END AS data_type,
       c.progress_type, CASE WHEN d.column_name IS NULL THEN c.is_mandatory ELSE coalesce(d.is_mandatory, false) END AS is_mandatory,
       CASE WHEN d.column_name IS NULL THEN c.width ELSE d.width END AS width,
       CASE WHEN d.column_name IS NULL THEN c.scale ELSE d.scale END AS scale, c.extent, c.progress_order
FROM columns c LEFT JOIN dump d ON c.table_name = d.table_name AND c.column_name = d.column_name
UNION ALL
SELECT table_name, column_name, data_type, NULL, coalesce(is_mandatory, false), width, scale, NULL, coalesce(progress_order, 0)
FROM dump d WHERE NOT EXISTS (SELECT 1 FROM columns c WHERE c.table_name = d.table_name AND c.column_name = d.column_name)""",
)
def catalog_upsert(spark: SparkSession, folder: str) -> DataFrame:
    columns = columns_catalog(spark, folder)
    changed = columns.filter(F.col("extent").isNull()).select(
        "table_name",
        "column_name",
        F.concat(F.lit("NUMERIC("), F.col("width").cast("string"), F.lit(",2)")).alias("data_type"),
        F.when(F.col("scale") > 2, True).alias("is_mandatory"),
        (F.col("width") + 1).alias("width"),
        F.lit(2).alias("scale"),
        (F.col("progress_order") + 100).alias("progress_order"),
    )
    added = table(spark, folder, "supplier").select(
        F.lit("supplier").alias("table_name"),
        F.col("s_name").alias("column_name"),
        F.lit("TEXT").alias("data_type"),
        (F.col("s_acctbal") > 0).alias("is_mandatory"),
        F.col("s_nationkey").alias("width"),
        F.lit(None).cast("int").alias("scale"),
        F.lit(None).cast("int").alias("progress_order"),
    )
    return catalog.catalog_upsert(columns, changed.unionByName(added))


@query(
    "catalog_upsert_repeats",
    f"""WITH {COLUMNS_SQL}
SELECT table_name, column_name, 'TEXT' AS data_type, progress_type, false AS is_mandatory,
       width + CASE WHEN scale > 2 THEN 3 ELSE 1 END AS width, scale, extent, progress_order FROM columns""",
)
def catalog_upsert_repeats(spark: SparkSession, folder: str) -> DataFrame:
    """Columns repeated by a later dump, and twice within it: the last one counts, not the largest."""
    columns = columns_catalog(spark, folder)
    first = TIMESTAMP_OF_DUMP

    def dump(rows: DataFrame, more: int, *place: Column) -> DataFrame:
        changed = {"data_type": F.lit("TEXT"), "is_mandatory": F.lit(None).cast("boolean"), "width": F.col("width") + more}
        order = dict(zip(catalog.DUMP_ORDER, place, strict=True))
        return rows.withColumns(changed).withColumns(order).drop("progress_type", "extent")

    later = columns.filter("scale > 2")
    dumps = [
        dump(columns, 1, F.lit(first), F.lit("z"), F.lit(9)),
        dump(later, 7, F.lit(first), F.lit("zz"), F.lit(1)),
        dump(later, 3, F.lit(first), F.lit("zz"), F.lit(2)),
    ]
    return catalog.catalog_upsert(columns, reduce(DataFrame.unionByName, dumps))


TIMESTAMP_OF_DUMP = datetime(2024, 1, 1)
