"""Raw, staging and quality queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerloom.functions.text import blank_null_tokens, sanitize
from layerloom.operators import quality, raw, staging
from layerloom.session import work_dir
from layerloom.operators.catalog import TargetColumn
from layerloom.workload.registry import FIRST_TS, by_value, query, table

ORDER_CELLS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")


def _raw_orders(spark: SparkSession, folder: str) -> DataFrame:
    return raw.to_raw(table(spark, folder, "orders").select(*ORDER_CELLS), FIRST_TS, "orders.parquet", "log-1")


@query(
    "raw_load",
    f"""SELECT {", ".join(f"cast({c} AS VARCHAR) AS {c}" for c in ORDER_CELLS)},
  TIMESTAMP '{FIRST_TS}' AS _loaded_at, 'orders.parquet' AS _source_file, 'log-1' AS _sftp_log_id FROM orders""",
)
def raw_load(spark: SparkSession, folder: str) -> DataFrame:
    return _raw_orders(spark, folder)


STAGED = (
    TargetColumn("o_orderkey", 0, "o_orderkey", "BIGINT"),
    TargetColumn("o_custkey", 0, "o_custkey", "INTEGER"),
    TargetColumn("o_orderstatus", 0, "o_orderstatus", "BOOLEAN"),
    TargetColumn("o_totalprice", 0, "o_totalprice", "NUMERIC(15,2)"),
    TargetColumn("o_orderdate", 0, "o_orderdate", "DATE"),
    TargetColumn("o_orderpriority", 0, "o_orderpriority", "VARCHAR(6)"),
)
STAGED_CONTENT = tuple(c.name for c in STAGED)


@query(
    "staging_load",
    f"""WITH t AS (SELECT o_orderkey, cast(o_custkey AS INTEGER) AS o_custkey,
    CASE WHEN o_orderstatus = 'F' THEN false END AS o_orderstatus, cast(o_totalprice AS DECIMAL(15,2)) AS o_totalprice,
    cast(o_orderdate AS DATE) AS o_orderdate, left(o_orderpriority, 6) AS o_orderpriority FROM orders)
SELECT *, 'run-1' AS _etl_run_id, TIMESTAMP '{FIRST_TS}' AS _etl_valid_from,
  md5({" || ".join(f"coalesce(cast({c} AS VARCHAR), '')" for c in STAGED_CONTENT)}) AS _etl_hashdiff FROM t""",
)
def staging_load(spark: SparkSession, folder: str) -> DataFrame:
    return staging.to_staging(_raw_orders(spark, folder), STAGED, "run-1", FIRST_TS, STAGED_CONTENT)


# The given texts are clean, so punctuation is turned into control characters first.
@query(
    "text_sanitize",
    r"""WITH t AS (SELECT doc_id, translate(text, '.,', chr(1) || chr(127)) AS text,
    CASE lang WHEN 'de' THEN 'None' WHEN 'fr' THEN 'nan' ELSE lang END AS lang FROM documents)
SELECT doc_id, regexp_replace(text, '[\x00-\x08\x0B\x0C\x0E-\x1F\x7F-\x9F]', '', 'g') AS text,
       CASE WHEN lang IN ('None', '<NA>', 'nan', 'NaT') OR lang IS NULL THEN '' ELSE lang END AS lang FROM t""",
)
def text_sanitize(spark: SparkSession, folder: str) -> DataFrame:
    dirty = F.translate("text", ".,", "\x01\x7f")
    lang = by_value("lang", {"de": "None", "fr": "nan"}, F.col("lang"))
    return table(spark, folder, "documents").select(
        "doc_id", sanitize(dirty).alias("text"), blank_null_tokens(sanitize(lang)).alias("lang")
    )


EVENT_TYPES = (
    TargetColumn("event_id", 0, "event_id", "BIGINT"),
    TargetColumn("user_id", 0, "user_id", "INTEGER"),
    TargetColumn("value", 0, "value", "NUMERIC(12,2)"),
)


@query(
    "raw_load_errors",
    f"""WITH t AS (SELECT event_id, CASE WHEN event_type = 'signup' THEN 'u' || user_id ELSE cast(user_id AS VARCHAR) END AS user_id,
    CASE event_type WHEN 'error' THEN 'n/a' WHEN 'view' THEN '?' ELSE cast(value AS VARCHAR) END AS value, event_type FROM events)
SELECT 'events' AS table_name, 'events.parquet' AS source_file, 'log-1' AS sftp_log_id, event_id // 50000 + 1 AS chunk_number,
  event_id % 50000 AS row_number_in_chunk,
  CASE event_type WHEN 'signup' THEN 'invalid INTEGER in column ''user_id''' ELSE 'invalid NUMERIC(12,2) in column ''value''' END AS error_message,
  left('{{"event_id":"' || event_id || '","user_id":"' || user_id || '","value":"' || value || '"}}', 200) AS row_data_sample,
  TIMESTAMP '{FIRST_TS}' AS error_timestamp FROM t WHERE event_type IN ('signup', 'error')""",
)
def raw_load_errors(spark: SparkSession, folder: str) -> DataFrame:
    user = by_value("event_type", {"signup": F.concat(F.lit("u"), F.col("user_id").cast("string"))}, F.col("user_id").cast("string"))
    value = by_value("event_type", {"error": "n/a", "view": "?"}, F.col("value").cast("string"))
    events = table(spark, folder, "events").select("event_id", user.alias("user_id"), value.alias("value"))
    rows = raw.to_raw(events, FIRST_TS, "events.parquet", "log-1")
    checked = staging.with_cast_error(rows, EVENT_TYPES)
    return raw.load_errors(checked, "events", F.col("event_id").cast("bigint"))


# -- quality: documents and pages -----------------------------------------------------

DOC_CELLS = ("text", "lang", "source", "n_chars")

_CELLS_SQL = """cells AS (SELECT doc_id AS row_number, 1 AS col_pos, 'text' AS column_name, text AS value FROM documents
  UNION ALL SELECT doc_id, 2, 'lang', lang FROM documents UNION ALL SELECT doc_id, 3, 'source', source FROM documents
  UNION ALL SELECT doc_id, 4, 'n_chars', cast(n_chars AS VARCHAR) FROM documents)"""
_PAGES_SQL = """cells AS (SELECT page_id AS row_number, 1 AS col_pos, 'url' AS column_name, url AS value FROM pages
  UNION ALL SELECT page_id, 2, 'html', html FROM pages)"""
_ESCAPED = r"""'''' || replace(replace(replace(replace(left(value, 100), '\', '\\'), chr(9), '\t'), chr(10), '\n'), chr(13), '\r') || ''''"""
_FOUND_SQL = f"""found AS (
  SELECT row_number, col_pos, column_name, 'unescaped_quotes' AS issue_type,
         left(value, 100) || CASE WHEN length(value) > 100 THEN '...' ELSE '' END AS value_sample, 'warning' AS severity
  FROM cells WHERE contains(value, '"')
  UNION ALL SELECT row_number, col_pos, column_name, 'control_characters', {_ESCAPED}, 'warning' FROM cells
  WHERE contains(value, chr(9)) OR contains(value, chr(10)) OR contains(value, chr(13))
  UNION ALL SELECT row_number, col_pos, column_name, 'excessive_length', left(value, 100) || '... (total: ' || length(value) || ' chars)', 'warning'
  FROM cells WHERE length(value) > 100000),
delims AS (SELECT col_pos, column_name, d.d AS delimiter, count(*) AS row_count FROM cells,
    (SELECT unnest([';', '|', chr(9)]) AS d) d WHERE contains(value, d.d) GROUP BY ALL)"""


def document_cells(spark: SparkSession, folder: str) -> DataFrame:
    return quality.cells(table(spark, folder, "documents"), F.col("doc_id"), DOC_CELLS)


def page_cells(spark: SparkSession, folder: str) -> DataFrame:
    return quality.cells(table(spark, folder, "pages"), F.col("page_id"), ("url", "html"))


@query(
    "quality_issues",
    f"""WITH {_CELLS_SQL}, {_FOUND_SQL}
SELECT 'documents' AS table_name, row_number, col_pos, column_name, issue_type, value_sample, severity FROM found
UNION ALL SELECT 'documents', 0, col_pos, column_name, 'delimiter_in_data',
  row_count || ' rows contain ''' || delimiter || '''', 'info' FROM delims""",
)
def quality_issues(spark: SparkSession, folder: str) -> DataFrame:
    return quality.issues(document_cells(spark, folder), "documents")


@query(
    "quality_summary",
    f"""WITH {_CELLS_SQL}, {_FOUND_SQL}, u AS (SELECT issue_type, severity FROM found
  UNION ALL SELECT 'delimiter_in_data', 'info' FROM delims)
SELECT 'documents' AS table_name, count(*) AS issue_count, count(*) FILTER (severity = 'error') AS error_count,
  count(*) FILTER (severity = 'warning') AS warning_count, count(*) FILTER (severity = 'error') = 0 AS passed FROM u""",
)
def quality_summary(spark: SparkSession, folder: str) -> DataFrame:
    return quality.report(quality.summary(document_cells(spark, folder)), "documents")


@query(
    "quality_issue_counts",
    f"""WITH {_PAGES_SQL}, {_FOUND_SQL}, u AS (SELECT issue_type, severity FROM found
  UNION ALL SELECT 'delimiter_in_data', 'info' FROM delims)
SELECT issue_type, severity, count(*) AS issue_count FROM u GROUP BY ALL""",
)
def quality_issue_counts(spark: SparkSession, folder: str) -> DataFrame:
    return quality.summary(page_cells(spark, folder))


@query("quality_delimiters", f"WITH {_PAGES_SQL}, {_FOUND_SQL} SELECT * FROM delims")
def quality_delimiters(spark: SparkSession, folder: str) -> DataFrame:
    return quality.delimiter_counts(page_cells(spark, folder))


@query(
    "quality_one_scan",
    f"""WITH {_CELLS_SQL}, {_FOUND_SQL}
SELECT 'documents' AS table_name, CASE WHEN true THEN 'documents.parquet' END AS file_name, row_number, col_pos, column_name,
       issue_type, value_sample, severity FROM found
UNION ALL SELECT 'documents', NULL, 0, col_pos, column_name, 'delimiter_in_data',
  row_count || ' rows contain ''' || delimiter || '''', 'info' FROM delims
UNION ALL SELECT 'summary', NULL, count(*) FILTER (severity = 'error'), 0, cast(count(*) AS VARCHAR), 'all', 'all', NULL
FROM (SELECT severity FROM found UNION ALL SELECT 'info' FROM delims)""",
)
def quality_one_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Issues with their files, and the report's counts, from findings stored by one scan."""
    documents = table(spark, folder, "documents")
    path = work_dir(spark, "quality-findings")
    part = F.regexp_extract(F.col("_metadata.file_path"), "/([^/]*[.]parquet)(/[^/]*)?$", 1)
    quality.findings(documents, F.col("doc_id"), DOC_CELLS, part).write.parquet(path)
    found = spark.read.parquet(path)
    report = quality.report(quality.summary_of(found), "summary").select(
        "table_name", F.lit(None).cast("string").alias("file_name"), F.col("error_count").alias("row_number"), F.lit(0).alias("col_pos"),
        F.col("issue_count").cast("string").alias("column_name"), F.lit("all").alias("issue_type"), F.lit("all").alias("value_sample"),
        F.lit(None).cast("string").alias("severity"),
    )
    return quality.issues_of(found, "documents").unionByName(report)


@query(
    "quality_bad_bytes",
    f"""WITH {_CELLS_SQL}, {_FOUND_SQL}, u AS (SELECT issue_type, severity FROM found
  UNION ALL SELECT 'encoding_error', 'error' FROM documents WHERE lang = 'fr' AND text IS NOT NULL
  UNION ALL SELECT 'delimiter_in_data', 'info' FROM delims)
SELECT issue_type, severity, count(*) AS issue_count FROM u GROUP BY ALL""",
)
def quality_bad_bytes(spark: SparkSession, folder: str) -> DataFrame:
    """Texts of one language end in a byte that is no UTF-8."""
    broken = F.concat(F.col("text").cast("binary"), F.lit(b"\xff")).cast("string")
    documents = table(spark, folder, "documents").withColumn("text", F.when(F.col("lang") == "fr", broken).otherwise(F.col("text")))
    return quality.summary_of(quality.findings(documents, F.col("doc_id"), DOC_CELLS))
