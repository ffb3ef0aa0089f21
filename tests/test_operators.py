"""Catalog, raw text, quality, monitoring, reference and upkeep operators on small rows."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from layerloom.functions.text import sanitize
from layerloom.functions.types import scalar_type
from layerloom.operators import catalog, keyed, monitoring, quality, raw, refdata, upkeep

pytestmark = pytest.mark.unit

NOW = "2024-06-30 12:00:00"


# -- catalog ---------------------------------------------------------------------


def test_expand_and_widths(spark):
    columns = spark.createDataFrame(
        [
            ("t", "id", "INTEGER", "integer", True, 4, None, None, 1),
            ("t", "code", "TEXT", "character", False, 30, None, 3, 2),
            ("t", "znu", "TEXT", "decimal", False, 160, 4, 5, 3),
            ("t", "flag", "LOGICAL", "logical", None, 1, None, 0, 4),
            ("t", "odd", None, "blob", None, None, None, 0, 5),
            ("t", "odds", None, "blob", None, None, None, 1, 6),
            ("t", "amt", "TEXT", "decimal", False, None, 2, 1, 7),
            ("t", "big", "TEXT", "clob", False, 30000, None, 2, 8),
        ],
        catalog.COLUMN_CATALOG_SCHEMA,
    )
    got = {r["target_column"]: r["target_type"] for r in catalog.expand(columns).collect()}
    assert got == {
        "id": "INTEGER",
        **{f"code_{i}": "VARCHAR(10)" for i in (1, 2, 3)},
        **{f"znu_{i}": "NUMERIC(32,4)" for i in (1, 2, 3, 4, 5)},
        "flag": "BOOLEAN",
        "odd": "TEXT",
        "odds_1": "TEXT",
        "amt_1": "NUMERIC(17,2)",
        "big_1": "TEXT",
        "big_2": "TEXT",
    }
    assert rows(catalog.widths(columns)) == [("t", 8, 5, 15, 1)]


@pytest.mark.parametrize(
    ("kind", "extent", "width", "scale", "expected"),
    [
        ("character", 0, 50, None, "VARCHAR(50)"),
        ("Character", 0, 10000, None, "TEXT"),
        ("character", 0, None, None, "TEXT"),
        ("clob", 0, 50, None, "TEXT"),
        ("integer", 0, 4, None, "INTEGER"),
        ("int64", 0, 8, None, "BIGINT"),
        ("decimal", 0, 17, 2, "NUMERIC(17,2)"),
        ("decimal", 0, 17, 0, "NUMERIC"),
        ("logical", 0, 1, None, "BOOLEAN"),
        ("date", 0, 4, None, "DATE"),
        ("datetime", 0, 8, None, "TIMESTAMP"),
        ("datetime-tz", 0, 12, None, "TIMESTAMP WITH TIME ZONE"),
        ("recid", 0, 4, None, "BIGINT"),
        ("raw", 0, 4, None, "TEXT"),
        ("integer", 3, 12, None, "TEXT"),
    ],
)
def test_scalar_type(spark, kind, extent, width, scale, expected):
    df = spark.createDataFrame([(kind, extent, width, scale)], "k string, e int, w int, s int")
    assert df.select(scalar_type(F.col("k"), F.col("e"), F.col("w"), F.col("s"))).first()[0] == expected


def test_load_spec(spark):
    tables = spark.createDataFrame(
        [
            ("lisval", "lisval_cars", " id , code", True, "cars", True),
            ("lisval", "lisval_old", "id", True, None, False),
            ("client", None, None, None, None, True),
        ],
        catalog.TABLE_CATALOG_SCHEMA,
    )
    columns = spark.createDataFrame(
        [("lisval", "b", "TEXT", "character", False, None, None, 2, 2), ("lisval", "a", "DATE", "date", True, None, None, 0, 1)],
        catalog.COLUMN_CATALOG_SCHEMA,
    )
    spec = catalog.load_spec(tables, columns, "lisval", "lisval_cars")
    assert spec.physical_name == "lisval_cars" and spec.primary_keys == ("id", "code")
    assert [(c.name, c.sql_type) for c in spec.columns] == [("a", "DATE"), ("b_1", "TEXT"), ("b_2", "TEXT")]
    assert catalog.load_spec(tables, columns, "lisval", "lisval_old") is None
    assert catalog.load_spec(tables, columns, "client").primary_keys == ()
    assert rows(catalog.active_tables(tables)) == [("client",), ("lisval_cars",)]
    assert rows(catalog.validate(tables.select("table_name").distinct(), columns)) == [("client", None, "Empty columns list")]


# -- raw text ----------------------------------------------------------------------


def test_raw_cells(spark):
    df = spark.createDataFrame(
        [
            (bytearray(b"ab\xffc\x00"), "x\x07\ty\x9f\n", 123456789.12, dt.date(2024, 1, 2), True),
            (None, "NaT", float("nan"), None, None),
            (bytearray("é�".encode()), "None ", 100.0, dt.date(2024, 1, 3), False),
            (bytearray(b""), "<NA>", 1.5e-7, None, None),
        ],
        "b binary, s string, d double, day date, f boolean",
    )
    out = raw.to_raw(df, NOW, "f.parquet", "log")
    assert [tuple(r)[:5] for r in out.collect()] == [
        ("abc", "x\ty\n", "123456789.12", "2024-01-02", "true"),
        ("", "", "", "", ""),
        ("é�", "None ", "100.0", "2024-01-03", "false"),
        ("", "", "1.5E-7", "", ""),
    ]
    assert out.columns[-3:] == ["_loaded_at", "_source_file", "_sftp_log_id"]
    assert raw.raw_table_name("Lisval", "Lisval_Cars") == "raw_lisval_cars"


def test_sanitize_keeps_clean_text(spark):
    df = spark.createDataFrame([("tab\tlf\ncr\r é 漢 🙂",)], "s string")
    assert df.select(sanitize(F.col("s"))).first()[0] == "tab\tlf\ncr\r é 漢 🙂"


def test_oversized_cells(spark):
    df = raw.to_raw(spark.createDataFrame([("short", "ok"), ("ok", "far too long")], "a string, b string"), NOW, "f", "l")
    checked = df.withColumn("_error", raw.oversized(df, limit=5))
    assert raw.accepted(checked).count() == 1
    assert raw.load_errors(checked, "t", F.lit(50_001)).select(
        "chunk_number", "row_number_in_chunk", "error_message"
    ).first() == (2, 1, "value too long in column 'b'")


# -- quality -----------------------------------------------------------------------


def test_quality_kinds(spark):
    long = "z" * 100_001
    df = spark.createDataFrame(
        [
            (0, bytearray(b'say "hi"'), "a;b"),
            (1, bytearray(b"bad\xff"), "t\tb"),
            (2, bytearray(long.encode()), None),
        ],
        "n int, b binary, s string",
    )
    tall = quality.cells(df.select("n", F.col("b").cast("string").alias("b"), "s"), F.col("n") + 1, ("b", "s"))
    found = [(r["row_number"], r["column_name"], r["issue_type"], r["severity"]) for r in quality.issues(tall, "t").collect()]
    assert sorted(found) == [
        (0, "s", "delimiter_in_data", "info"),
        (0, "s", "delimiter_in_data", "info"),
        (1, "b", "unescaped_quotes", "warning"),
        (2, "b", "encoding_error", "error"),
        (2, "s", "control_characters", "warning"),
        (3, "b", "excessive_length", "warning"),
    ]
    samples = {r["issue_type"]: r["value_sample"] for r in quality.issues(tall, "t").collect()}
    assert samples["control_characters"] == "'t\\tb'"
    assert samples["excessive_length"] == "z" * 100 + "... (total: 100001 chars)"
    report = quality.report(quality.summary(tall), "t").first()
    assert (report["issue_count"], report["error_count"], report["warning_count"], report["passed"]) == (6, 1, 3, False)


def test_quality_cap_is_per_kind_and_column_order(spark):
    df = spark.range(1, 301).select(F.col("id"), F.lit('"').alias("a"), F.lit('"\t').alias("b"))
    issues = quality.issues(quality.cells(df, F.col("id"), ("a", "b")), "t", per_type=100)
    kept = issues.filter("issue_type = 'unescaped_quotes'")
    assert rows(kept.select("column_name").distinct()) == [("a",)]
    assert rows(kept.agg(F.min("row_number"), F.max("row_number"))) == [(1, 100)]
    assert issues.filter("issue_type = 'control_characters' and column_name = 'b'").count() == 100


def test_clean_input_passes(spark):
    df = spark.createDataFrame([(1, "clean")], "id int, s string")
    assert rows(quality.report(quality.summary(quality.cells(df, F.col("id"), ("s",))), "t")) == [("t", 0, 0, 0, True)]


# -- keyed operators -------------------------------------------------------------------


def test_upsert_changes_listed_columns_only(spark):
    base = spark.createDataFrame([(1, "a", "keep"), (2, "b", "keep")], "id int, v string, note string")
    updates = spark.createDataFrame([(2, None, "x"), (3, "c", "x")], "id int, v string, note string")
    assert rows(keyed.upsert(base, updates, ["id"], ["v"], ["v"])) == [(1, "a", "keep"), (2, None, "keep"), (3, "c", None)]


def test_insert_absent_takes_the_first(spark):
    base = spark.createDataFrame([("r1", 1)], "id string, n int")
    new = spark.createDataFrame([("r1", 9), ("r2", 5), ("r2", 4)], "id string, n int")
    assert rows(keyed.insert_absent(base, new, ["id"], [F.asc("n")])) == [("r1", 1), ("r2", 4)]


def test_latest_treats_null_keys_as_one_group(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (1, 5)], "k int, n int")
    assert rows(keyed.latest_per_key(df, ["k"], [F.desc("n")])) == [(1, 5), (None, 2)]


def test_skew_safe_join_gives_both_sides_an_exchange(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
        right = left.groupBy("k").agg(F.max("id").alias("m"))
        plan = keyed.skew_safe_join(left, right, ["k"], "left")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning(_spread") == 2


# -- monitoring -------------------------------------------------------------------------


def test_anomaly_rules_are_independent(spark):
    stats = spark.createDataFrame(
        [("r", "ods", "a", 10, 0, 700.0), ("r", "ods", "b", 10, 13, 1.0), ("r", "ods", "c", 10, 12, 600.0), ("r", "ods", "d", 0, 0, 0.0)],
        "run_id string, layer string, table_name string, rows_source bigint, rows_loaded bigint, duration_sec double",
    )
    found = rows(monitoring.anomalies(stats).select("table_name", "level", "metric"))
    assert found == [("a", "ERROR", "rows_loaded"), ("a", "WARNING", "duration"), ("b", "WARNING", "volume_spike")]
    assert rows(monitoring.silent_merges(stats).select("table_name")) == [("a",)]


def test_file_status_update(spark):
    files = spark.createDataFrame([("f1", "/l/f1", "t", "FULL", 10), ("f2", "/l/f2", "t", "FULL", 20)], "file_name string, path string, table_name string, load_mode string, size_bytes bigint")
    log = monitoring.file_log_rows(files, "run-1", NOW)
    ids = {r["file_name"]: r["log_id"] for r in log.collect()}
    updates = spark.createDataFrame(
        [(ids["f1"], "IN_PROGRESS", 5, None, "2024-07-01 00:00:00"), (ids["f1"], "FAILED", None, "boom", "2024-07-01 00:00:01")],
        "log_id string, status string, row_count bigint, error_message string, at string",
    ).withColumn("updated_at", F.col("at").cast("timestamp_ntz"))
    started = monitoring.update_file_status(log, updates.filter("status = 'IN_PROGRESS'"))
    assert rows(started.select("file_name", "processing_status", "row_count", "processed_at")) == [
        ("f1", "IN_PROGRESS", 5, None),
        ("f2", "PENDING", None, None),
    ]
    ended = monitoring.update_file_status(started, updates.filter("status = 'FAILED'"))
    assert rows(ended.select("file_name", "processing_status", "row_count", "error_message", F.col("processed_at").cast("string"))) == [
        ("f1", "FAILED", 5, "boom", "2024-07-01 00:00:01"),
        ("f2", "PENDING", None, None, None),
    ]


def test_volumetry_of_an_empty_load(spark):
    loads = spark.createDataFrame(
        [("r", "raw", "t", "FULL", 0, 0, 0, 0.0, None, None), ("r", "raw", "u", "FULL", 9, 1, 11, 2.0, 0.95, "x" * 600)],
        "run_id string, layer string, table_name string, load_mode string, rows_loaded bigint, rows_failed bigint, "
        "rows_source bigint, duration_sec double, quality_score double, error_message string",
    )
    empty, full = monitoring.load_volumetry(loads).orderBy("table_name").collect()
    assert (empty["success_rate_pct"], empty["row_delta"], empty["throughput_rows_per_sec"], empty["quality_band"]) == (0.0, None, 0, None)
    assert (full["success_rate_pct"], full["row_delta"], full["throughput_rows_per_sec"], full["quality_band"]) == (90.0, -2, 4, "good")
    assert len(full["error"]) == 500 and full["status"] == "FAILED"


# -- reference tables and upkeep ----------------------------------------------------------


def test_calendar(spark):
    days = refdata.calendar(spark.range(1).select(*refdata.year_bounds()))
    assert days.count() == 21 * 365 + 5
    row = days.filter("date_key = date'2024-12-30'").first()
    assert tuple(row)[1:] == (2024, 4, 12, 30, 1, "Monday", 1, False)
    assert days.filter("is_weekend").agg(F.min("day_of_week"), F.max("day_of_week")).first() == (6, 7)


def test_rates(spark):
    stored = refdata.rate_rows(
        spark.createDataFrame([("USD", dt.date(2024, 1, 1), 1.1), ("USD", dt.date(2024, 1, 2), 1.2)], "currency_code string, rate_date date, rate double"),
        "2024-01-01 03:00:00",
    )
    new = spark.createDataFrame([("USD", dt.date(2024, 1, 2), 1.25), ("CHF", dt.date(2024, 1, 2), 0.9)], "currency_code string, rate_date date, rate double")
    merged = refdata.upsert_rates(stored, new, "2024-01-02 03:00:00")
    assert rows(merged.select("currency_code", "rate_date", "rate", "base_currency")) == [
        ("CHF", dt.date(2024, 1, 2), Decimal("0.900000"), "EUR"),
        ("USD", dt.date(2024, 1, 1), Decimal("1.100000"), "EUR"),
        ("USD", dt.date(2024, 1, 2), Decimal("1.250000"), "EUR"),
    ]


def test_retention_keeps_unknown_rows(spark):
    log = spark.createDataFrame(
        [("old", "2023-01-01", "COMPLETED"), ("failed", "2023-01-01", "FAILED"), ("none", None, "COMPLETED"), ("new", "2024-06-01", "COMPLETED"), ("odd", "2023-01-01", None)],
        "id string, d string, processing_status string",
    ).withColumn("detected_at", F.col("d").cast("timestamp_ntz"))
    kept = upkeep.purge(log, upkeep.expired_files(NOW))
    assert rows(kept.select("id")) == [("failed",), ("new",), ("none",), ("odd",)]
    assert rows(upkeep.purge_counts(log, upkeep.expired_logs(NOW, "detected_at"))) == [(3, 2)]


def test_reference_documents(spark, tmp_path):
    from layerloom.sources import reference_files

    (tmp_path / "codes.json").write_text('{"EUR": "Euro",\n "USD": "US Dollar"}')
    (tmp_path / "rates.json").write_text('{"result": "success", "rates": {"EUR": 1, "USD": 1.0834567}}')
    codes = reference_files.read_currency_codes(spark, str(tmp_path / "codes.json"))
    assert rows(refdata.currency_codes(codes, NOW).select("code", "name")) == [("EUR", "Euro"), ("USD", "US Dollar")]
    rates = reference_files.read_exchange_rates(spark, str(tmp_path / "rates.json"), "2024-06-30")
    assert rows(refdata.rate_rows(rates, NOW).select("currency_code", "rate", "rate_date")) == [
        ("EUR", Decimal("1.000000"), dt.date(2024, 6, 30)),
        ("USD", Decimal("1.083457"), dt.date(2024, 6, 30)),
    ]


def test_shuffle_partitions():
    from layerloom.session import shuffle_partitions

    assert shuffle_partitions(10**9) == 200
    assert shuffle_partitions(50 * 10**12) == 93_133
    assert shuffle_partitions(10**15) == 200_000


def test_work_dir_is_under_the_shared_folder(spark, checkpoint_dir):
    from layerloom.session import work_dir

    assert work_dir(spark, "x").startswith(f"{checkpoint_dir}/x-")
    assert work_dir(spark, "x") != work_dir(spark, "x")
