"""Cast rules, one table of cases per rule."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from layerloom.functions import casts
from layerloom.functions.types import spark_type
from layerloom.operators.catalog import TargetColumn
from layerloom.operators.staging import split_extents, to_staging, typed, with_cast_error

pytestmark = pytest.mark.unit


def cast_all(spark, rule, cells):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, c string")
    return [r[0] for r in df.orderBy("i").select(rule(F.col("c"))).collect()]


def test_numeric(spark):
    cells = [" 12 ", "", "?", " ? ", None, "-7"]
    assert cast_all(spark, lambda c: casts.to_number(c, "INTEGER"), cells) == [12, None, None, None, None, -7]
    assert cast_all(spark, lambda c: casts.to_number(c, "NUMERIC(10,2)"), ["1.005", "-1.005"]) == [
        Decimal("1.01"),
        Decimal("-1.01"),
    ]


def test_numeric_strict_fails_lenient_does_not(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        cast_all(spark, lambda c: casts.to_number(c, "INTEGER"), ["12.5x"])
    assert cast_all(spark, lambda c: casts.to_number(c, "INTEGER", lenient=True), ["12.5x"]) == [None]


def test_boolean(spark):
    cells = ["true", " T ", "1", "Yes", "false", "f", "0", "NO", "", "  ", "?", "maybe", None]
    expected = [True] * 4 + [False] * 6 + [None] * 3
    assert cast_all(spark, casts.to_boolean, cells) == expected


def test_temporal(spark):
    cells = ["12/31/2024", "2024-01-02", " 2024-01-02 03:04:05 ", "", "?", None]
    days = [dt.date(2024, 12, 31), dt.date(2024, 1, 2), dt.date(2024, 1, 2), None, None, None]
    assert cast_all(spark, lambda c: casts.to_temporal(c, "DATE"), cells) == days
    times = [dt.datetime(2024, 12, 31), dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 2, 3, 4, 5), None, None, None]
    assert cast_all(spark, lambda c: casts.to_temporal(c, "TIMESTAMP"), cells) == times


def test_impossible_date_fails(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        cast_all(spark, lambda c: casts.to_temporal(c, "DATE"), ["02/30/2024"])
    assert cast_all(spark, lambda c: casts.to_temporal(c, "DATE", lenient=True), ["02/30/2024"]) == [None]


def test_text(spark):
    assert cast_all(spark, lambda c: casts.to_text(c, "VARCHAR(3)"), [" abcdef ", "", "  ", None]) == [
        "abc",
        None,
        None,
        None,
    ]
    # only spaces are trimmed
    assert cast_all(spark, casts.to_text, ["\tx "]) == ["\tx"]


@pytest.mark.parametrize(
    ("declared", "expected"),
    [
        ("NUMERIC(40,4)", "decimal(38,4)"),
        ("NUMERIC(3,9)", "decimal(3,3)"),
        ("NUMERIC", "decimal(38,18)"),
        ("numeric(17,2)", "decimal(17,2)"),
        ("INTEGER", "int"),
        ("BIGINT", "bigint"),
        ("BIT", "boolean"),
        ("LOGICAL", "boolean"),
        ("DATE", "date"),
        ("TIMESTAMP", "timestamp_ntz"),
        ("TIMESTAMP WITH TIME ZONE", "timestamp"),
        ("VARCHAR(30)", "string"),
        ("TEXT", "string"),
    ],
)
def test_spark_type(declared, expected):
    assert spark_type(declared) == expected


def test_extent_split(spark):
    df = spark.createDataFrame([(1, "AAA;;;;"), (2, "a;b"), (3, ""), (4, None)], "id int, code string")
    columns = [
        TargetColumn("id", 0, "id", "INTEGER"),
        *[TargetColumn("code", i, f"code_{i}", "TEXT") for i in range(1, 6)],
    ]
    split = split_extents(df, columns)
    assert split.columns == ["id", "code_1", "code_2", "code_3", "code_4", "code_5"]
    assert rows(split) == [
        (1, "AAA", "", "", "", ""),
        (2, "a", "b", "", "", ""),
        (3, "", "", "", "", ""),
        (4, None, None, None, None, None),
    ]


def test_extent_typed(spark):
    df = spark.createDataFrame([(" 1.50;?;;2;x ", "01/31/2024;?", "yes;no;;huh")], "n string, d string, b string")
    columns = [
        *[TargetColumn("n", i, f"n_{i}", "NUMERIC(10,2)") for i in range(1, 5)],
        TargetColumn("n", 5, "n_5", "VARCHAR(1)"),
        *[TargetColumn("d", i, f"d_{i}", "DATE") for i in range(1, 4)],
        *[TargetColumn("b", i, f"b_{i}", "BOOLEAN") for i in range(1, 6)],
    ]
    assert rows(typed(df, columns)) == [
        (
            Decimal("1.50"), None, None, Decimal("2.00"), "x", dt.date(2024, 1, 31), None, None,
            True, False, False, None, False,
        )
    ]


def test_wide_table_is_one_stage(spark):
    """220 declared columns, 35 of them arrays: 345 typed columns, no shuffle."""
    extents = [5] * 20 + [4] * 15
    names = [f"e{i}" for i in range(35)] + [f"s{i}" for i in range(185)]
    df = spark.createDataFrame([["1;2;3;4;5"] * 35 + ["7"] * 185], names)
    columns = [TargetColumn(f"e{i}", j, f"e{i}_{j}", "INTEGER") for i, n in enumerate(extents) for j in range(1, n + 1)]
    columns += [TargetColumn(f"s{i}", 0, f"s{i}", "NUMERIC(17,2)") for i in range(185)]
    staged = to_staging(df, columns, "run-1", "2024-01-01 00:00:00", [c.name for c in columns])
    assert len(columns) == 345
    row = staged.first()
    assert row["e34_4"] == 4 and row["s184"] == Decimal("7.00") and len(row["_etl_hashdiff"]) == 32
    assert "Exchange" not in staged._jdf.queryExecution().executedPlan().toString()


def test_cast_errors_name_every_bad_cell(spark):
    df = spark.createDataFrame([("1", "2;x", "?"), ("a", "1;2", "2024-13-01"), ("", "", "")], "n string, e string, d string")
    columns = [
        TargetColumn("n", 0, "n", "INTEGER"),
        *[TargetColumn("e", i, f"e_{i}", "BIGINT") for i in (1, 2)],
        TargetColumn("d", 0, "d", "DATE"),
    ]
    errors = {r["n"]: r["_error"] for r in with_cast_error(df, columns).collect()}
    assert errors == {
        "1": "invalid BIGINT in column 'e_2'",
        "a": "invalid INTEGER in column 'n'; invalid DATE in column 'd'",
        "": None,
    }


def test_aliases_and_unknown_types():
    assert [spark_type(t) for t in ("INT", "BOOL", "TIMESTAMPTZ", "TIMESTAMP WITHOUT TIME ZONE")] == ["int", "boolean", "timestamp", "timestamp_ntz"]
    with pytest.raises(ValueError, match="unknown declared type"):
        spark_type("something else")
