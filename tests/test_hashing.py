"""Content hash."""

from __future__ import annotations

import hashlib

import pytest

from layerloom.functions.hashing import hashdiff, hashed_names
from layerloom.operators.catalog import TableSpec, TargetColumn

pytestmark = pytest.mark.unit


def md5(text: str) -> str:
    return hashlib.md5(text.encode()).hexdigest()


def test_default_exclusions(spark):
    df = spark.createDataFrame([(1, None, "é", "u", "d")], "id int, name string, code string, usr_crt string, dat_crt string")
    assert hashed_names(df.columns) == ["id", "name", "code"]
    assert df.select(hashdiff(df.columns)).first()[0] == md5("1é")


def test_own_exclusions(spark):
    df = spark.createDataFrame([(1, "s")], "id int, secret string")
    assert df.select(hashdiff(df.columns, exclude={"secret"})).first()[0] == md5("1")


def test_nothing_left(spark):
    df = spark.createDataFrame([("r", "v")], "_etl_run_id string, _etl_valid_from string")
    assert df.select(hashdiff(df.columns)).first()[0] == "no_hash"


def test_separator_keeps_neighbours_apart(spark):
    df = spark.createDataFrame([("ab", ""), ("a", "b"), (None, "ab")], "x string, y string")
    plain = {r[0] for r in df.select(hashdiff(df.columns)).collect()}
    safe = {r[0] for r in df.select(hashdiff(df.columns, separated=True)).collect()}
    assert len(plain) == 1
    assert len(safe) == 3


def test_array_columns_follow_their_catalog_name():
    columns = [TargetColumn("znu", i, f"znu_{i}", "TEXT") for i in (1, 2, 3)]
    columns += [TargetColumn("usr_mod", i, f"usr_mod_{i}", "TEXT") for i in (1, 2)]
    columns += [TargetColumn("id", 0, "id", "INTEGER")]
    spec = TableSpec("t", None, ("id",), False, "", tuple(columns))
    assert spec.hash_columns() == ("znu_1", "znu_2", "znu_3", "id")
