"""Every registered query against its SQL counterpart."""

from __future__ import annotations

import pytest
from oracle import connect, normalized, type_mismatches

from __spark_entry__ import entry, oracle_sql, queries
from layerloom.workload import QUERIES

pytestmark = pytest.mark.integration


@pytest.fixture(scope="module")
def duck(folder):
    con = connect(folder)
    yield con
    con.close()


def test_every_query_has_sql():
    assert set(oracle_sql()) <= set(queries())
    assert not set(QUERIES) - set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, folder, duck, name):
    df = queries()[name](spark, folder)
    names, ours = normalized(df.columns, df.collect())
    cursor = duck.execute(oracle_sql()[name])
    described = cursor.description
    other_names, theirs = normalized([d[0] for d in described], cursor.fetchall())
    assert names == other_names
    assert ours == theirs
    assert not type_mismatches(df, described)


def test_entry(spark):
    assert not entry(spark).isEmpty()
