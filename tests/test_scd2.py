"""History merges against a row-by-row model of the statements."""

from __future__ import annotations

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from layerloom.constants import FULL, FULL_RESET, INCREMENTAL
from layerloom.operators import scd2, upkeep
from layerloom.operators.scd2 import History

pytestmark = pytest.mark.unit

TABLE = History(keys=("a", "b"), columns=("a", "b", "v"), hash_columns=("v",), order=("pos",))
STORED = (
    "a int, b string, v string, _etl_valid_from timestamp_ntz, _etl_valid_to timestamp_ntz, "
    "_etl_is_current boolean, _etl_is_deleted boolean, _etl_hashdiff string, _etl_run_id string"
)
T = ["2024-01-01 00:00:00", "2024-01-02 00:00:00", "2024-01-03 00:00:00", "2024-01-04 00:00:00"]


def model_merge(history: list[dict], batch: list[tuple], mode: str, ts: str, run: str) -> tuple[list[dict], dict]:
    """Close, insert and delete as separate passes over a list of rows."""

    def same_key(row, key):
        return None not in key and (row["a"], row["b"]) == key

    winners: dict = {}
    for a, b, v, pos in batch:
        kept = winners.get((a, b))
        if kept is None or pos > kept[1]:
            winners[(a, b)] = (v, pos)
    history = [dict(r) for r in history]
    new = sum(not any(same_key(r, k) for r in history) for k in winners)
    closed = deleted = inserted = 0
    for row in history:
        if row["current"] and not row["deleted"]:
            hits = [v for k, (v, _) in winners.items() if same_key(row, k)]
            if hits and hits[0] != row["v"]:
                row.update(to=ts, current=False)
                closed += 1
    fresh = []
    for key, (v, _) in winners.items():
        if not any(same_key(r, key) and r["current"] and not r["deleted"] and r["v"] == v for r in history):
            fresh.append({"a": key[0], "b": key[1], "v": v, "from": ts, "to": None, "current": True, "deleted": False, "run": run})
    history += fresh
    inserted = len(fresh)
    if mode == FULL:
        for row in history:
            if row["current"] and not row["deleted"] and not any(same_key(row, k) for k in winners):
                row.update(to=ts, current=False, deleted=True)
                deleted += 1
    stats = dict(
        total_rows=closed + inserted + deleted,
        new_records=new,
        updated_records=closed,
        closed_records=closed,
        inserted_records=inserted,
        deleted_records=deleted,
    )
    return history, stats


def stored(spark, history: list[dict]):
    data = [(r["a"], r["b"], r["v"], r["from"], r["to"], r["current"], r["deleted"], r["run"]) for r in history]
    df = spark.createDataFrame(data, "a int, b string, v string, f string, t string, c boolean, d boolean, r string")
    return df.select(
        "a",
        "b",
        "v",
        F.col("f").cast("timestamp_ntz").alias("_etl_valid_from"),
        F.col("t").cast("timestamp_ntz").alias("_etl_valid_to"),
        F.col("c").alias("_etl_is_current"),
        F.col("d").alias("_etl_is_deleted"),
        TABLE.hash_expression.alias("_etl_hashdiff"),
        F.col("r").alias("_etl_run_id"),
    )


def batch_frame(spark, batch: list[tuple]):
    return spark.createDataFrame(batch, "a int, b string, v string, pos int")


def plain(df) -> list[tuple]:
    return rows(
        df.select(
            "a",
            "b",
            "v",
            F.col("_etl_valid_from").cast("string"),
            F.col("_etl_valid_to").cast("string"),
            "_etl_is_current",
            "_etl_is_deleted",
            "_etl_run_id",
        )
    )


def model_rows(history: list[dict]) -> list[tuple]:
    return sorted(
        ((r["a"], r["b"], r["v"], r["from"], r["to"], r["current"], r["deleted"], r["run"]) for r in history), key=repr
    )


def random_batch(rng: random.Random, size: int) -> list[tuple]:
    keys = [None, 1, 2, 3, 4]
    return [
        (rng.choice(keys), rng.choice(["x", "y", "z", None]), rng.choice(["p", "q", "r"]), i)
        for i in rng.sample(range(1000), size)
    ]


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("mode", [FULL, INCREMENTAL])
def test_merge_matches_model(spark, seed, mode):
    """Repeated and NULL keys, duplicates in the first load, resurrected rows."""
    rng = random.Random(seed)
    first = random_batch(rng, 14)
    history = [
        {"a": a, "b": b, "v": v, "from": T[0], "to": None, "current": True, "deleted": False, "run": "run-0"}
        for a, b, v, _ in first
    ]
    for i in (1, 2, 3):
        batch = random_batch(rng, rng.randint(1, 16))
        step = FULL if (mode == FULL or i == 2) else INCREMENTAL
        expected, stats = model_merge(history, batch, step, T[i], f"run-{i}")
        before, source = stored(spark, history), batch_frame(spark, batch)
        assert plain(scd2.merge(before, source, TABLE, step, T[i], f"run-{i}")) == model_rows(expected)
        assert scd2.merge_stats(before, source, TABLE, step).first().asDict() == stats
        history = expected


def test_same_batch_again_changes_nothing(spark):
    batch = batch_frame(spark, [(1, "x", "p", 1), (2, "x", "q", 2), (2, "x", "r", 3)])
    history = scd2.merge(None, batch.filter("pos <> 2"), TABLE, FULL, T[0], "run-0")
    again = scd2.merge(history, batch, TABLE, FULL, T[1], "run-1")
    assert plain(again) == plain(history)
    assert scd2.merge_stats(history, batch, TABLE, FULL).first()["total_rows"] == 0


def test_full_merge_invariants(spark):
    first = scd2.merge(None, batch_frame(spark, [(i, "x", "p", i) for i in range(20)]), TABLE, FULL, T[0], "run-0")
    second = batch_frame(spark, [(i, "x", "p" if i < 15 else "q", i) for i in range(10, 30)])
    merged = scd2.merge(first, second, TABLE, FULL, T[1], "run-1")
    live = scd2.current_view(merged)
    assert rows(live.select("a", "b", "v")) == rows(second.select("a", "b", "v"))
    assert live.groupBy("a", "b").count().filter("count > 1").isEmpty()
    closed = merged.filter("not _etl_is_current and not _etl_is_deleted").select("a", F.col("_etl_valid_to").alias("t"))
    opened = live.select("a", F.col("_etl_valid_from").alias("t"))
    assert closed.join(opened, ["a", "t"], "left_anti").isEmpty()
    assert upkeep.consistency_check(second, merged).first()["is_consistent"]


def test_reset_keeps_duplicates(spark):
    batch = batch_frame(spark, [(1, "x", "p", 1), (1, "x", "q", 2)])
    old = scd2.merge(None, batch, TABLE, FULL, T[0], "run-0")
    assert scd2.merge(old, batch, TABLE, FULL_RESET, T[1], "run-1").count() == 2
    assert scd2.merge_stats(old, batch, TABLE, FULL_RESET).first().asDict() == {
        "total_rows": 2,
        "new_records": 2,
        "updated_records": 0,
        "closed_records": 0,
        "inserted_records": 2,
        "deleted_records": 0,
    }


@pytest.mark.parametrize(
    ("existing", "incoming", "current", "deleted", "action"),
    [
        (None, "A", True, False, "insert"),
        ("A", "A", True, False, "noop"),
        ("A", "B", True, False, "close"),
        ("A", "A", False, False, "insert"),
        ("A", "B", True, True, "insert"),
    ],
)
def test_decision(spark, existing, incoming, current, deleted, action):
    df = spark.createDataFrame([(existing, incoming, current, deleted)], "e string, i string, c boolean, d boolean")
    got = df.select(scd2.decide(F.col("e"), F.col("i"), F.col("c"), F.col("d"))).first()[0]
    assert got == action


def test_keys_are_required():
    with pytest.raises(ValueError, match="key"):
        History(keys=(), columns=("a",))


def test_unknown_mode(spark):
    with pytest.raises(ValueError, match="load mode"):
        scd2.merge(None, batch_frame(spark, []), TABLE, "DELTA", T[0], "run-0")


def test_replay_refuses_empty_staging(spark):
    history = scd2.merge(None, batch_frame(spark, [(1, "x", "p", 1)]), TABLE, FULL, T[0], "run-0")
    with pytest.raises(ValueError, match="no staging rows"):
        upkeep.replay(history, batch_frame(spark, []), TABLE, T[1], "run-1")


def test_hot_key(spark):
    """A key that owns a third of the batch and of the history."""
    n = 3000
    hot = F.when(F.col("id") < n // 3, F.lit(0)).otherwise(F.col("id")).cast("int")
    big = spark.range(n).select(hot.alias("a"), F.lit("x").alias("b"), F.concat(F.lit("p"), "id").alias("v"), F.col("id").cast("int").alias("pos"))
    history = scd2.merge(None, big, TABLE, FULL, T[0], "run-0")
    changed = big.withColumn("v", F.when(F.col("a") == 0, F.lit("new")).otherwise(F.col("v")))
    stats = scd2.merge_stats(history, changed, TABLE, FULL).first().asDict()
    assert (stats["closed_records"], stats["inserted_records"], stats["deleted_records"]) == (n // 3, 1, 0)
    merged = scd2.merge(history, changed, TABLE, FULL, T[1], "run-1")
    assert merged.filter("a = 0 and _etl_is_current").count() == 1
    assert merged.count() == n + 1


def test_dedup_limits_before_the_shuffle(spark):
    plan = scd2.incoming(batch_frame(spark, [(1, "x", "p", 1)]), TABLE)._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    partial = next(i for i, line in enumerate(lines) if "WindowGroupLimit" in line and "Partial" in line)
    exchange = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line)
    assert exchange < partial


def test_no_pairwise_joins(spark, folder):
    from layerloom.workload.histories import orders_merged

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = orders_merged(spark, folder, FULL)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in text
    assert "NestedLoop" not in text and "Cartesian" not in text
