"""What loads and reads of a stored history move and write."""

from __future__ import annotations

from conftest import rows
from pyspark.sql import functions as F

from layerloom.constants import FULL, HASHDIFF, INCREMENTAL, RUN_ID
from layerloom.functions.hashing import packed, unpacked
from layerloom.operators import scd2
from layerloom.operators.scd2 import History
from layerloom.plans.history_load import load_history
from layerloom.sources.layers import FEW_PARTS, Layers

TABLE = History(keys=("id",), columns=("id", "v"))
T = ["2024-01-01 00:30:00", "2024-01-02 00:30:00"]


def loaded(spark, root, n: int) -> Layers:
    """Two loads of n keys in one part per key, the second from 8 tasks."""
    layers, batch = Layers(spark, root, rows_per_part=1), spark.range(n, numPartitions=8).withColumn("v", F.lit("a"))
    load_history(layers, "t", batch, TABLE, INCREMENTAL, T[0], "run-1")
    load_history(layers, "t", batch.withColumn("v", F.lit("b")), TABLE, INCREMENTAL, T[1], "run-2")
    return layers


def test_deltas_of_many_parts_have_few_files(spark, tmp_path):
    n, tasks = 2 * FEW_PARTS, spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        layers = loaded(spark, str(tmp_path), n)
        commits = layers.commits("t")
        assert commits.parts == n
        many = spark.range(16 * n, numPartitions=16).select(F.expr(f"id % {n}").alias("id"), F.lit("c").alias("v"))
        layers.write_opened("t", many, "run-3", commits)
        folders = list((tmp_path / "ods" / "t" / "opened" / "_load=run-run-3").glob("_part=*"))
        assert len(folders) > FEW_PARTS
        assert sum(len(list(f.glob("*.parquet"))) for f in folders) == len(folders)
        assert layers.changed_parts("t", commits) == sorted(r[0] for r in many.select(commits.part()).distinct().collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", tasks)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_history_meets_its_ends_once(spark, tmp_path):
    layers = loaded(spark, str(tmp_path), 3)
    history = layers.history("t")
    assert history._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1
    assert rows(history.select("id", "v", "_etl_is_current", RUN_ID)) == rows(
        layers.past("t").unionByName(layers.live("t")).select("id", "v", "_etl_is_current", RUN_ID)
    )


def test_hash_travels_only_where_it_breaks_ties(spark):
    batch = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (None, "c", 1)], "id int, v string, n int")
    ordered = History(keys=("id",), columns=("id", "v", "n"), order=("n", "v"))
    partly = History(keys=("id",), columns=("id", "v", "n"), order=("n",))
    floats = batch.withColumn("v", F.col("n").cast("double"))
    assert [scd2._order_decides(b, t) for b, t in ((batch, ordered), (batch, partly), (floats, ordered))] == [True, False, False]
    assert rows(scd2.incoming(batch, ordered)) == rows(scd2.incoming(scd2.with_hash(batch, ordered), ordered))


def test_hashes_are_packed_and_come_back(spark):
    texts = ["0123456789abcdef" * 2, "0123456789ABCDEF" * 2, "x" * 32, "", "16 bytes of text", "é" * 8, "no_hash", None]
    df = spark.createDataFrame([(t,) for t in texts], "h string").withColumn("p", packed("h"))
    found = df.select("h", F.length("p").alias("n"), unpacked(F.col("p")).alias("back")).collect()
    assert [r["back"] for r in found] == texts
    assert [r["n"] == 16 for r in found[:-1]] == [True] + [False] * 6
    assert df.where("p is not null").select("p").distinct().count() == 7


def test_ends_of_a_full_load_are_counted_in_the_join(spark):
    table = History(keys=("id",), columns=("id", "v"))
    twice = scd2.open_versions(spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (None, "c"), (2, "a")], "id int, v string"), table, T[0], "run-1")
    source = scd2.incoming(spark.createDataFrame([(1, "b"), (2, "a")], "id int, v string"), table)
    found = scd2.fates(twice, source, table, FULL)
    assert HASHDIFF in found.columns
    assert rows(found.select("id", "_action", "_same", "_rows")) == sorted(
        [(1, "close", False, 2), (1, "keep", True, 1), (None, "delete", False, 1), (2, "keep", True, 1)], key=repr
    )
