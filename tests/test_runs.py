"""Several layers together: full runs, the store, the stream."""

from __future__ import annotations

import json

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_landing import Folder

from layerloom.constants import FULL, FULL_RESET, INCREMENTAL
from layerloom.operators import catalog, monitoring
from layerloom.operators.scd2 import STATS, History
from layerloom.plans.full_run import run
from layerloom.plans.history_load import load_history, replay_from_staging
from layerloom.sources.layers import Layers
from layerloom.streaming.feed import feed_history, landed_stream

pytestmark = pytest.mark.integration

T = ["2024-01-01 00:00:00", "2024-01-02 00:00:00", "2024-01-03 00:00:00", "2024-01-04 00:00:00"]


@pytest.fixture
def catalogs(spark):
    tables = spark.createDataFrame(
        [("client", None, "cod_cli", True, "customers", True), ("stock", None, "id", False, None, True)],
        catalog.TABLE_CATALOG_SCHEMA,
    )
    columns = spark.createDataFrame(
        [
            ("client", "cod_cli", "INTEGER", "integer", True, 4, None, None, 1),
            ("client", "nom", "VARCHAR(10)", "character", False, 10, None, 0, 2),
            ("client", "znu", "TEXT", "decimal", False, 51, 2, 3, 3),
            ("client", "dat_mod", "DATE", "date", False, 4, None, 0, 4),
            ("stock", "id", "INTEGER", "integer", True, 4, None, 0, 1),
            ("stock", "qty", "INTEGER", "integer", False, 4, None, 0, 2),
        ],
        catalog.COLUMN_CATALOG_SCHEMA,
    )
    return tables, columns


def land(folder: Folder, base: str, table: str, columns: dict, mode: str, stamp: str):
    n = len(next(iter(columns.values())))
    metadata = {"table_name": table, "columns": [], "row_count": n, "load_mode": mode, "extract_timestamp": stamp}
    pq.write_table(pa.table(columns), folder.root / "parquet" / f"{base}.parquet")
    (folder.root / "metadata" / f"{base}_metadata.json").write_text(json.dumps(metadata))


def clients(ids, names, znu=None, day="01/31/2024"):
    return {
        "cod_cli": pa.array(ids, pa.int32()),
        "nom": names,
        "znu": znu or ["1.50;?;2"] * len(ids),
        "dat_mod": [day] * len(ids),
    }


def by_table(stats):
    return {(r["layer"], r["table_name"]): r for r in stats.collect()}


def test_full_run(spark, tmp_path, catalogs):
    layers = Layers(spark, str(tmp_path / "warehouse"))
    one = Folder(tmp_path / "day1")
    land(one, "client 1+é", "client", clients([1, 2, 3], ["a\x01", "None", "c"]), FULL, "2024-01-01T00:00:00")
    land(one, "stock_1", "stock", {"id": [1], "qty": ["many"]}, INCREMENTAL, "2024-01-01T00:00:00")
    land(one, "ghost_1", "ghost", {"id": [1]}, FULL, "2024-01-01T00:00:00")
    stats = by_table(run(spark, str(one.root), layers, *catalogs, "run-1", T[0]))
    assert stats["ods", "client"]["rows_loaded"] == 3
    assert stats["run", "stock"]["status"] == "FAILED" and "CAST_INVALID_INPUT" in stats["run", "stock"]["error_message"]
    assert "not in catalog" in stats["run", "ghost"]["error_message"]
    log = layers.load_rows("monitoring", "file_log", "run-1")
    assert rows(log.select("table_name", "processing_status", "row_count", F.col("processed_at").isNotNull())) == [
        ("client", "COMPLETED", 3, True),
        ("ghost", "FAILED", None, True),
        ("stock", "FAILED", 1, True),
    ]
    raw = layers.read("raw", "raw_client")
    assert rows(raw.select("cod_cli", "nom", "znu", "_source_file")) == [
        ("1", "a", "1.50;?;2", "client 1+é.parquet"),
        ("2", "", "1.50;?;2", "client 1+é.parquet"),
        ("3", "c", "1.50;?;2", "client 1+é.parquet"),
    ]
    live = layers.live("client")
    assert dict(live.dtypes)["znu_1"] == "decimal(17,2)" and dict(live.dtypes)["cod_cli"] == "int"

    # day 2: two incremental files are loaded together; the change in dat_mod alone is none
    two = Folder(tmp_path / "day2")
    land(two, "client_2", "client", clients([1, 4], ["a", "d"], day="02/01/2024"), INCREMENTAL, "2024-01-02T00:00:00")
    land(two, "client_3", "client", clients([2], ["bb"]), INCREMENTAL, "2024-01-02T01:00:00")
    stats = by_table(run(spark, str(two.root), layers, *catalogs, "run-2", T[1]))
    assert stats["ods", "client"]["rows_loaded"] == 1 + 2
    assert rows(layers.live("client").select("cod_cli", "nom")) == [(1, "a"), (2, "bb"), (3, "c"), (4, "d")]

    # day 3: a full extract supersedes the file before it and deletes what is gone
    three = Folder(tmp_path / "day3")
    land(three, "client_4", "client", clients([9], ["old"]), FULL, "2024-01-03T00:00:00")
    land(three, "client_5", "client", clients([1, 4], ["a", "d"]), FULL, "2024-01-03T01:00:00")
    run(spark, str(three.root), layers, *catalogs, "run-3", T[2])
    assert rows(layers.live("client").select("cod_cli")) == [(1,), (4,)]
    history = layers.history("client")
    assert history.filter("_etl_is_deleted").count() == 2
    assert history.filter("not _etl_is_current and not _etl_is_deleted").count() == 1
    runs = layers.read("monitoring", "runs")
    assert {r["run_id"]: r["status"] for r in runs.collect()} == {"run-1": "FAILED", "run-2": "COMPLETED", "run-3": "COMPLETED"}
    assert layers.read("monitoring", "file_log").count() == 3 + 2 + 2
    assert monitoring.anomalies(layers.read("monitoring", "table_stats")).isEmpty()
    assert layers.read("monitoring", "anomalies").isEmpty()
    # the same extract again: the merge changes nothing, and the run says so
    land(three, "client_6", "client", clients([1, 4], ["a", "d"]), FULL, "2024-01-04T01:00:00")
    run(spark, str(three.root), layers, *catalogs, "run-4", T[3])
    assert rows(layers.load_rows("monitoring", "anomalies", "run-4").select("table_name", "metric")) == [
        ("client", "no_op_merge"),
        ("client", "rows_loaded"),
    ]


def test_quarantine(spark, tmp_path, catalogs):
    layers = Layers(spark, str(tmp_path / "warehouse"))
    folder = Folder(tmp_path / "landing")
    land(folder, "stock_1", "stock", {"id": ["1", "2", "x"], "qty": ["7", "ma;\ny", "?"]}, FULL, "2024-01-01T00:00:00")
    stats = by_table(run(spark, str(folder.root), layers, *catalogs, "run-1", T[0], quarantine=True, check_quality=True))
    assert stats["staging", "stock"]["rows_loaded"] == 1 and stats["staging", "stock"]["rows_failed"] == 2
    report = layers.load_rows("monitoring", "quality_reports", "run-1-stock")
    assert rows(report) == [("stock", 2, 0, 1, True)]
    errors = layers.load_rows("raw", "raw_load_errors", "run-1-stock")
    assert rows(errors.select("row_number_in_chunk", "error_message", "row_data_sample")) == [
        (1, "invalid INTEGER in column 'qty'", '{"id":"2","qty":"ma;\\ny"}'),
        (2, "invalid INTEGER in column 'id'", '{"id":"x","qty":"?"}'),
    ]


def test_files_of_separate_configurations(spark, tmp_path):
    """Two extracts of one configuration of a multi-configuration table: two loads in one run."""
    tables = spark.createDataFrame([("lisval", None, "id", True, None, True)], catalog.TABLE_CATALOG_SCHEMA)
    columns = spark.createDataFrame(
        [("lisval", n, "TEXT", "character", True, None, None, 0, i) for i, n in enumerate(("id", "v"))],
        catalog.COLUMN_CATALOG_SCHEMA,
    )
    layers = Layers(spark, str(tmp_path / "warehouse"))
    folder = Folder(tmp_path / "landing")
    land(folder, "lisval_1", "lisval", {"id": ["1"], "v": ["a"]}, INCREMENTAL, "2024-01-01T00:00:00")
    land(folder, "lisval_2", "lisval", {"id": ["1", "2"], "v": ["b", "c"]}, INCREMENTAL, "2024-01-02T00:00:00")
    run(spark, str(folder.root), layers, tables, columns, "run-1", T[0])
    assert rows(layers.history("lisval").select("id", "v", "_etl_is_current", "_etl_run_id")) == [
        ("1", "a", False, "run-1"),
        ("1", "b", True, "run-1.1"),
        ("2", "c", True, "run-1.1"),
    ]


def test_full_extract_in_several_files(spark, tmp_path, catalogs):
    """All files of a full extract are one load: none supersedes or deletes what the others hold."""
    layers = Layers(spark, str(tmp_path / "warehouse"))
    for day, mode in enumerate((FULL, FULL, FULL_RESET)):
        folder, stamp = Folder(tmp_path / f"day{day}"), f"2024-01-0{day + 1}T00:00:00"
        land(folder, "client_0", "client", clients([9], ["old"]), FULL, "2023-12-31T00:00:00")
        for part in range(3):
            land(folder, f"client_1_{part}", "client", clients([part, 3 + part], [f"{day}{part}", "same"]), mode, stamp)
        stats = by_table(run(spark, str(folder.root), layers, *catalogs, f"run-{day}", T[day]))
        assert stats["raw", "client"]["rows_loaded"] == 6
        assert rows(layers.live("client").select("cod_cli", "nom")) == [(k, f"{day}{k}" if k < 3 else "same") for k in range(6)]
        assert not layers.history("client").filter("_etl_is_deleted").count()
    # a part that may not be loaded holds the others back: what it has must not count as gone
    folder = Folder(tmp_path / "day4")
    for part in range(2):
        land(folder, f"client_1_{part}", "client", clients([part], ["new"]), FULL, "2024-01-04T00:00:00")
    (folder.root / "parquet" / "client_1_0.parquet").write_bytes(b"PAR1 this is none PAR1")
    stats = by_table(run(spark, str(folder.root), layers, *catalogs, "run-4", T[3]))
    assert "other parts" in stats["run", "client"]["error_message"]
    assert layers.live("client").count() == 6


def test_parts_of_a_separate_configuration(spark, tmp_path):
    """Two full extracts of a multi-configuration table, each in two files: two loads."""
    tables = spark.createDataFrame([("lisval", None, "id", True, None, True)], catalog.TABLE_CATALOG_SCHEMA)
    columns = spark.createDataFrame([("lisval", "id", "TEXT", "character", True, None, None, 0, 0)], catalog.COLUMN_CATALOG_SCHEMA)
    layers, folder = Layers(spark, str(tmp_path / "warehouse")), Folder(tmp_path / "landing")
    for day in (1, 2):
        for part in "ab":
            land(folder, f"lisval_{day}_{part}", "lisval", {"id": [part, f"{part}{day}"]}, FULL, f"2024-01-0{day}T00:00:00")
    run(spark, str(folder.root), layers, tables, columns, "run-1", T[2])
    assert rows(layers.live("lisval").select("id")) == [("a",), ("a2",), ("b",), ("b2",)]


def test_full_run_over_many_landed_files(spark, tmp_path, folder):
    """The query lands as many files as its table has partitions; its result is that of one file."""
    from layerloom.workload import QUERIES

    orders = spark.read.parquet(f"{folder}/orders.parquet")
    orders.write.parquet(str(tmp_path / "one" / "orders.parquet"))
    orders.repartition(5, "o_orderkey").write.option("compression", "none").parquet(str(tmp_path / "many" / "orders.parquet"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        assert spark.read.parquet(str(tmp_path / "many" / "orders.parquet")).rdd.getNumPartitions() > 1
        many = rows(QUERIES["full_run_incremental"](spark, str(tmp_path / "many")))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert many == rows(QUERIES["full_run_incremental"](spark, str(tmp_path / "one")))


TABLE = History(keys=("id",), columns=("id", "v"))


def frame(spark, *data):
    return spark.createDataFrame(data, "id int, v string")


def stats_of(*values):
    return dict(zip(STATS, values, strict=True))


def test_stored_history(spark, tmp_path):
    layers = Layers(spark, str(tmp_path))
    assert layers.live("t") is None and layers.history("t") is None
    first = load_history(layers, "t", frame(spark, (1, "a"), (2, "b"), (3, "c")), TABLE, INCREMENTAL, T[0], "run-1")
    assert first == stats_of(3, 3, 0, 0, 3, 0)
    batch = frame(spark, (2, "B"), (3, "c"), (4, "d"))
    assert load_history(layers, "t", batch, TABLE, FULL, T[1], "run-2") == stats_of(1 + 2 + 1, 1, 1, 1, 2, 1)
    # a committed run is not applied twice
    assert load_history(layers, "t", batch, TABLE, FULL, T[1], "run-2") == stats_of(0, 0, 0, 0, 0, 0)
    assert rows(layers.live("t").select("id", "v")) == [(2, "B"), (3, "c"), (4, "d")]
    assert rows(layers.past("t").select("id", "v", "_etl_is_deleted")) == [(1, "a", True), (2, "b", False)]
    # 1 comes back: inserted, but neither new nor updated
    back = load_history(layers, "t", frame(spark, (1, "a")), TABLE, INCREMENTAL, T[2], "run-3")
    assert back == stats_of(1, 0, 0, 0, 1, 0)
    assert layers.history("t").count() == 6
    # a reset hides everything before it
    load_history(layers, "t", frame(spark, (7, "z")), TABLE, FULL_RESET, T[3], "run-4")
    assert rows(layers.history("t").select("id", "v")) == [(7, "z")]


def test_lost_load_is_invisible_and_repeatable(spark, tmp_path):
    from layerloom.operators import scd2

    layers = Layers(spark, str(tmp_path))
    load_history(layers, "t", frame(spark, (1, "a"), (2, "b")), TABLE, FULL, T[0], "run-1")
    # the load dies after writing, before the commit; its rows have ended versions the repeat will not have
    live, source = layers.live("t"), scd2.incoming(frame(spark, (1, "x")), TABLE)
    layers.write_opened("t", scd2.opened(scd2.to_insert(live, source, TABLE), TABLE, T[1], "run-2"), "run-2")
    layers.write_ended("t", scd2.endings(live, source, TABLE, FULL, T[1]).withColumn("_ended_rows", F.lit(1)), "run-2")
    assert rows(layers.history("t").select("id", "v")) == [(1, "a"), (2, "b")]
    again = load_history(layers, "t", frame(spark, (1, "a"), (2, "b"), (3, "c")), TABLE, FULL, T[1], "run-2")
    assert again == stats_of(1, 1, 0, 0, 1, 0)
    assert rows(layers.history("t").select("id", "v")) == [(1, "a"), (2, "b"), (3, "c")]


def test_compaction_changes_nothing_to_see(spark, tmp_path):
    layers = Layers(spark, str(tmp_path))
    load_history(layers, "t", frame(spark, (1, "a"), (2, "b")), TABLE, FULL, T[0], "run-1")
    load_history(layers, "t", frame(spark, (1, "A"), (3, "c")), TABLE, FULL, T[1], "run-2")
    load_history(layers, "t", frame(spark, (3, "C")), TABLE, INCREMENTAL, T[2], "run-3")
    before = rows(layers.history("t"))
    assert len(layers.commits("t").deltas) == 2
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = layers.history("t")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "NestedLoop" not in plan
    assert layers.compact("t") and not layers.compact("t")
    assert layers.commits("t").deltas == () and len(layers.commits("t").bases) == 2
    assert rows(layers.history("t")) == before
    load_history(layers, "t", frame(spark, (1, "a")), TABLE, INCREMENTAL, T[3], "run-4", compact_after=1)
    assert len(layers.commits("t").bases) == 3
    assert layers.history("t").count() == len(before) + 1
    assert rows(layers.live("t").select("id", "v")) == [(1, "a"), (3, "C")]


def test_load_reads_no_business_columns_of_stored_rows(spark, tmp_path):
    from layerloom.operators import scd2

    layers = Layers(spark, str(tmp_path))
    load_history(layers, "t", frame(spark, (1, "a")), TABLE, FULL, T[0], "run-1")
    source = scd2.incoming(frame(spark, (1, "b")), TABLE)
    ends = scd2.endings(layers.live("t"), source, TABLE, FULL, T[1])
    scans = [l for l in ends._jdf.queryExecution().executedPlan().toString().splitlines() if "ReadSchema" in l]
    assert scans and all("ReadSchema: struct<id:int,_etl_hashdiff:string,_etl_run_id:string>" in l for l in scans)


@pytest.mark.parametrize("seed", range(2))
def test_stored_history_matches_model(spark, tmp_path, seed):
    """Random loads with repeated and NULL keys through the store, compaction in between."""
    import random

    import test_scd2 as model

    rng = random.Random(100 + seed)
    layers = Layers(spark, str(tmp_path))
    first = model.random_batch(rng, 12)
    load_history(layers, "m", model.batch_frame(spark, first), model.TABLE, FULL, model.T[0], "run-0")
    history = [
        {"a": a, "b": b, "v": v, "from": model.T[0], "to": None, "current": True, "deleted": False, "run": "run-0"}
        for a, b, v, _ in first
    ]
    for i, mode in enumerate((INCREMENTAL, FULL, INCREMENTAL), 1):
        batch = model.random_batch(rng, 12)
        history, stats = model.model_merge(history, batch, mode, model.T[i], f"run-{i}")
        source = model.batch_frame(spark, batch)
        got = load_history(layers, "m", source, model.TABLE, mode, model.T[i], f"run-{i}", compact_after=2)
        assert got == stats
        assert model.plain(layers.history("m")) == model.model_rows(history)


def test_everything_deleted(spark, tmp_path):
    layers = Layers(spark, str(tmp_path))
    load_history(layers, "t", frame(spark, (1, "a")), TABLE, FULL, T[0], "run-1")
    gone = load_history(layers, "t", frame(spark, (1, "a")).limit(0), TABLE, FULL, T[1], "run-2")
    assert gone == stats_of(1, 0, 0, 0, 0, 1)
    assert layers.live("t").isEmpty() and layers.history("t").count() == 1
    load_history(layers, "t", frame(spark, (1, "a")), TABLE, FULL, T[2], "run-3")
    assert layers.live("t").count() == 1 and layers.history("t").count() == 2


def test_run_ids_name_folders(spark, tmp_path):
    with pytest.raises(ValueError, match="run id"):
        Layers(spark, str(tmp_path)).append("monitoring", "x", frame(spark, (1, "a")), "../elsewhere")


def test_replay(spark, tmp_path):
    layers = Layers(spark, str(tmp_path))
    load_history(layers, "t", frame(spark, (1, "a"), (2, "b")), TABLE, FULL, T[0], "run-1")
    with pytest.raises(ValueError, match="no staging rows"):
        replay_from_staging(layers, "t", frame(spark, (1, "a")).limit(0), TABLE, T[1], "recovery-1")
    replay_from_staging(layers, "t", frame(spark, (1, "z")), TABLE, T[1], "recovery-1")
    assert rows(layers.live("t").select("id", "v")) == [(1, "z")]


def test_stream(spark, tmp_path):
    """Three files, one micro-batch each; a restart finds nothing left to do."""
    landing, layers = tmp_path / "landing", Layers(spark, str(tmp_path / "warehouse"))
    landing.mkdir()
    schema = frame(spark, (1, "a")).schema

    def put(name, ids, values, age):
        import os

        path = landing / name
        pq.write_table(pa.table({"id": pa.array(ids, pa.int32()), "v": values}), path)
        os.utime(path, (1_700_000_000 + age, 1_700_000_000 + age))

    def drain():
        stream = landed_stream(spark, str(landing), schema, max_files=1)
        feed = feed_history(
            stream, layers, "t", TABLE, str(tmp_path / "checkpoint"), run_ts=lambda batch: T[batch]
        )
        feed.awaitTermination()

    put("f1.parquet", [1, 2], ["a", "b"], 0)
    put("f2.parquet", [2, 3], ["B", "c"], 10)
    drain()
    put("f3.parquet", [3, 4], ["c", "d"], 20)
    drain()
    drain()
    assert rows(layers.live("t").select("id", "v", F.col("_etl_valid_from").cast("string"))) == [
        (1, "a", T[0]),
        (2, "B", T[1]),
        (3, "c", T[1]),
        (4, "d", T[2]),
    ]
    assert layers.past("t").count() == 1
    assert len(layers.commits("t").deltas) == 2
