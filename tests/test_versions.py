"""One order of versions over all loads, and the checks of landed files."""

from __future__ import annotations

import hashlib
import random
from dataclasses import replace
from datetime import datetime, timedelta
from types import SimpleNamespace

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_landing import NOW, Folder, meta

from layerloom.constants import EXTRACT_FILE, EXTRACTED_AT, FULL, FULL_RESET, INCREMENTAL, ROW_POSITION, SOURCE_ROW
from layerloom.operators import scd2
from layerloom.operators.scd2 import History
from layerloom.plans.full_run import FileSet, load_table
from layerloom.plans.history_load import load_history, replay_from_staging
from layerloom.sources import landing_files
from layerloom.sources.layers import Layers

TABLE = History(keys=("id",), columns=("id", "v"), as_of=ROW_POSITION)
START = datetime(2024, 1, 1)


def at(day):
    return START + timedelta(days=day)


def batch(spark, day, *data, file="f"):
    schema = f"id int, v string, {EXTRACTED_AT} timestamp_ntz, {EXTRACT_FILE} string, {SOURCE_ROW} bigint"
    return spark.createDataFrame([(i, v, None if day is None else at(day), file, k) for k, (i, v) in enumerate(data)], schema)


def live(layers):
    return rows(layers.live("t").select("id", "v"))


def load(layers, mode, run, *frames):
    whole = frames[0]
    for other in frames[1:]:
        whole = whole.unionByName(other)
    return load_history(layers, "t", whole, TABLE, mode, at(run), f"run-{run}")


def test_late_rows_change_nothing(spark, tmp_path):
    layers = Layers(spark, str(tmp_path))
    load(layers, INCREMENTAL, 1, batch(spark, 5, (1, "new"), (2, "b")))
    stats = load(layers, INCREMENTAL, 2, batch(spark, 3, (1, "old"), (3, "c")))
    assert live(layers) == [(1, "new"), (2, "b"), (3, "c")] and stats["closed_records"] == 0
    # a row without a position is older than any other
    load(layers, INCREMENTAL, 3, batch(spark, None, (1, "none")))
    assert live(layers)[0] == (1, "new")
    # the same content again, extracted later, holds against what came in between
    load(layers, INCREMENTAL, 4, batch(spark, 9, (1, "new")))
    assert layers.compact("t")
    load(layers, INCREMENTAL, 5, batch(spark, 7, (1, "between")))
    assert live(layers)[0] == (1, "new")
    load(layers, INCREMENTAL, 6, batch(spark, 10, (1, "newer")))
    assert live(layers)[0] == (1, "newer") and layers.past("t").count() == 1


def test_late_full_extract(spark, tmp_path):
    layers = Layers(spark, str(tmp_path))
    load(layers, FULL, 1, batch(spark, 2, (1, "a"), (2, "b")))
    load(layers, INCREMENTAL, 2, batch(spark, 6, (3, "c"), (1, "A")))
    load(layers, FULL, 3, batch(spark, 4, (1, "late")))  # 2 is gone since day 4; 1 and 3 are newer than that
    assert live(layers) == [(1, "A"), (3, "c")]
    load(layers, INCREMENTAL, 4, batch(spark, 3, (2, "was deleted later")))
    assert live(layers) == [(1, "A"), (3, "c")]
    load(layers, FULL_RESET, 5, batch(spark, 1, (9, "z")))
    load(layers, INCREMENTAL, 6, batch(spark, 2, (9, "zz")))
    assert live(layers) == [(9, "zz")]


def test_files_of_one_batch_and_replay(spark, tmp_path):
    """The newer run wins in a replay although its file's number within its load is smaller."""
    layers = Layers(spark, str(tmp_path))
    first = batch(spark, 1, (1, "a"), (2, "b"), file="x").unionByName(batch(spark, 1, (1, "aa"), file="y"))
    second = batch(spark, 2, (1, "run 2"), (1, "run 2, later row"), file="a")
    load(layers, INCREMENTAL, 1, batch(spark, 0, (1, "zero")))
    layers.stage("t", first, "run-1", reset=True)
    layers.stage("t", second, "run-2", reset=False)
    replay_from_staging(layers, "t", layers.read("staging", "t"), TABLE, at(9), "recovery-1")
    assert live(layers) == [(1, "run 2, later row"), (2, "b")]
    again = replay_from_staging(layers, "t", layers.read("staging", "t"), TABLE, at(10), "recovery-2")
    assert set(again.values()) == {0}


def test_without_guard_the_newest_staging_row_wins(spark):
    plain = replace(TABLE, as_of=())
    staged = batch(spark, 1, (1, "file a"), file="a").unionByName(batch(spark, 1, (1, "file b"), file="b"))
    assert scd2.incoming(staged, plain).first()["v"] == "file b"


def test_pure_merge_keeps_the_newest_confirmation(spark):
    history = scd2.merge(None, batch(spark, 1, (1, "a"), (2, "b")), TABLE, INCREMENTAL, at(1), "r1")
    history = scd2.merge(history, batch(spark, 5, (1, "a")), TABLE, INCREMENTAL, at(2), "r2")
    history = scd2.merge(history, batch(spark, 3, (1, "late"), (2, "B")), TABLE, INCREMENTAL, at(3), "r3")
    assert rows(scd2.current_view(history).select("id", "v")) == [(1, "a"), (2, "B")]
    history = scd2.merge(history, batch(spark, 2, (1, "late")), TABLE, FULL, at(4), "r4")
    assert rows(scd2.current_view(history).select("id", "v")) == [(1, "a"), (2, "B")]


@pytest.mark.parametrize("seed", range(2))
def test_any_order_of_loads_ends_alike(spark, tmp_path, seed):
    """Loads arrive in random order; the live rows are those of the newest extracts whatever the order."""
    rng = random.Random(seed)
    loads = []
    for day in range(6):
        mode = FULL if rng.random() < 0.35 else INCREMENTAL
        loads.append((day, mode, [(i, f"v{rng.randint(0, 2)}") for i in rng.sample(range(8), rng.randint(1, 6))]))
    full = max((day for day, mode, _ in loads if mode == FULL), default=-1)
    want = {}
    for day, _, data in loads:
        if day >= full:
            want.update(data)
    rng.shuffle(loads)
    layers = Layers(spark, str(tmp_path))
    for k, (day, mode, data) in enumerate(loads):
        load_history(layers, "t", batch(spark, day, *data), TABLE, mode, at(k), f"run-{k}", compact_after=3)
    assert live(layers) == sorted(want.items())


# -- parts of a history -------------------------------------------------------------------------


@pytest.mark.parametrize("seed", range(2))
def test_parted_history_matches_model(spark, tmp_path, seed):
    """Random loads with repeated and NULL keys over many parts; compaction and purges change nothing to see."""
    import test_scd2 as model

    rng = random.Random(200 + seed)
    layers = Layers(spark, str(tmp_path), rows_per_part=3)
    first = model.random_batch(rng, 12)
    load_history(layers, "m", model.batch_frame(spark, first), model.TABLE, FULL, model.T[0], "run-0")
    assert layers.commits("m").parts == 4
    history = [
        {"a": a, "b": b, "v": v, "from": model.T[0], "to": None, "current": True, "deleted": False, "run": "run-0"}
        for a, b, v, _ in first
    ]
    for i, mode in enumerate((INCREMENTAL, INCREMENTAL, FULL), 1):
        data = model.random_batch(rng, 2 if i < 3 else 9)
        history, stats = model.model_merge(history, data, mode, model.T[i], f"run-{i}")
        got = load_history(layers, "m", model.batch_frame(spark, data), model.TABLE, mode, model.T[i], f"run-{i}", compact_after=1)
        assert got == stats
        layers.purge("m", keep=0)
        assert model.plain(layers.history("m")) == model.model_rows(history)


def test_loads_read_and_compaction_rewrites_touched_parts(spark, tmp_path):
    layers = Layers(spark, str(tmp_path), rows_per_part=10)
    everything = spark.range(100).select(F.col("id").cast("int"), F.lit("a").alias("v"))
    table = History(keys=("id",), columns=("id", "v"))
    load_history(layers, "t", everything, table, FULL, at(0), "run-0")
    state = layers.commits("t")
    assert state.parts == 10
    batch_of_two = everything.filter("id in (3, 4)").withColumn("v", F.lit("b"))
    parts = sorted({r[0] for r in batch_of_two.select(state.part()).collect()})
    assert 0 < len(parts) <= 2
    others = {f: f.read_bytes() for f in (tmp_path / "ods" / "t" / "base").rglob("part-*.parquet") if int(f.parent.name.split("=")[1]) not in parts}
    for f, content in others.items():  # their pages must not be read
        f.write_bytes(content[:4] + b"\0" * 60 + content[64:])
        f.with_name(f".{f.name}.crc").unlink(missing_ok=True)
    with pytest.raises(Exception, match="Parquet|parquet|read"):
        layers.live("t").agg(F.max("v"), F.max("id")).collect()
    stats = load_history(layers, "t", batch_of_two, table, INCREMENTAL, at(1), "run-1")
    assert stats["updated_records"] == 2 and stats["new_records"] == 0
    for f, content in others.items():
        f.write_bytes(content)
    assert layers.compact("t")
    state = layers.commits("t")
    assert state.bases[-1].written == frozenset(parts) and len(state.owners()) == 2
    assert rows(layers.live("t").groupBy("v").count()) == [("a", 98), ("b", 2)]
    assert layers.past("t").count() == 2
    # a load of all keys changes most parts: everything is rewritten, the older bases are let go
    load_history(layers, "t", everything.withColumn("v", F.lit("c")), table, INCREMENTAL, at(2), "run-2", compact_after=1)
    assert len(layers.commits("t").owners()) == 1
    before = rows(layers.history("t"))
    removed = layers.purge("t", keep=0)
    assert removed and not any((tmp_path / "ods" / "t" / "base").glob("_load=run-run-0/_state=live/*"))
    assert rows(layers.history("t")) == before and len(before) == 100 + 2 + 100


def test_storage_stays_bounded(spark, tmp_path):
    layers = Layers(spark, str(tmp_path))
    table = History(keys=("id",), columns=("id", "v"))
    for k in range(9):
        load_history(layers, "t", frame(spark, k), table, INCREMENTAL, at(k), f"run-{k}", compact_after=3)
    held = [p for p in (tmp_path / "ods" / "t").glob("*/_load=*") if any(p.rglob("*.parquet"))]
    assert len([p for p in held if p.parent.name in ("opened", "ended")]) <= 2 * 5
    assert not list((tmp_path / "ods" / "t" / "work").glob("*/_load=*"))
    assert layers.history("t").count() == 9 and layers.live("t").count() == 1


def frame(spark, k):
    return spark.createDataFrame([(1, f"v{k}")], "id int, v string")


# -- landed files --------------------------------------------------------------------------------


def test_raw_load_moves_no_rows(spark, tmp_path):
    paths = []
    for k in range(12):
        paths.append(f"file:{tmp_path}/a b+{k}.parquet")
        pq.write_table(pa.table({"id": [k, k + 100]}), tmp_path / f"a b+{k}.parquet")
    extracted = [at(k % 5) for k in range(12)]
    placed = landing_files.positioned(landing_files.read_file_set(spark, paths, checked=True), paths, extracted)
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan and "from_json" not in plan
    got = {r["id"]: (r[EXTRACTED_AT], r[EXTRACT_FILE], r[SOURCE_ROW]) for r in placed.collect()}
    assert got == {i: (at(k % 5), f"a b+{k}.parquet", i // 100) for k in range(12) for i in (k, k + 100)}


def test_only_files_that_pass_the_gate_are_opened(spark, tmp_path, monkeypatch):
    folder = Folder(tmp_path)
    folder.land("client_1", metadata=meta(file_info={"checksum_md5": "0" * 32}))
    folder.land("client_2", metadata=meta())
    folder.land("client_3")
    folder.land("stock_1", metadata=meta("stock", file_info={"checksum_md5": "0" * 32}))
    opened = []
    check = landing_files.check_contents
    monkeypatch.setattr(landing_files, "check_contents", lambda files: (opened.extend(rows(files.select("base_name", "digest"))), check(files))[1])
    listing = landing_files.scan_landing(spark, str(folder.root), NOW, tables=["client"])
    assert opened == [("client_1", True), ("client_2", False)]
    assert rows(listing.select("base_name", "skip_reason")) == [("client_1", "validation_failed"), ("client_2", None)]


def test_files_are_read_in_pieces(tmp_path, monkeypatch):
    path = tmp_path / "é 1.parquet"
    pq.write_table(pa.table({"id": list(range(10_000)), "v": ["x"] * 10_000}), path)
    monkeypatch.setattr(landing_files, "DIGEST_BYTES", 1000)
    readable, count, md5, print_ = landing_files._check_file(f"file:{path}", True)
    assert (readable, count, md5) == (True, 10_000, hashlib.md5(path.read_bytes()).hexdigest())
    assert landing_files._check_file(f"file:{path}", False) == (True, 10_000, None, print_)
    path.write_bytes(path.read_bytes()[:-20])
    assert landing_files._check_file(f"file:{path}", True) == (False, None, None, None)
    assert landing_files._check_file(f"file:{tmp_path}/gone.parquet", True) == (False, None, None, None)


def test_load_of_different_schemas_fails(spark, tmp_path):
    spec = SimpleNamespace(physical_name="t", table_name="t", config_name=None)
    files = FileSet("run-1", "t", None, "t", INCREMENTAL, ("a", "b"), (at(1), at(1)), schemas=2)
    with pytest.raises(ValueError, match="different schemas"):
        load_table(Layers(spark, str(tmp_path)), files, spec, "run-1", NOW)


def test_schema_prints(spark, tmp_path):
    folder = tmp_path / "parquet"
    folder.mkdir()
    for name, columns in (("a", {"id": [1]}), ("b", {"id": [2]}), ("c", {"id": ["x"]}), ("d", {"id": [1], "e": [1]})):
        pq.write_table(pa.table(columns), folder / f"{name}.parquet")
    prints = {r["base_name"]: r["schema_print"] for r in landing_files.measure_content(spark, str(folder)).collect()}
    assert prints["a"] == prints["b"] and len(set(prints.values())) == 3
    sums = landing_files.measure_content(spark, str(folder), checksums=False)
    assert sums.filter(F.col("actual_md5").isNotNull()).isEmpty()
