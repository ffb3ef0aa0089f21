"""Landing folder: inventory, validation, duplicate resolution."""

from __future__ import annotations

import hashlib
import json

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest import rows

from layerloom.operators import landing
from layerloom.sources import landing_files

pytestmark = pytest.mark.unit

NOW = "2024-06-01 00:00:00"


class Folder:
    def __init__(self, root):
        self.root = root
        for part in ("parquet", "metadata", "status"):
            (root / part).mkdir(parents=True)

    def land(self, base, n=5, metadata=None, status=None, content=None):
        path = self.root / "parquet" / f"{base}.parquet"
        if content is None:
            pq.write_table(pa.table({"id": pa.array(range(n), pa.int32())}), path)
        else:
            path.write_bytes(content)
        if metadata is not None:
            text = metadata if isinstance(metadata, str) else json.dumps(metadata)
            (self.root / "metadata" / f"{base}_metadata.json").write_text(text)
        if status is not None:
            text = status if isinstance(status, str) else json.dumps(status)
            (self.root / "status" / f"{base}_status.json").write_text(text)
        return path


def meta(table="client", n=5, mode="INCREMENTAL", **extra):
    columns = [{"column_name": "id", "data_type": "INTEGER", "progress_type": "integer", "extent": 0}]
    return {
        "table_name": table,
        "columns": columns,
        "row_count": n,
        "load_mode": mode,
        "extract_timestamp": "2024-05-01T10:00:00",
        **extra,
    }


def scan(spark, folder, **options):
    listing = landing_files.scan_landing(spark, str(folder.root), NOW, **options)
    return {r["base_name"]: r for r in listing.collect()}


def test_missing_and_empty_folders(spark, tmp_path):
    assert landing_files.scan_landing(spark, str(tmp_path / "nowhere"), NOW).isEmpty()
    folder = Folder(tmp_path / "landing")
    assert landing_files.scan_landing(spark, str(folder.root), NOW).isEmpty()


def test_inventory_rules(spark, tmp_path):
    folder = Folder(tmp_path)
    folder.land("client_1", metadata=meta(config_name="client_eu"), status={"status": "completed", "load_mode": "FULL"})
    folder.land("client_2", metadata=meta(physical_name="clients", extract_timestamp="soon"))
    folder.land("client_3")
    folder.land("client_4", metadata="{not json")
    folder.land("client_5", metadata={"table_name": "client", "row_count": 5, "load_mode": "FULL"})
    folder.land("client_6", metadata=meta(), status={"status": "extracting", "error": "still busy"})
    folder.land("client_7", metadata=meta(), status={"status": "failed"})
    folder.land("client_8", metadata=meta(), status="{broken")
    folder.land("client_9", metadata=meta(), status={"status": "ready_for_phase2"})
    folder.land("bad_1", metadata=meta("bad"), content=b"this is no parquet file")
    found = scan(spark, folder)
    assert {k: r["skip_reason"] for k, r in found.items()} == {
        "client_1": None,
        "client_2": None,
        "client_3": "no_metadata",
        "client_4": "no_metadata",
        "client_5": "invalid_metadata",
        "client_6": "not_completed",
        "client_7": "not_completed",
        "client_8": None,
        "client_9": None,
        "bad_1": "validation_failed",
    }
    assert found["client_1"]["physical_name"] == "client_eu" and found["client_1"]["load_mode"] == "FULL"
    assert found["client_2"]["physical_name"] == "clients"
    assert str(found["client_2"]["extraction_date"]) == NOW
    assert str(found["client_9"]["extraction_date"]) == "2024-05-01 10:00:00"
    assert found["client_6"]["status_error"] == "still busy"
    assert found["client_7"]["status_error"] == "Status: failed"
    assert found["client_1"]["actual_row_count"] == 5 and found["client_1"]["size_bytes"] > 0
    listing = landing_files.scan_landing(spark, str(folder.root), NOW)
    assert rows(landing.skip_counts(listing))[-1] == (None, 4) or (None, 4) in rows(landing.skip_counts(listing))
    assert landing.discovered(listing).count() == 4
    assert set(scan(spark, folder, tables=["bad"])) == {"bad_1"}


def test_unvalidated_scan_keeps_unreadable_files(spark, tmp_path):
    folder = Folder(tmp_path)
    folder.land("bad_1", metadata=meta("bad"), content=b"this is no parquet file")
    assert scan(spark, folder, validate=False)["bad_1"]["skip_reason"] is None


def test_checksum(spark, tmp_path):
    folder = Folder(tmp_path)
    path = folder.land("client_1", metadata=meta())
    digest = hashlib.md5(path.read_bytes()).hexdigest()
    folder.land("client_1", metadata=meta(file_info={"checksum_md5": digest}))
    folder.land("client_2", metadata=meta(file_info={"checksum_md5": "0" * 32}))
    found = scan(spark, folder)
    assert found["client_1"]["skip_reason"] is None
    assert found["client_2"]["skip_reason"] == "validation_failed"
    assert scan(spark, folder, checksums=False)["client_2"]["skip_reason"] is None


def test_empty_file_is_readable(spark, tmp_path):
    folder = Folder(tmp_path)
    folder.land("client_1", n=0, metadata=meta(n=0))
    found = scan(spark, folder)["client_1"]
    assert found["skip_reason"] is None and found["actual_row_count"] == 0


@pytest.mark.parametrize(
    ("expected", "actual", "off"),
    [(100, 110, False), (100, 111, True), (10_000, 10_100, False), (10_000, 10_101, True), (0, 500, False), (5, 0, False)],
)
def test_row_count_tolerance(spark, expected, actual, off):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(actual, expected)], "a bigint, e bigint")
    assert df.select(landing.row_count_mismatch(F.col("a"), F.col("e"))).first()[0] is off


def files(spark, *entries):
    return spark.createDataFrame(entries, "table_name string, file_name string, day string, load_mode string").selectExpr(
        "table_name", "file_name", "cast(day as timestamp_ntz) as extraction_date", "load_mode"
    )


def resolution(df):
    return {r["file_name"]: (r["resolution"], r["effective_mode"]) for r in df.collect()}


def test_resolution_by_newest_mode(spark):
    landed = files(
        spark,
        ("one", "a", "2024-01-01", "FULL"),
        ("full", "b", "2024-01-01", "INCREMENTAL"),
        ("full", "c", "2024-01-02", "FULL"),
        ("reset", "d", "2024-01-02", "FULL_RESET"),
        ("reset", "e", "2024-01-01", "FULL_RESET"),
        ("inc", "f", "2024-01-01", "FULL"),
        ("inc", "g", "2024-01-02", "INCREMENTAL"),
        ("inc", "h", "2023-12-31", "INCREMENTAL"),
        ("lisval", "i", "2024-01-01", "FULL"),
        ("lisval", "j", "2024-01-02", "FULL"),
    )
    assert resolution(landing.resolve_file_sets(landed)) == {
        "a": ("kept", "FULL"),
        "b": ("superseded", "INCREMENTAL"),
        "c": ("kept", "FULL"),
        "d": ("kept", "FULL_RESET"),
        "e": ("superseded", "FULL_RESET"),
        "f": ("consolidated", "INCREMENTAL"),
        "g": ("consolidated", "INCREMENTAL"),
        "h": ("consolidated", "INCREMENTAL"),
        "i": ("kept", "FULL"),
        "j": ("kept", "FULL"),
    }
    since = resolution(landing.resolve_file_sets(landed, since_last_full=True))
    assert since["h"][0] == "superseded" and since["f"][0] == "consolidated"


def test_resolution_of_extracts_in_parts(spark):
    from pyspark.sql import functions as F

    landed = files(
        spark,
        ("t", "a", "2024-01-01", "FULL"),
        ("t", "b", "2024-01-01", "FULL"),
        ("t", "c", "2024-01-02", "INCREMENTAL"),
        ("u", "d", "2024-01-01", "FULL"),
        ("u", "e", "2024-01-02", "FULL"),
        ("u", "f", "2024-01-02", "FULL_RESET"),
        ("u", "g", "2024-01-02", "FULL"),
    )
    got = resolution(landing.resolve_file_sets(landed.withColumn("is_dated", F.lit(True)), since_last_full=True, in_parts=True))
    assert {k: v[0] for k, v in got.items()} == {
        **dict.fromkeys("abc", "consolidated"), "d": "superseded", "e": "kept", "f": "superseded", "g": "kept"
    }
    # files whose time is not their own stand for themselves
    undated = resolution(landing.resolve_file_sets(landed.withColumn("is_dated", F.lit(False)), in_parts=True))
    assert undated["e"][0] == "superseded" and undated["g"][0] == "kept"


def test_consolidate_is_strict(spark):
    a, b = spark.createDataFrame([(1,)], "id int"), spark.createDataFrame([("x",)], "id string")
    assert rows(landing.consolidate([a, a])) == [(1,), (1,)]
    with pytest.raises(ValueError, match="schemas differ"):
        landing.consolidate([a, b])


def test_file_set_of_different_schemas(spark, tmp_path):
    one, two = str(tmp_path / "a.parquet"), str(tmp_path / "b.parquet")
    pq.write_table(pa.table({"id": [1]}), one)
    pq.write_table(pa.table({"id": [2], "extra": ["x"]}), two)
    assert landing_files.read_file_set(spark, [one]).count() == 1
    with pytest.raises(ValueError, match="different schemas"):
        landing_files.read_file_set(spark, [two, one])


def test_size_buckets(spark):
    from pyspark.sql import functions as F

    mb = landing.MEGABYTE
    df = spark.createDataFrame([(5 * mb - 1,), (5 * mb,), (50 * mb - 1,), (50 * mb,)], "s bigint")
    assert [r[0] for r in df.select(landing.size_bucket(F.col("s"))).collect()] == ["small", "medium", "medium", "large"]


def test_name_prefix(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("client_20251229_140021.parquet",)], "f string")
    assert df.select(landing.name_prefix(F.col("f"))).first()[0] == "client"


def test_catalog_dump_and_build_results(spark, tmp_path):
    dump = {"table_name": "client", "columns": [{"name": "id", "type": "INTEGER", "mandatory": True, "order": 1}, {"name": "znu", "type": "TEXT"}]}
    (tmp_path / "client.metadata.json").write_text(json.dumps(dump))
    assert rows(landing_files.read_catalog_dump(spark, str(tmp_path))) == [
        ("client", "id", "INTEGER", True, None, None, 1),
        ("client", "znu", "TEXT", None, None, None, None),
    ]
    results = {"results": [{"unique_id": "model.w.a", "status": "success", "execution_time": 1.5}, {"unique_id": "test.w.b"}]}
    path = tmp_path / "run_results.json"
    path.write_text(json.dumps(results))
    assert rows(landing_files.read_build_results(spark, str(path))) == [
        ("unknown", "model.w.a", "success", 1.5),
        ("unknown", "test.w.b", "unknown", 0.0),
    ]
