"""Readers for a landing folder: parquet extracts with JSON sidecars.

Layout: ``parquet/{base}.parquet``, ``metadata/{base}_metadata.json``,
``status/{base}_status.json``. Everything is listed, parsed and counted by
Spark; a missing folder reads as empty.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerloom.constants import EXTRACT_FILE, EXTRACTED_AT, SOURCE_ROW
from layerloom.operators import landing
from layerloom.operators.catalog import DUMP_ORDER

METADATA_JSON = (
    "table_name string, config_name string, physical_name string, load_mode string, row_count bigint, "
    "extract_timestamp string, source string, file_info struct<checksum_md5: string>, "
    "columns array<struct<column_name: string, data_type: string, progress_type: string, "
    "is_mandatory: boolean, width: int, scale: int, extent: int>>, _corrupt string"
)
STATUS_JSON = "status string, error string, load_mode string, _corrupt string"
DUMP_JSON = (
    "table_name string, columns array<struct<name: string, type: string, mandatory: boolean, "
    "width: int, scale: int, `order`: int>>, _corrupt string"
)
RESULTS_JSON = "metadata struct<invocation_id: string>, results array<struct<unique_id: string, status: string, execution_time: double>>"


def _or_empty(spark: SparkSession, load: Callable[[], DataFrame], schema: str) -> DataFrame:
    try:
        return load()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def scanned_path() -> Column:
    """Path of the scanned file as the ``binaryFile`` source spells it.

    ``_metadata.file_path`` is percent-encoded, but leaves ``+`` alone.
    """
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def base_name(path: Column, suffix: str) -> Column:
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), f"{suffix}$", "")


def _binary(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """Parquet files of a folder (:data:`landing.FILE_SCHEMA`); contents are not read."""
    return _or_empty(
        spark,
        lambda: _binary(spark, folder, "*.parquet").select(
            base_name(F.col("path"), r"\.parquet").alias("base_name"),
            F.element_at(F.split("path", "/"), -1).alias("file_name"),
            "path",
            F.col("length").alias("size_bytes"),
        ),
        landing.FILE_SCHEMA,
    )


def _json(spark: SparkSession, folder: str, pattern: str, schema: str) -> DataFrame:
    return (
        spark.read.schema(schema)
        .options(multiLine=True, mode="PERMISSIVE", columnNameOfCorruptRecord="_corrupt", pathGlobFilter=pattern)
        .json(folder)
    )


def read_metadata(spark: SparkSession, folder: str) -> DataFrame:
    """Metadata sidecars (:data:`landing.METADATA_SCHEMA`)."""

    def load() -> DataFrame:
        rows = _json(spark, folder, "*_metadata.json", METADATA_JSON)
        return rows.select(
            base_name(scanned_path(), r"_metadata\.json").alias("base_name"),
            F.col("_corrupt").isNull().alias("readable"),
            "table_name",
            "config_name",
            "physical_name",
            "load_mode",
            "row_count",
            F.when(F.col("columns").isNotNull(), F.size("columns")).alias("column_count"),
            "extract_timestamp",
            "source",
            "file_info.checksum_md5",
        )

    return _or_empty(spark, load, landing.METADATA_SCHEMA)


def read_status(spark: SparkSession, folder: str) -> DataFrame:
    """Status sidecars (:data:`landing.STATUS_SCHEMA`)."""

    def load() -> DataFrame:
        rows = _json(spark, folder, "*_status.json", STATUS_JSON)
        return rows.select(
            base_name(scanned_path(), r"_status\.json").alias("base_name"),
            F.col("_corrupt").isNull().alias("readable"),
            "status",
            "error",
            "load_mode",
        )

    return _or_empty(spark, load, landing.STATUS_SCHEMA)


def count_rows(spark: SparkSession, *paths: str) -> DataFrame:
    """``file_path, actual_row_count`` of parquet files, from row group counts only.

    No column is decoded: the probe schema names none that exists. Unreadable
    and empty files give no row.
    """
    scan = spark.read.schema("`__probe` int").option("ignoreCorruptFiles", True).parquet(*paths)
    return scan.groupBy(scanned_path().alias("file_path")).agg(
        F.count(F.lit(1)).alias("actual_row_count")
    )


# What a file check reads at a time, and the tasks per core that files are dealt to.
DIGEST_BYTES, TASKS_PER_CORE = 8 * 1024 * 1024, 4
FOOTER_SCHEMA = "base_name string, readable boolean, actual_row_count bigint, actual_md5 string, schema_print string"


def _check_file(path: str, digest: bool) -> tuple[bool, int | None, str | None, str | None]:
    """(readable, rows, MD5, schema print) of one parquet file, from its footer; the MD5 is read in pieces."""
    import hashlib
    from urllib.parse import quote

    import pyarrow as pa
    import pyarrow.parquet as pq
    from pyarrow import fs

    store, place = fs.FileSystem.from_uri(quote(path, safe="/:@"))  # a store that can't be opened is an error of the run, not of a file
    md5 = None
    try:
        with store.open_input_file(place) as file:
            footer = pq.read_metadata(file)
        columns = [footer.schema.column(k) for k in range(footer.num_columns)]
        schema = ", ".join(f"{c.path} {c.physical_type} {c.logical_type}" for c in columns)
        if digest:
            total = hashlib.md5(usedforsecurity=False)
            with store.open_input_stream(place, buffer_size=DIGEST_BYTES) as stream:
                while piece := stream.read(DIGEST_BYTES):
                    total.update(piece)
            md5 = total.hexdigest()
        return True, footer.num_rows, md5, hashlib.md5(schema.encode(), usedforsecurity=False).hexdigest()
    except (OSError, pa.ArrowException):
        return False, None, md5, None


def _check_files(batches):
    import pyarrow as pa

    for batch in batches:
        for name, path, digest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            columns = [[name], *([x] for x in _check_file(path, digest))]
            kinds = (pa.string(), pa.bool_(), pa.int64(), pa.string(), pa.string())
            arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, ["base_name", "readable", "actual_row_count", "actual_md5", "schema_print"])


def check_contents(files: DataFrame) -> DataFrame:
    """What files really hold (:data:`FOOTER_SCHEMA`), in one distributed pass over ``base_name, path, digest``.

    A task reads the footers of its slice of the list and, where ``digest`` is
    true, the file's bytes in pieces of a few megabytes, so a file may have any
    size. A damaged or vanished file is an outcome of that file. The list never
    passes through the driver.
    """
    slices = files.sparkSession.sparkContext.defaultParallelism * TASKS_PER_CORE
    listed = files.select("base_name", "path", "digest").repartition(slices)
    return listed.mapInArrow(_check_files, FOOTER_SCHEMA)


def measure_content(spark: SparkSession, folder: str, checksums: bool = True) -> DataFrame:
    """What all extracts of a folder hold, whatever their sidecars say (:data:`FOOTER_SCHEMA`)."""
    return check_contents(list_files(spark, folder).withColumn("digest", F.lit(checksums)))


def scan_landing(
    spark: SparkSession,
    root: str,
    run_ts: str,
    validate: bool = True,
    checksums: bool = True,
    tables: Sequence[str] | None = None,
) -> DataFrame:
    """The inventory of a landing folder, see :func:`landing.inventory`.

    Sidecars and the table filter decide first: only files they let through
    are opened, and only those whose metadata has a checksum are read whole.
    Validated files also carry the print of their schema, all say whether they are dated.
    """
    files, metadata = list_files(spark, f"{root}/parquet"), read_metadata(spark, f"{root}/metadata")
    status = read_status(spark, f"{root}/status")
    gated = landing.inventory(files, metadata, status, None, run_ts, tables, dated=True)
    if not validate:
        return gated.withColumn("schema_print", F.lit(None).cast("string"))
    wanted = metadata.select("base_name", (F.col("checksum_md5").isNotNull() & F.lit(checksums)).alias("digest"))
    content = check_contents(landing.discovered(gated).join(wanted, "base_name"))
    return landing.validated(gated, metadata, content)


SCANNED_PATH = "_scanned_path"


def positioned(extract: DataFrame, paths: Sequence[str], extracted: Sequence[datetime]) -> DataFrame:
    """The extract with its file's path and with ROW_POSITION, all in the scan's own projection.

    The extraction time of each file is a constant map, looked up by path; it is dealt into small maps
    so a look-up costs the same for any number of files.
    """
    data = [F.col(f"`{c}`") for c in extract.columns]
    placed = extract.select(*data, scanned_path().alias(SCANNED_PATH), F.col("_metadata.row_index").alias(SOURCE_ROW))
    times = {p: t.isoformat(sep=" ") for p, t in zip(paths, extracted, strict=True)}
    if len(set(times.values())) == 1:
        when = F.lit(next(iter(times.values())))
    else:
        parts = max(1, len(times) // 4)
        dealt: list[dict[str, str]] = [{} for _ in range(parts)]
        for path, time in times.items():
            dealt[zlib.crc32(path.encode()) % parts][path] = time
        maps = F.from_json(F.lit(json.dumps(dealt)), "array<map<string,string>>")
        when = F.element_at(F.get(maps, (F.crc32(SCANNED_PATH) % parts).cast("int")), F.col(SCANNED_PATH))
    return placed.select(
        *data,
        SCANNED_PATH,
        when.cast("timestamp_ntz").alias(EXTRACTED_AT),
        F.element_at(F.split(F.col(SCANNED_PATH), "/"), -1).alias(EXTRACT_FILE),
        SOURCE_ROW,
    )


def read_file_set(spark: SparkSession, paths: Sequence[str], checked: bool = False) -> DataFrame:
    """All files of one table as one frame; differing schemas are an error.

    Unless the schema prints were ``checked`` already, footers are compared on the executors.
    """
    if len(paths) > 1 and not checked:
        listed = spark.createDataFrame([(p, p, False) for p in paths], "base_name string, path string, digest boolean")
        prints = check_contents(listed).groupBy("schema_print").agg(F.max("base_name").alias("example"))
        kinds = prints.limit(2).collect()
        if len(kinds) > 1:
            raise ValueError(f"the files of one set have different schemas: {kinds[1]['example']}")
    return spark.read.parquet(*paths)


def read_catalog_dump(spark: SparkSession, folder: str, ordered: bool = False) -> DataFrame:
    """Column catalog dumps (``*.metadata.json``), one row per column.

    With ``ordered`` rows also say where they stand (``DUMP_ORDER``: when and
    where the dump was written, place in its list), so that of a repeated
    column :func:`~layerloom.operators.catalog.catalog_upsert` takes the last.
    """
    rows = _json(spark, folder, "*.metadata.json", DUMP_JSON)
    order = [F.col("_metadata.file_modification_time"), F.col("_metadata.file_path"), F.col("position")]
    placed = rows.select("*", "_metadata").select("table_name", "_metadata", F.posexplode("columns").alias("position", "c"))
    return placed.select(
        "table_name",
        F.col("c.name").alias("column_name"),
        F.col("c.type").alias("data_type"),
        F.col("c.mandatory").alias("is_mandatory"),
        F.col("c.width").alias("width"),
        F.col("c.scale").alias("scale"),
        F.col("c.order").alias("progress_order"),
        *([c.alias(n) for c, n in zip(order, DUMP_ORDER, strict=True)] if ordered else []),
    )


def read_build_results(spark: SparkSession, path: str) -> DataFrame:
    """Build results JSON, one row per node."""
    rows = spark.read.schema(RESULTS_JSON).option("multiLine", True).json(path)
    return rows.select(
        F.coalesce("metadata.invocation_id", F.lit("unknown")).alias("run_id"), F.explode("results").alias("r")
    ).select(
        "run_id",
        F.coalesce("r.unique_id", F.lit("")).alias("unique_id"),
        F.coalesce("r.status", F.lit("unknown")).alias("status"),
        F.coalesce("r.execution_time", F.lit(0.0)).alias("execution_time"),
    )
