"""Session defaults and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


# A shuffle partition of this size sorts in an executor core's share of memory.
SHUFFLE_PARTITION_BYTES = 512 * 1024 * 1024
MIN_PARTITIONS, MAX_PARTITIONS = 200, 200_000


def shuffle_partitions(shuffle_bytes: int) -> int:
    """Initial partition count for the largest shuffle expected; AQE merges what is too small."""
    return max(MIN_PARTITIONS, min(MAX_PARTITIONS, -(-shuffle_bytes // SHUFFLE_PARTITION_BYTES)))


def build_session(
    app_name: str = "layerloom", master: str | None = None, shuffle_bytes: int | None = None, **conf: str
) -> SparkSession:
    """A session with the settings the library is tuned for.

    AQE picks the final partition counts, splits skewed join partitions and
    turns a join into a broadcast once the *measured* side is below the
    threshold, so no operator carries a broadcast hint of its own.
    ``shuffle_bytes`` is the size of the largest shuffle expected.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        **conf,
    }
    if shuffle_bytes is not None:
        settings.setdefault("spark.sql.shuffle.partitions", str(shuffle_partitions(shuffle_bytes)))
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def hot_keys_split(spark: SparkSession) -> Iterator[None]:
    """Joins run inside are split on a hot key even where the rows are then grouped by key, at the cost of a shuffle."""
    name = "spark.sql.adaptive.forceOptimizeSkewedJoin"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder under the cluster's shared ``spark.checkpoint.dir``.

    Every executor must be able to read what another one wrote here, so a
    machine-local folder is used only on a local master that names none.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="layerloom-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
