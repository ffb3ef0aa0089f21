"""Helpers that several operators share."""

from __future__ import annotations

import gc
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerloom.session import work_dir


def importable(spark: SparkSession) -> None:
    """Lets the Python workers import this package from where the driver does (a cluster has it installed or shared)."""
    root, environment = str(Path(__file__).resolve().parents[1]), spark.sparkContext.environment
    places = [p for p in environment.get("PYTHONPATH", "").split(":") if p]
    if root not in places:
        environment["PYTHONPATH"] = ":".join([root, *places])


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The rows written once to the shared folder: later plans start from the files, also after a lost executor."""
    spark = df.sparkSession
    path = work_dir(spark, purpose)
    df.write.parquet(path)
    # Shuffle files of finished steps go once the driver's JVM finds them unreachable; ask it to look.
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def arrow_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Tables written inside pass at most so many rows at a time to Python tasks; for large rows."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def text_key(text: str = "text") -> Column:
    """Tells rows with one id but different texts apart; a null text has the key of an empty one."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def connected_components(edges: DataFrame, purpose: str) -> DataFrame:
    """(node, component) of every node in edges (a, b); component is the smallest node that links reach.

    Each round every node takes the smallest label among its neighbours and then the label of that
    label, so chains shorten geometrically. Labels are aggregated map side: a node with millions of
    neighbours is one row per task. Nothing but the number of changed labels reaches the driver.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stored(both.where("a <> b").distinct(), f"{purpose}-links")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("component")), f"{purpose}-labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), F.col("component").alias("seen")), "b")
        lower = near.groupBy(F.col("a").alias("node")).agg(F.min("seen").alias("seen"))
        hop = labels.select(F.col("node").alias("component"), F.col("component").alias("far"))
        step = (
            labels.join(lower, "node", "left")
            .join(hop, "component", "left")
            .select(
                "node",
                F.least("component", F.coalesce("seen", "component"), F.coalesce("far", "component")).alias("component"),
                F.col("component").alias("before"),
            )
        )
        step = stored(step, f"{purpose}-labels")
        changed = step.where("component <> before").limit(1).count()
        labels = step.select("node", "component")
        if not changed:
            return labels


def document_keys(docs: DataFrame, doc_id: str, text: str, carry: dict[str, str] | None = None) -> DataFrame:
    """(id, th, text) of rows, and columns to carry along (new name: name): th tells texts under one id apart, a null id is the smallest long, a null text empty.

    Repeated rows (same id and text) have one key, so they count as one document and share its result.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("id"), F.hash(whole).alias("th"), whole.alias("text"),
        *[F.col(f"`{name}`").alias(new) for new, name in (carry or {}).items()],
    )


NO_ID = -(2**63)


def real_id() -> Column:
    return F.when(F.col("id") != NO_ID, F.col("id")).alias("doc_id")


def spread_of(spark: SparkSession) -> int:
    """Buckets for records that tasks pack themselves: as many as there are shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fresh(name: str, df: DataFrame) -> str:
    """The name, with underscores in front until no column of df has it in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def keep_rows(docs: DataFrame, decisions: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of docs whose (doc_id, text_key) has kept in decisions; nulls count as equal. Other columns may have any name."""
    own, key = fresh("_id", docs), fresh("_key", docs)
    kept = decisions.where("kept").select(F.col("doc_id").alias(own), F.col("text_key").alias(key)).distinct()
    return docs.join(kept, F.col(doc_id).eqNullSafe(F.col(own)) & (text_key(text) == F.col(key)), "left_semi")
