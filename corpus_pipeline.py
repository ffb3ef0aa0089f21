"""From raw documents to packed training sequences, in five stages.

Each stage takes the documents its predecessor kept and returns documents; the last
returns the pieces of the packed sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerloom.session import work_dir
from llm import language, near_text, packing, passages, quality
from llm.common import importable, keep_rows, text_key

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
SEQUENCE = 2048
DOCUMENTS_AT_A_TIME = 128


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are no outliers of their language and source."""
    judged = quality.judge(docs.select("doc_id", "text", "lang", "source", text_key().alias("text_key")), carry=("doc_id", "text_key"))
    return keep_rows(docs, judged).select(*COLUMNS)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents near enough to a centroid of some language."""
    model = language.fit(docs.where(~language.held_out(F.col("doc_id"))))
    judged = language.predict(docs.select(*COLUMNS), model, with_text=True)
    return judged.where("not rejected").select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return keep_rows(docs, near_text.near_duplicates(docs)).select(*COLUMNS)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that an earlier one has."""
    cut = passages.remove_repeats(docs, with_text=True, carry=("lang", "source", "n_chars"))
    changed = F.col("n_removed") > 0
    return cut.select(
        "doc_id",
        F.col("kept_text").alias("text"),
        "lang",
        "source",
        F.when(changed, F.length("kept_text").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"),
    )


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of SEQUENCE tokens."""
    return packing.pack(packing.cut(docs, public_tokenizers.path("byte_bpe_50k.json"), SEQUENCE, 0), SEQUENCE)


def _stage(function):
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        importable(spark)
        # Documents are long: Spark's 10,000 of them at a time fill a task's memory, in Python and in the JVM's Arrow buffers.
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(DOCUMENTS_AT_A_TIME))
        return function(spark, docs, sf_dir)

    return run_stage


STAGES = [
    ("quality rules", _stage(quality_rules)),
    ("language ID", _stage(language_id)),
    ("MinHash near-dedup", _stage(near_dedup)),
    ("substring dedup", _stage(substring_dedup)),
    ("best-fit packing", _stage(best_fit_packing)),
]

#: The outlier, language and alignment stages can't be said in SQL; tests/llm tests the operators one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = work_dir(spark, "stage-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
