"""The registered queries of this subpackage."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerloom.session import work_dir
from llm import divergence, language, main_text, merge_replay, near_text, oracles, packing, passages, quality, suffixes, token_files, url_rules, vectors, whitening
from llm.common import importable, stored, table

SEQUENCE = 2048

QUERIES = {}
ORACLES: dict[str, str] = {
    "op1_suffix_repeats": oracles.BYTE_REPEATS,
    "op8_product_quantised_near_duplicates": oracles.COSINE_LINKS,
    "op10_passage_repeats": oracles.WORD_REPEATS,
}


def query(build):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        importable(spark)
        return build(spark, folder)

    QUERIES[build.__name__] = run
    return run


@query
def op2_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.cut(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), SEQUENCE, 0)
    return packing.pack(pieces, SEQUENCE)


@query
def op3_robust_outliers(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judge(table(spark, folder, "documents")).drop("lang", "source")


@query
def op5_token_files(spark: SparkSession, folder: str) -> DataFrame:
    files = work_dir(spark, "token-files")
    index = token_files.write(table(spark, folder, "documents"), files, public_tokenizers.path("word_bpe_49k.json"), 1, SEQUENCE)
    return token_files.read(stored(index, "token-index"), files)


@query
def op6_merge_replay(spark: SparkSession, folder: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return merge_replay.encode_decode(table(spark, folder, "documents"), ranks, public_tokenizers.PATTERN)


@query
def op7_nearest_centroid_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = language.fit(docs.where(~language.held_out(F.col("doc_id"))))
    held = docs.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "text")
    return language.predict(held, model)


@query
def op8_product_quantised_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, folder, "embeddings"))


# The rules of the contract.
URL_RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)


@query
def op9_url_association_rules(spark: SparkSession, folder: str) -> DataFrame:
    return url_rules.judge(table(spark, folder, "pages"), table(spark, folder, "labels"), URL_RULES)


@query
def op10_passage_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return passages.remove_repeats(table(spark, folder, "documents"))


@query
def op1_suffix_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return suffixes.remove_repeats(table(spark, folder, "documents"))


@query
def op4_order_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_text.near_duplicates(table(spark, folder, "documents"))


@query
def op11_block_rules_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return main_text.extract(table(spark, folder, "pages"))


@query
def op12_exact_whitening(spark: SparkSession, folder: str) -> DataFrame:
    whitened = whitening.whiten(table(spark, folder, "embeddings"))
    return whitened.withColumn("deviation", F.col("deviation").cast("bigint"))


@query
def op13_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(table(spark, folder, "documents"))


ORACLES["op13_source_divergence"] = r"""
WITH docs AS (SELECT coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
numbered AS (SELECT row_number() OVER () AS doc, lang, source,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM docs),
words AS (SELECT doc, lang, source, unnest(terms) AS term FROM numbered),
kept AS (SELECT lang, term, count(*) AS whole FROM words GROUP BY lang, term HAVING count(DISTINCT doc) >= 10),
counts AS (SELECT w.lang, w.source, w.term, count(*) AS n FROM words w JOIN kept k ON w.lang = k.lang AND w.term = k.term GROUP BY ALL),
sizes AS (SELECT lang, count(*) AS v, sum(whole) AS total FROM kept GROUP BY lang),
groups AS (SELECT g.lang, g.source, coalesce(s.v, 0) AS v, coalesce(c.n, 0) AS n FROM (SELECT DISTINCT lang, source FROM docs) g
    LEFT JOIN sizes s ON s.lang = g.lang LEFT JOIN (SELECT lang, source, sum(n) AS n FROM counts GROUP BY ALL) c ON c.lang = g.lang AND c.source = g.source),
shares AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS cnt,
    1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 2) // (g.n + 2 * g.v) AS p,
    1 + 1000000000::HUGEINT * (k.whole + 2) // (s.total + 2 * s.v) AS q
    FROM groups g JOIN kept k ON k.lang = g.lang JOIN sizes s ON s.lang = g.lang
    LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
sums AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
    FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
found AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
    UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM shares WHERE cnt > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INT AS rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""
