"""Quality rules with built-in functions only: base rules, then robust multivariate outliers.

A document's statistics are transformed to a short vector. Per language and source
the centre and covariance of that vector are estimated by the minimum-covariance-
determinant method, and a document whose Mahalanobis distance from its group is too
large is rejected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from llm.common import stored

SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5

# Transformed statistics, each with the least standard deviation it is given: in a group where almost all
# documents agree, smaller deviations are no sign of bad quality.
VECTOR = {"length": 0.75, "word_length": 0.08, "symbols": 0.06, "dup_lines": 0.15, "repeats": 0.12}
NAMES = list(VECTOR)
PAIRS = [(i, j) for i in range(len(NAMES)) for j in range(i + 1)]
# Share of a group that a concentration step keeps, the number of steps, and the smallest group with an estimate
# of its own; smaller ones of a language share one, and languages too small for that share one in turn.
KEPT_SHARE, STEPS, LEAST_ROWS = 0.75, 3, 200
# Chi-square quantiles for 5 dimensions: at KEPT_SHARE, at 0.975; and the consistency factors of covariances
# computed within them, which make them unbiased for normal data.
QUANTILE_KEPT, QUANTILE_REWEIGHT = 6.6257, 12.8325
FACTOR_KEPT, FACTOR_REWEIGHT = 1.4121, 1.0555
# Squared distance beyond which a document is rejected.
CUTOFF = 60.0


def word_array(text: Column) -> Column:
    """Runs of other characters than the six ASCII white space characters; none for an empty text."""
    trimmed = F.btrim(text, F.lit(SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words; text goes. A null text has no words."""
    keep = [c for c in docs.columns if c != text]
    step = docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("_text")).withColumn("_words", word_array(F.col("_text")))
    removed = lambda chars: F.length(F.translate("_text", chars, ""))
    step = step.select(
        *keep,
        "_words",
        F.size("_words").cast("long").alias("n_words"),
        removed(SPACE).cast("long").alias("word_chars"),
        (F.length("_text") - removed(SYMBOLS)).cast("long").alias("n_symbols"),
        F.filter(F.split("_text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("_lines"),
    )
    # Equal windows are found by the 64-bit hash of their words, within one document.
    at = lambda i, k: F.get(F.col("_words"), i + k)
    hashes = F.transform(
        F.sequence(F.lit(0), F.size("_words") - WINDOW), lambda i: F.xxhash64(*[at(i, k) for k in range(WINDOW)])
    )
    step = step.withColumn("_windows", F.when(F.size("_words") >= WINDOW, hashes))
    some = F.size(F.array_distinct("_windows")) < F.size("_windows")
    pairs = F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    step = step.withColumn("_sorted", F.when(some, pairs))
    h = lambda k: F.get(F.col("_sorted"), k).getField("h")
    twice = F.filter("_sorted", lambda x, k: x["h"].eqNullSafe(h(k - 1)) | x["h"].eqNullSafe(h(k + 1)))
    step = step.withColumn("_starts", F.sort_array(F.transform(twice, lambda x: x["i"])))
    # Starts ascend: each adds the words up to the next covered one, five at most.
    covered = F.aggregate(
        "_starts",
        F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n")),
        lambda acc, x: F.struct(x.alias("last"), (acc["n"] + F.least(F.lit(WINDOW), x - acc["last"])).alias("n")),
        lambda acc: acc["n"],
    )
    return step.select(
        *keep, "n_words", "word_chars", "n_symbols",
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
    )


def base_failed(words: Column, repeats: Column) -> Column:
    return (words < 10) | (100 * repeats > 20 * words)


def vector() -> list[Column]:
    """The transformed statistics, in the order of NAMES; all zero for a document without words."""
    share = lambda a, b: F.sqrt(F.col(a) / F.greatest(F.col(b), F.lit(1)))
    return [
        F.log1p("n_words").alias("length"),
        F.log1p(F.col("word_chars") / F.greatest("n_words", F.lit(1))).alias("word_length"),
        share("n_symbols", "word_chars").alias("symbols"),
        share("n_dup_lines", "n_lines").alias("dup_lines"),
        share("n_repeat_words", "n_words").alias("repeats"),
    ]


def _estimate(rows: DataFrame, factor: float, purpose: str) -> DataFrame:
    """Per group the mean and the Cholesky factor of its covariance, from sums that are added up map side."""
    sums = [F.count("*").alias("n"), *[F.avg(c).alias(f"m_{c}") for c in NAMES]]
    sums += [F.covar_pop(NAMES[i], NAMES[j]).alias(f"c{i}{j}") for i, j in PAIRS]
    found = rows.groupBy("g_lang", "g_source").agg(*sums)
    for i, j in PAIRS:  # row by row: what a step needs is there already
        c = F.col(f"c{i}{j}") * factor
        if i == j:
            c = F.greatest(c, F.lit(VECTOR[NAMES[i]] ** 2))
        for k in range(j):
            c = c - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
        least = F.lit((VECTOR[NAMES[i]] / 4) ** 2)
        found = found.withColumn(f"l{i}{j}", F.sqrt(F.greatest(c, least)) if i == j else c / F.col(f"l{j}{j}"))
    return stored(found.drop(*[f"c{i}{j}" for i, j in PAIRS]), purpose)


def _distances(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """Adds distance2, the squared Mahalanobis distance (null without an estimate)."""
    names = rows.columns
    seen = estimates.withColumnsRenamed({"g_lang": "e_lang", "g_source": "e_source"})
    same = F.col("g_lang").eqNullSafe(F.col("e_lang")) & F.col("g_source").eqNullSafe(F.col("e_source"))
    joined = rows.join(seen, same, "left")
    for i, name in enumerate(NAMES):
        y = F.col(name) - F.col(f"m_{name}")
        for k in range(i):
            y = y - F.col(f"l{i}{k}") * F.col(f"y{k}")
        joined = joined.withColumn(f"y{i}", y / F.col(f"l{i}{i}"))
    total = sum((F.col(f"y{i}") ** 2 for i in range(1, len(NAMES))), F.col("y0") ** 2)
    return joined.select(*names, total.alias("distance2"))


def _start(rows: DataFrame) -> DataFrame:
    """Median and deviation of each statistic alone, from bounded quantile sketches."""
    quantiles = [F.percentile_approx(c, [0.25, 0.5, 0.75], 1000).alias(c) for c in NAMES]
    found = rows.groupBy("g_lang", "g_source").agg(F.count("*").alias("n"), *quantiles)
    columns = [F.col(c)[1].alias(f"m_{c}") for c in NAMES]
    for i, j in PAIRS:
        spread = F.greatest((F.col(NAMES[i])[2] - F.col(NAMES[i])[0]) / 1.349, F.lit(VECTOR[NAMES[i]]))
        columns.append((spread if i == j else F.lit(0.0)).alias(f"l{i}{j}"))
    return stored(found.select("g_lang", "g_source", "n", *columns), "quality-start")


def robust_estimates(rows: DataFrame) -> DataFrame:
    """Concentration steps: keep the closest KEPT_SHARE of each group, estimate anew; then reweight once."""
    estimates = _start(rows)
    for _ in range(STEPS):
        near = _distances(rows, estimates)
        limits = near.groupBy("g_lang", "g_source").agg(F.percentile_approx("distance2", KEPT_SHARE, 1000).alias("limit"))
        limits = limits.withColumnsRenamed({"g_lang": "l_lang", "g_source": "l_source"})
        same = F.col("g_lang").eqNullSafe(F.col("l_lang")) & F.col("g_source").eqNullSafe(F.col("l_source"))
        estimates = _estimate(near.join(limits, same).where("distance2 <= limit"), FACTOR_KEPT, "quality-step")
    return _estimate(_distances(rows, estimates).where(F.col("distance2") <= QUANTILE_REWEIGHT), FACTOR_REWEIGHT, "quality-final")


def judge(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns in carry, language and source, then the statistics, base_failed, distance2 and kept, one row per row.

    A null text has no words and fails the base rule; so does an empty one. Null languages and sources are
    groups of their own. Repeated rows count as often as they occur. Groups of fewer than LEAST_ROWS passing
    documents pool with the other small ones of their language, then of all languages; where even these are
    too few there is no distance and base rules alone decide. Estimates use documents that pass the base rules.
    """
    keep = [*carry, lang, source]
    step = statistics(docs.select(*keep, text), text).withColumn("base_failed", base_failed(F.col("n_words"), F.col("n_repeat_words")))
    step = stored(step.select("*", *[v.alias(f"v_{n}") for n, v in zip(NAMES, vector(), strict=True)]), "quality-statistics")
    # Which estimate each (language, source) takes: its own, its language's small ones', or all small ones'.
    groups = step.groupBy(F.col(lang).alias("k_lang"), F.col(source).alias("k_source")).agg(F.count_if(~F.col("base_failed")).alias("own"))
    groups = groups.withColumn("few", F.sum(F.when(F.col("own") < LEAST_ROWS, F.col("own"))).over(Window.partitionBy("k_lang")))
    small = F.col("own") < LEAST_ROWS
    groups = groups.select(
        "k_lang",
        "k_source",
        F.when(small & (F.col("few") < LEAST_ROWS), F.lit(None)).otherwise(F.struct(F.col("k_lang").alias("v"))).alias("g_lang"),
        F.when(small, F.lit(None)).otherwise(F.struct(F.col("k_source").alias("v"))).alias("g_source"),
    )
    groups = stored(groups.select("k_lang", "k_source", F.to_json("g_lang").alias("g_lang"), F.to_json("g_source").alias("g_source")), "quality-groups")
    same = F.col(lang).eqNullSafe(F.col("k_lang")) & F.col(source).eqNullSafe(F.col("k_source"))
    grouped = step.join(groups, same).withColumnsRenamed({f"v_{n}": n for n in NAMES if n not in keep})
    fitted = grouped.where("not base_failed").select("g_lang", "g_source", *NAMES)
    estimates = robust_estimates(fitted)
    result = _distances(grouped, estimates.where(F.col("n") >= LEAST_ROWS // 2))
    inlier = F.coalesce(F.col("distance2") <= CUTOFF, F.lit(True))
    return result.select(
        *keep, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "distance2",
        (~F.col("base_failed") & inlier).alias("kept"),
    )
