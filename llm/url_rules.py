"""URL verdicts: explicit host/path rules first, mined association rules for the rest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.common import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLOCKED, ALLOWED = "=block", "=allow"

Rule = tuple[str, str, str]  # verdict, host, path


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), "^[^/?#]*", 0), UPPER, LOWER)


def path(url: Column) -> Column:
    return F.regexp_extract(F.regexp_replace(_rest(url), "^[^/?#]*", ""), "^[^?#]*", 0)


def fitting_rule(rules: Sequence[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule for the host or a parent domain and a prefix of the path, or nulls."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        text, verdict = F.when(fits, h + p).otherwise(text), F.when(fits, kind).otherwise(verdict)
    return text, verdict


def tokens(url: Column) -> Column:
    """Distinct host labels, path segments and query names, digits as one sign: what rules combine."""
    query = F.regexp_extract(_rest(url), r"^[^?#]*\?([^#]*)", 1)
    digits = lambda x: F.regexp_replace(x, "[0-9]+", "0")
    parts = [
        F.transform(F.split(host(url), r"\."), lambda x: F.concat(F.lit("h:"), digits(x))),
        F.transform(F.split(path(url), "/"), lambda x: F.concat(F.lit("p:"), digits(x))),
        F.transform(F.split(query, "&"), lambda x: F.concat(F.lit("q:"), digits(F.regexp_extract(x, "^[^=]*", 0)))),
    ]
    return F.array_distinct(F.filter(F.concat(*parts), lambda x: F.length(x) > 2))


def mine(labelled: DataFrame, support: float, confidence: float) -> DataFrame:
    """(rule_id, tokens, verdict, confidence, support) from (tokens, verdict) rows, by FP-growth.

    Kept are rules token combination => verdict at or above both thresholds whose every smaller
    combination with that verdict is less sure. Their number is bounded by the support threshold.
    """
    items = labelled.select(F.concat("tokens", F.array(F.concat(F.lit("="), "verdict"))).alias("items"))
    if items.isEmpty():
        return items.sparkSession.createDataFrame([], "rule_id long, tokens array<string>, verdict string, confidence double, support double")
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence).fit(items)
    verdict = F.col("consequent")[0]
    rules = model.associationRules.where(verdict.isin(BLOCKED, ALLOWED)).select(
        F.array_sort("antecedent").alias("tokens"), F.substring(verdict, 2, 9).alias("verdict"), "confidence", "support"
    )
    rules = stored(rules, "url-rules")
    # A rule is redundant if a proper part of it is at least as sure: look parts up, don't compare all with all.
    parts = rules.withColumn("drop", F.explode("tokens")).select(
        "tokens", "verdict", "confidence", F.array_sort(F.array_except("tokens", F.array("drop"))).alias("part")
    )
    known = rules.select(F.col("tokens").alias("part"), "verdict", F.col("confidence").alias("sure"))
    weaker = parts.join(known, ["part", "verdict"]).where("sure >= confidence").select("tokens", "verdict").distinct()
    return rules.join(weaker, ["tokens", "verdict"], "left_anti").withColumn("rule_id", F.xxhash64("tokens", "verdict"))


def apply_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(url, verdict) for the distinct urls (url, tokens) that a mined rule matches; the surest, best supported one decides.

    Inverted index: a rule is listed under its rarest token only, and a url that has that token is
    checked for the rest, so common tokens such as a top-level domain lead to few rules.
    """
    spread = rules.select("rule_id", F.explode("tokens").alias("token"), "support")
    rarity = spread.groupBy("token").agg(F.max("support").alias("share"))
    listed = spread.join(rarity, "token").groupBy("rule_id").agg(F.min(F.struct("share", "token")).alias("least"))
    index = rules.join(listed, "rule_id").select(
        F.col("least.token").alias("token"), F.col("tokens").alias("wanted"), "verdict", "confidence", "support"
    )
    found = urls.select("url", "tokens", F.explode("tokens").alias("token")).join(index, "token")
    found = found.where(F.size(F.array_except("wanted", "tokens")) == 0)
    # Of equally good rules, blocking wins.
    best = F.max(F.struct("confidence", "support", "verdict")).alias("best")
    return found.groupBy("url").agg(best).select("url", F.col("best.verdict").alias("mined"))


def judge(
    pages: DataFrame, labels: DataFrame, rules: Sequence[Rule], support: float = 0.002, confidence: float = 0.9,
    page_id: str = "page_id", url: str = "url",
) -> DataFrame:
    """page_id, host, path, rule, verdict for every page.

    Labelled pages are those an explicit rule fits and those whose id is in labels (doc_id, quality,
    toxic): block if toxic or of no quality. Mining counts all of them. Pages that nothing fits are
    allowed. A null url, or one without ://, has empty host and path and no tokens. Null ids get
    their verdict too; repeated rows come out as often as they came in.
    """
    found = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"))
    found = found.withColumns({"host": F.coalesce(host(F.col("url")), F.lit("")), "path": F.coalesce(path(F.col("url")), F.lit(""))})
    rule, verdict = fitting_rule(rules, F.col("host"), F.col("path"))
    found = found.withColumns({"rule": rule, "ruled": verdict})
    bad = F.coalesce(F.max((F.col("toxic") == 1) | (F.col("quality") == 0)), F.lit(False))
    known = labels.groupBy(F.col("doc_id").alias("page_id")).agg(F.when(bad, "block").otherwise("allow").alias("label"))
    labelled = found.join(known, "page_id", "left").withColumn("verdict", F.coalesce("ruled", "label")).where("verdict is not null")
    mined = mine(labelled.select(F.coalesce(tokens(F.col("url")), F.array()).alias("tokens"), "verdict"), support, confidence)
    urls = found.where("rule is null and url is not null").select("url").distinct().withColumn("tokens", tokens(F.col("url")))
    verdicts = apply_rules(urls, mined)
    return found.join(verdicts, "url", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", "mined", F.lit("allow")).alias("verdict")
    )
