"""Data quality checks over the text of a whole extract."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# --- fixed values: issue kinds, severities and limits ------------------------
MAX_LENGTH = 100_000
SAMPLE_LENGTH = 100
DELIMITERS = (";", "|", "\t")
SEVERITY = {
    "unescaped_quotes": "warning",
    "control_characters": "warning",
    "encoding_error": "error",
    "excessive_length": "warning",
    "delimiter_in_data": "info",
}
# --- end of fixed values -----------------------------------------------------

RANKING_PARTS = 256

def cells(df: DataFrame, row_number: Column, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per non-NULL cell: ``row_number, col_pos, column_name, value``.

    The number of expressions does not grow with the table's width.
    """
    names = list(columns or df.columns)
    text = df.select(row_number.cast("bigint").alias("row_number"), *[F.col(f"`{c}`").cast("string") for c in names])
    tall = text.unpivot(["row_number"], [f"`{c}`" for c in names], "column_name", "value")
    position = F.array_position(F.array(*[F.lit(c) for c in names]), F.col("column_name"))
    return tall.filter(F.col("value").isNotNull()).withColumn("col_pos", position.cast("int"))


def _short(value: Column) -> Column:
    return F.left(value, F.lit(SAMPLE_LENGTH))


def _escaped(value: Column) -> Column:
    """Control characters written as escapes, between quotes."""
    text = _short(value)
    for raw, shown in (("\\", "\\\\"), ("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r")):
        text = F.replace(text, F.lit(raw), F.lit(shown))
    return F.concat(F.lit("'"), text, F.lit("'"))


def _row_checks(value: Column) -> dict[str, tuple[Column, Column]]:
    """Issue kind -> (condition, sample)."""
    long_mark = F.when(F.length(value) > SAMPLE_LENGTH, F.lit("...")).otherwise("")
    total = F.concat(F.lit("... (total: "), F.length(value).cast("string"), F.lit(" chars)"))
    return {
        "unescaped_quotes": (value.contains('"'), F.concat(_short(value), long_mark)),
        "control_characters": (value.rlike(r"[\t\n\r]"), _escaped(value)),
        "encoding_error": (~F.is_valid_utf8(value), _escaped(F.make_valid_utf8(value))),
        "excessive_length": (F.length(value) > MAX_LENGTH, F.concat(_short(value), total)),
    }


def cell_issues(tall: DataFrame) -> DataFrame:
    """Every per-cell issue, uncapped."""
    found = F.array(
        *[
            F.when(hit, F.struct(F.lit(kind).alias("issue_type"), sample.alias("value_sample")))
            for kind, (hit, sample) in _row_checks(F.col("value")).items()
        ]
    )
    exploded = tall.select("row_number", "col_pos", "column_name", F.explode(F.array_compact(found)).alias("i"))
    return exploded.select("row_number", "col_pos", "column_name", "i.issue_type", "i.value_sample")


# -- one pass over a wide table -------------------------------------------------------

SUSPECT = '["' + "".join(re.escape(d) for d in ("\t", "\n", "\r", *DELIMITERS[:2])) + "]"


def findings(df: DataFrame, row_number: Column, columns: Sequence[str] | None = None, file: Column | None = None) -> DataFrame:
    """Rows with something to report: ``file_name, row_number``, their ``issues`` and their ``delimited`` cells.

    One projection over the wide row; no row per cell. Store the result once:
    :func:`issues_of`, :func:`summary_of` and the report all read it.
    """
    names = list(columns or df.columns)
    cells_of_row = F.array(
        *[
            F.struct(F.lit(i).alias("col_pos"), F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("value"))
            for i, c in enumerate(names, 1)
        ]
    )
    text = df.select(
        (F.lit(None).cast("string") if file is None else file).alias("file_name"),
        row_number.cast("bigint").alias("row_number"),
        cells_of_row.alias("cells"),
    )
    suspect = text.select(
        "file_name",
        "row_number",
        F.filter(
            "cells",
            lambda c: c["value"].rlike(SUSPECT) | ~F.is_valid_utf8(c["value"]) | (F.length(c["value"]) > MAX_LENGTH),
        ).alias("cells"),
    ).filter(F.size("cells") > 0)

    def found(c: Column) -> Column:
        at = [c["col_pos"].alias("col_pos"), c["column_name"].alias("column_name")]
        checks = _row_checks(c["value"]).items()
        return F.array_compact(
            F.array(*[F.when(hit, F.struct(*at, F.lit(kind).alias("issue_type"), sample.alias("value_sample"))) for kind, (hit, sample) in checks])
        )

    def delimited(c: Column) -> Column:
        at = [c["col_pos"].alias("col_pos"), c["column_name"].alias("column_name")]
        return F.array_compact(F.array(*[F.when(c["value"].contains(d), F.struct(*at, F.lit(d).alias("delimiter"))) for d in DELIMITERS]))

    return suspect.select(
        "file_name",
        "row_number",
        F.flatten(F.transform("cells", found)).alias("issues"),
        F.flatten(F.transform("cells", delimited)).alias("delimited"),
    ).filter((F.size("issues") > 0) | (F.size("delimited") > 0))


def _listed(found: DataFrame) -> DataFrame:
    return found.select("file_name", "row_number", F.inline("issues"))


def _delimiters(found: DataFrame) -> DataFrame:
    return found.select(F.inline("delimited")).groupBy("col_pos", "column_name", "delimiter").agg(F.count(F.lit(1)).alias("row_count"))


def issues_of(found: DataFrame, table_name: str) -> DataFrame:
    """All issues of stored :func:`findings`, each with its file; those of a whole column have none."""
    general = _delimiters(found).select(
        F.lit(None).cast("string").alias("file_name"),
        F.lit(0).cast("bigint").alias("row_number"),
        "col_pos",
        "column_name",
        F.lit("delimiter_in_data").alias("issue_type"),
        _rows_contain().alias("value_sample"),
    )
    return _described(_listed(found).unionByName(general)).select(F.lit(table_name).alias("table_name"), "*")


def summary_of(found: DataFrame) -> DataFrame:
    """Issue counts per kind and severity of stored :func:`findings`."""
    kinds = _listed(found).groupBy("issue_type").agg(F.count(F.lit(1)).alias("issue_count"))
    general = _delimiters(found).groupBy().agg(F.lit("delimiter_in_data").alias("issue_type"), F.count(F.lit(1)).alias("issue_count"))
    both = kinds.unionByName(general.filter(F.col("issue_count") > 0))
    return _described(both).select("issue_type", "severity", "issue_count")


def _rows_contain() -> Column:
    return F.concat(F.col("row_count").cast("string"), F.lit(" rows contain '"), F.col("delimiter"), F.lit("'"))


def delimiter_counts(tall: DataFrame) -> DataFrame:
    """Rows per column that contain each delimiter (only those that occur)."""
    counted = tall.groupBy("col_pos", "column_name").agg(
        *[F.count_if(F.col("value").contains(d)).alias(f"n{i}") for i, d in enumerate(DELIMITERS)]
    )
    pairs = F.array(*[F.struct(F.lit(d).alias("delimiter"), F.col(f"n{i}").alias("n")) for i, d in enumerate(DELIMITERS)])
    return (
        counted.select("col_pos", "column_name", F.explode(pairs).alias("p"))
        .select("col_pos", "column_name", "p.delimiter", F.col("p.n").alias("row_count"))
        .filter(F.col("row_count") > 0)
    )


def _described(issues: DataFrame) -> DataFrame:
    def by_kind(texts: dict[str, str]) -> Column:
        chain = F.lit(None).cast("string")
        for kind, text in texts.items():
            chain = F.when(F.col("issue_type") == kind, F.lit(text)).otherwise(chain)
        return chain

    return issues.select("*", by_kind(SEVERITY).alias("severity"))


def _first(found: DataFrame, groups: Sequence[str], n: int) -> DataFrame:
    order = Window.partitionBy(*groups).orderBy("col_pos", "row_number")
    return found.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= n).drop("_n")


def issues(tall: DataFrame, table_name: str, per_type: int | None = None) -> DataFrame:
    """The issue report: all issues, or a short list of the first ``per_type`` of each kind, column by column.

    A short list is ranked within salted parts of a kind first: of the many
    issues of one kind, the task that ranks the kind sees ``per_type`` rows per part.
    """
    listed = cell_issues(tall)
    if per_type is not None:
        salted = listed.withColumn("_part", F.pmod(F.xxhash64("col_pos", "row_number"), F.lit(RANKING_PARTS)))
        listed = _first(_first(salted, ["issue_type", "_part"], per_type).drop("_part"), ["issue_type"], per_type)
    general = delimiter_counts(tall).select(
        F.lit(0).cast("bigint").alias("row_number"),
        "col_pos",
        "column_name",
        F.lit("delimiter_in_data").alias("issue_type"),
        _rows_contain().alias("value_sample"),
    )
    return _described(listed.unionByName(general)).select(F.lit(table_name).alias("table_name"), "*")


def summary(tall: DataFrame) -> DataFrame:
    """Issue counts per kind and severity over the whole input."""
    found = cell_issues(tall).groupBy("issue_type").agg(F.count(F.lit(1)).alias("issue_count"))
    general = delimiter_counts(tall).groupBy().agg(
        F.lit("delimiter_in_data").alias("issue_type"), F.count(F.lit(1)).alias("issue_count")
    )
    both = found.unionByName(general.filter(F.col("issue_count") > 0))
    return _described(both).select("issue_type", "severity", "issue_count")


def report(counts: DataFrame, table_name: str) -> DataFrame:
    """One row per table: totals by severity; it passes without errors."""

    def of(severity: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("severity") == severity, F.col("issue_count"))), F.lit(0)).cast("bigint")

    return counts.agg(
        F.coalesce(F.sum("issue_count"), F.lit(0)).cast("bigint").alias("issue_count"),
        of("error").alias("error_count"),
        of("warning").alias("warning_count"),
        (of("error") == 0).alias("passed"),
    ).select(F.lit(table_name).alias("table_name"), "*")
