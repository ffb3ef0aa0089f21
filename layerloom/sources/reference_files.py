"""Readers for reference data delivered as JSON documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _document(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.text(path, wholetext=True).select(F.from_json("value", schema).alias("d"))


def read_currency_codes(spark: SparkSession, path: str) -> DataFrame:
    """``{"EUR": "Euro", ...}`` as ``code, name``."""
    return _document(spark, path, "map<string, string>").select(F.explode("d").alias("code", "name"))


def read_exchange_rates(spark: SparkSession, path: str, rate_date: str) -> DataFrame:
    """``{"rates": {"USD": 1.1, ...}}`` as ``currency_code, rate_date, rate`` of one day."""
    rates = _document(spark, path, "struct<rates: map<string, decimal(18,6)>>")
    return rates.select(F.explode("d.rates").alias("currency_code", "rate")).select(
        "currency_code", F.lit(rate_date).cast("date").alias("rate_date"), "rate"
    )
