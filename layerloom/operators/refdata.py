"""Reference tables: calendar, currency codes, exchange rates."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerloom.operators.keyed import latest_per_key, moment, upsert

# --- fixed values -------------------------------------------------------------
FIRST_YEAR = 2015
LAST_YEAR = 2035
BASE_CURRENCY = "EUR"
RATE_TYPE = "decimal(18,6)"
# --- end of fixed values -----------------------------------------------------


def year_bounds(start_year: Column | int = FIRST_YEAR, end_year: Column | int = LAST_YEAR) -> list[Column]:
    """First and last day of a span of years, named for :func:`calendar`."""

    def year(value: Column | int) -> Column:
        return F.lit(value) if isinstance(value, int) else value

    return [
        F.make_date(year(start_year), F.lit(1), F.lit(1)).alias("first_day"),
        F.make_date(year(end_year), F.lit(12), F.lit(31)).alias("last_day"),
    ]


def calendar(bounds: DataFrame) -> DataFrame:
    """One row per day from ``first_day`` to ``last_day`` of a one-row frame."""
    days = bounds.select(F.explode(F.sequence("first_day", "last_day")).alias("date_key"))
    day = F.col("date_key")
    iso_weekday = F.weekday(day) + 1
    return days.select(
        day,
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        iso_weekday.alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.weekofyear(day).alias("week_of_year"),
        (iso_weekday >= 6).alias("is_weekend"),
    )


def currency_codes(codes: DataFrame, run_ts: datetime | str) -> DataFrame:
    """The code list as a full refresh: ``code, name`` in, one row per code out, both uncut."""
    named = codes.select("code", "name")
    # distinct() is a hash aggregate, so the max over text only sorts what is left
    return named.distinct().groupBy("code").agg(F.max("name").alias("name")).withColumn("updated_at", moment(run_ts))


RATE_KEYS = ("currency_code", "rate_date")


def rate_rows(rates: DataFrame, run_ts: datetime | str) -> DataFrame:
    """``currency_code, rate_date, rate`` in the rate table's layout."""
    return rates.select(
        "currency_code",
        F.col("rate").cast(RATE_TYPE).alias("rate"),
        F.lit(BASE_CURRENCY).alias("base_currency"),
        "rate_date",
        moment(run_ts).alias("updated_at"),
    )


def upsert_rates(stored: DataFrame, rates: DataFrame, run_ts: datetime | str) -> DataFrame:
    """Stored rates with the given ones added or replaced."""
    fresh = latest_per_key(rate_rows(rates, run_ts), RATE_KEYS, [F.desc("rate")])
    return upsert(stored, fresh, RATE_KEYS, ("rate", "updated_at"))
