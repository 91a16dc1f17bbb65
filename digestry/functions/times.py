"""Dates, ages and query windows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BUSINESS_ZONE = "Asia/Shanghai"
AGE_BUCKETS = (7, 30, 365)


def business_date(ts: Column) -> Column:
    return F.to_date(F.from_utc_timestamp(ts, BUSINESS_ZONE))


def age_days(ts: Column, now: Column) -> Column:
    """Age in days, never negative."""
    return F.greatest(F.lit(0.0), (F.unix_micros(now) - F.unix_micros(ts)) / F.lit(86_400_000_000.0))


def age_buckets(ts: Column, now: Column) -> Column:
    """Cumulative buckets: what is a week old is also a month and a year old."""
    age = age_days(ts, now)
    return F.array_compact(F.array(*[F.when(age <= days, F.lit(f"{days}d")) for days in AGE_BUCKETS]))


def window_lower(kind: Column, now: Column, last_success: Column) -> Column:
    """First moment of interest: years back on a cold start, a short overlap afterwards."""
    years = F.when(kind == "paper", F.lit(5)).otherwise(F.lit(3))
    hours = F.when(kind == "paper", F.lit(48)).otherwise(F.lit(7 * 24))
    cold = now - F.make_interval(years=years)
    warm = last_success - F.make_interval(hours=hours)
    return F.when(last_success.isNull(), cold).otherwise(warm)


def iso_utc(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")
