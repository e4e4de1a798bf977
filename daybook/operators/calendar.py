"""Dates that should have data, and how far each has come."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

CATCHUP_DAYS, GRACE_DAYS, CANDLE_DAYS = 10, 3, 1800
SETTLED = ("loaded", "no_data")


def weekday(c: Column) -> Column:
    """Monday to Friday."""
    return F.weekday(c) < 5


def days(first: Column, last: Column) -> Column:
    """All dates from first to last; none if last is before first."""
    return F.when(last >= first, F.sequence(first, last)).otherwise(F.array().cast("array<date>"))


def candidate_dates(spark: SparkSession, start: date, end: date) -> DataFrame:
    """trade_date: weekdays from start to end, both included, oldest first; none if inverted."""
    all_days = spark.range(1).select(F.explode(days(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("trade_date"))
    return all_days.filter(weekday(F.col("trade_date"))).orderBy("trade_date")


def expected_dates(spark: SparkSession, today: date, n: int) -> DataFrame:
    """trade_date: weekdays among the n days before today, newest first."""
    at = F.lit(today).cast("date")
    all_days = spark.range(1).select(F.explode(days(F.date_sub(at, n), F.date_sub(at, 1))).alias("trade_date"))
    return all_days.filter(weekday(F.col("trade_date"))).orderBy(F.desc("trade_date"))


def split_window(df: DataFrame, start: str, end: str, max_days: int = CANDLE_DAYS) -> DataFrame:
    """One row for each chunk of [start, end]: chunk_start, chunk_end, contiguous, of max_days + 1 days at most."""
    step = F.expr(f"interval {max_days + 1} day")
    starts = F.when(F.col(end) >= F.col(start), F.sequence(F.col(start), F.col(end), step)).otherwise(F.array().cast("array<date>"))
    return df.withColumn("chunk_start", F.explode(starts)).withColumn("chunk_end", F.least(F.date_add("chunk_start", max_days), F.col(end)))


def settled_dates(log: DataFrame, source: str) -> DataFrame:
    return log.filter((F.col("source") == source) & F.col("status").isin(*SETTLED)).select(F.col("data_date").alias("trade_date")).distinct()


def outstanding(expected: DataFrame, log: DataFrame, source: str) -> DataFrame:
    """Expected dates that have not settled; failed and partial dates are tried again."""
    return expected.join(settled_dates(log, source), "trade_date", "left_anti").orderBy("trade_date")


def outstanding_dates(spark: SparkSession, log: DataFrame, source: str, today: date, catchup: int = CATCHUP_DAYS, include_today: bool = True) -> DataFrame:
    at = F.lit(today).cast("date")
    window = spark.range(1).select(F.explode(days(F.date_sub(at, catchup), F.date_sub(at, 0 if include_today else 1))).alias("trade_date"))
    return outstanding(window.filter(weekday(F.col("trade_date"))), log, source)


def backfill_worklist(spark: SparkSession, log: DataFrame, source: str, start: date, end: date, limit: int = 0) -> DataFrame:
    """Unsettled weekdays of a range, newest first; limit 0: all."""
    todo = outstanding(candidate_dates(spark, start, end), log, source).orderBy(F.desc("trade_date"))
    return todo.limit(limit) if limit else todo


def classify_missing(trade_date: Column, today: Column, grace: int = GRACE_DAYS) -> Column:
    """No file: within the grace period it may still come (failed), later it was no trading day (no_data)."""
    return F.when(F.date_diff(today, trade_date) <= grace, "failed").otherwise("no_data")


def classify_loaded(any_delivery: Column, trade_date: Column, today: Column, grace: int = GRACE_DAYS) -> Column:
    """Bars without any delivery figure are partial within the grace period, else taken as they are."""
    return F.when(any_delivery, "loaded").when(F.date_diff(today, trade_date) <= grace, "partial").otherwise("loaded")


def last_loaded(log: DataFrame, source: str) -> DataFrame:
    return log.filter((F.col("source") == source) & (F.col("status") == "loaded")).agg(F.max("data_date").alias("last_loaded"))
