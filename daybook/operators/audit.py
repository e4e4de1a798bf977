"""Fingerprints, freshness, sizes and comparisons of stored tables."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .calendar import expected_dates

OK = ("loaded", "partial", "no_data")


def fingerprint(df: DataFrame, name: str, values: list[str], low: str) -> DataFrame:
    """One row: table_name, n, lo, hi (of the column low) and a digest that no order of rows changes.

    The digest is the sum of row hashes as a 38-digit decimal, which 64-bit sums would overflow.
    """
    digest = F.coalesce(F.sum(F.xxhash64(*values).cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"))
    return df.agg(F.lit(name).alias("table_name"), F.count("*").alias("n"), F.min(low).cast("string").alias("lo"), F.max(low).cast("string").alias("hi"), digest.alias("digest"))


def compare_fingerprints(before: DataFrame, after: DataFrame) -> DataFrame:
    """table_name, verdict: identical, changed, new and empty, new with rows, or gone."""
    b, a = before.alias("b"), after.alias("a")
    same = F.lit(True)
    for c in ("n", "lo", "hi", "digest"):
        same = same & F.col(f"b.{c}").eqNullSafe(F.col(f"a.{c}"))
    verdict = F.when(F.col("a.table_name").isNull(), "gone").when(F.col("b.table_name").isNull(), F.when(F.col("a.n") == 0, "new, empty").otherwise("new, not empty")).when(same, "identical").otherwise("changed")
    return b.join(a, F.col("b.table_name") == F.col("a.table_name"), "full_outer").select(F.coalesce("b.table_name", "a.table_name").alias("table_name"), verdict.alias("verdict"))


def protected(comparison: DataFrame) -> DataFrame:
    """One row: is what was there untouched, and what is new empty?"""
    return comparison.agg(F.coalesce(F.bool_and(F.col("verdict").isin("identical", "new, empty")), F.lit(True)).alias("untouched"))


def assess(dates: DataFrame, log: DataFrame, manifest: DataFrame, source: str) -> DataFrame:
    """trade_date, status, verdict of expected dates. manifest: trade_date, published (null: unknown)."""
    own = log.filter(F.col("source") == source).select(F.col("data_date").alias("trade_date"), "status")
    joined = dates.join(own, "trade_date", "left").join(manifest, "trade_date", "left")
    verdict = F.when(F.col("status").isin(*OK), "ok").when(F.col("published").isNull(), "UNVERIFIED").when(F.col("published"), "STALE").otherwise("ok")
    return joined.select("trade_date", "status", verdict.alias("verdict"))


def freshness(spark: SparkSession, log: DataFrame, manifest: DataFrame, source: str, today: date, n: int) -> DataFrame:
    """The n days before today. Only those days of log and manifest are read."""
    first = F.date_sub(F.lit(today).cast("date"), n)
    return assess(expected_dates(spark, today, n), log.filter(F.col("data_date") >= first), manifest.filter(F.col("trade_date") >= first), source)


def overall(assessed: DataFrame) -> DataFrame:
    """One row: exit_code 7 if anything is stale, else 8 if anything is unverified, else 0."""
    return assessed.agg(F.when(F.count_if(F.col("verdict") == "STALE") > 0, 7).when(F.count_if(F.col("verdict") == "UNVERIFIED") > 0, 8).otherwise(0).alias("exit_code"))


def table_counts(spark: SparkSession, names: list[str]) -> DataFrame:
    """table_name, n of the catalog's tables and the parquet paths (with a slash) among names, in one plan; absent ones are skipped."""
    known = {t.name for t in spark.catalog.listTables()}
    context = spark.sparkContext

    def there(path: str) -> bool:
        place = context._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(context._jsc.hadoopConfiguration()).exists(place)

    found = {n: spark.read.parquet(n) if "/" in n else spark.table(n) for n in names if (there(n) if "/" in n else n in known or "." in n and spark.catalog.tableExists(n))}
    counts = [df.agg(F.lit(name).alias("table_name"), F.count("*").alias("n")) for name, df in found.items()]
    return reduce(DataFrame.unionByName, counts, spark.createDataFrame([], "table_name string, n long"))


def footprint(files: DataFrame, allowance: Column, warn_below: float = 0.1) -> DataFrame:
    """One row for listed files (path, size, as landing.manifest gives them), or for the files that a table scans: bytes, share of the allowance, and ok, warning or stop. No file is opened."""
    if not {"path", "size"} <= set(files.columns):
        names = files.inputFiles()
        files = files.sparkSession.read.format("binaryFile").load(names).select("path", F.col("length").alias("size")) if names else files.sparkSession.createDataFrame([], "path string, size long")
    used = files.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"))
    share = F.round(100.0 * F.col("bytes") / allowance, 2)
    left = 1 - F.col("bytes") / allowance
    return used.select("bytes", share.alias("used_pct"), F.when(left <= 0, "stop").when(left < warn_below, "warning").otherwise("ok").alias("verdict"))


def run_counts(runs: DataFrame) -> DataFrame:
    """Job runs for each trade date: total, active, succeeded, failed."""
    done = F.col("status") == "completed"
    good = done & (F.col("conclusion") == "success")
    return runs.groupBy("trade_date").agg(F.count("*").alias("total"), F.count_if(~done).alias("active"), F.count_if(good).alias("succeeded"), F.count_if(done & ~F.coalesce(good, F.lit(False))).alias("failed"))
