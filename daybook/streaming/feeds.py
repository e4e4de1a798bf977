"""Streams over landed files. Each one ends when all files that are there have been read."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.calendar import SETTLED
from ..operators.ingest import load_status
from ..operators.upsert import LOG, applied_in_order, months_of, stored_months, upsert_months
from ..sources.landing import lines_of_text


def landed(spark: SparkSession, path: str, schema: StructType, files_a_batch: int = 100) -> DataFrame:
    """A stream of parquet files; with a checkpoint each file is read once, also across runs."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_batch).parquet(path)


def landed_files(spark: SparkSession, path: str, files_a_batch: int = 100) -> DataFrame:
    """A stream of files of any kind as path and content, for the readers of sources.landing; each file is read once."""
    kind = "path string, modificationTime timestamp, length long, content binary"
    return spark.readStream.schema(kind).format("binaryFile").option("maxFilesPerTrigger", files_a_batch).option("recursiveFileLookup", "true").load(path).select("path", "content")


def landed_lines(spark: SparkSession, path: str, files_a_batch: int = 100) -> DataFrame:
    """A stream of files as path, at, line, for the readers of sources.landing in each batch: a file of any size is spread over tasks, and each file is in one batch."""
    text = spark.readStream.format("text").option("lineSep", "\n").option("maxFilesPerTrigger", files_a_batch).option("recursiveFileLookup", "true").load(path)
    return lines_of_text(text)


def run_available(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None]) -> StreamingQuery:
    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def upsert_stream(spark: SparkSession, stream: DataFrame, path: str, schema: StructType, checkpoint: str, keys: Sequence[str], rules: Mapping[str, str], order: Sequence[str], month_of: str = "trade_date", table: str | None = None) -> StreamingQuery:
    """Micro-batch upsert into a table stored by month: the rows of a batch take effect in `order`.

    Late delivery figures fill what an earlier row left null; prices of later rows win. A batch reads and
    replaces the months it touches; a batch that is replayed changes nothing more. A row that breaks a
    constraint of `table` stops the stream before its batch has replaced anything.
    """
    def each(rows: DataFrame, batch: int) -> None:
        upsert_months(spark, path, schema, applied_in_order(rows, keys, rules, *order), keys, rules, month_of, table, months_of(rows, month_of))

    return run_available(stream, checkpoint, each)


LOG_SCHEMA = "source string, data_date date, status string, rows_loaded int"


def settle_dates(spark: SparkSession, path: str, schema: StructType, log_path: str, today: Column, source: str, touched: DataFrame | None = None, still_open: bool = True) -> None:
    """Judges the dates that the log has open, and those that were touched, by the bars stored for them; as load_status would, all at once.

    still_open: False leaves out open dates that were not touched, as their bars and the day are the same. Open are failed and partial dates, some days as a rule. Bars and log are stored by month; only months of
    such dates are read. Doing it again on the same day changes nothing.
    """
    log_keys, log_rules = LOG
    log_schema = spark.createDataFrame([], LOG_SCHEMA).schema
    parts = [] if touched is None else [touched.select("trade_date")]
    if still_open:
        log = stored_months(spark, log_path, log_schema, None)
        parts.append(log.filter((F.col("source") == source) & ~F.col("status").isin(*SETTLED)).select(F.col("data_date").alias("trade_date")))
    if not parts:
        return
    dates = reduce(DataFrame.union, parts).distinct()
    days = [r["trade_date"] for r in dates.dropna().collect()]  # the days of a batch and the open ones
    if not days:
        return
    expected = spark.createDataFrame([(d,) for d in days], "trade_date date")
    months = sorted({f"{d:%Y-%m}" for d in days})
    bars = stored_months(spark, path, schema, months).join(F.broadcast(expected), "trade_date", "left_semi")
    status = load_status(expected, bars, today)
    outcome = status.select(F.lit(source).alias("source"), F.col("trade_date").alias("data_date"), "status", "rows_loaded")
    upsert_months(spark, log_path, log_schema, outcome, log_keys, {c: r for c, r in log_rules.items() if c in outcome.columns}, "data_date", "log", months)


def enrich_stream(spark: SparkSession, stream: DataFrame, path: str, schema: StructType, log_path: str, checkpoint: str, keys: Sequence[str], rules: Mapping[str, str], order: Sequence[str], today: Column, source: str) -> StreamingQuery:
    """upsert_stream, and after each batch the status of the trade dates it touched; after the first one also of those that are open.

    The log, a table by month of source, data_date, status and rows_loaded, says of each date what
    load_status says of the bars stored so far. settle_dates brings it up to a later day without new files.
    """
    settled: list[int] = []  # batches of this run

    def each(rows: DataFrame, batch: int) -> None:
        upsert_months(spark, path, schema, applied_in_order(rows, keys, rules, *order), keys, rules, "trade_date", None, months_of(rows, "trade_date"))
        settle_dates(spark, path, schema, log_path, today, source, rows.select("trade_date").distinct(), not settled)
        settled.append(batch)

    return run_available(stream, checkpoint, each)


def enrich_available(spark: SparkSession, stream: DataFrame, path: str, schema: StructType, log_path: str, checkpoint: str, keys: Sequence[str], rules: Mapping[str, str], order: Sequence[str], today: Column, source: str) -> None:
    """One run: takes the files that have landed, and settles open dates even if there are none. The first batch has settled them, if there was one, and each batch its own."""
    run = enrich_stream(spark, stream, path, schema, log_path, checkpoint, keys, rules, order, today, source)
    run.awaitTermination()
    if not any(p.numInputRows for p in run.recentProgress):
        settle_dates(spark, path, schema, log_path, today, source)


def without_repeats(stream: DataFrame, keys: Sequence[str], time: str, lateness: str = "3 days") -> DataFrame:
    """Drops exact repeats that arrive within the lateness; revisions of a key go through upsert_stream."""
    return stream.withWatermark(time, lateness).dropDuplicatesWithinWatermark(list(keys))


def daily_rollup(stream: DataFrame, time: str, lateness: str = "3 days") -> DataFrame:
    """Rows and rows with a value for each day, final once the watermark has passed it."""
    day = F.window(time, "1 day")
    return stream.withWatermark(time, lateness).groupBy(day.alias("day")).agg(F.count("*").alias("n_rows"), F.count("value").alias("n_values")).select(F.to_date("day.start").alias("trade_date"), "n_rows", "n_values")
