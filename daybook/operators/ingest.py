"""One pass over all outstanding dates: what to load, what to reject, and what to write down."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .calendar import classify_loaded, classify_missing
from .quality import judged_dates
from .store import Table

DETAIL_WIDTH = 4000


def coverage(bars: DataFrame) -> DataFrame:
    """For each trade date: bars, bars with a delivery figure, and whether any has one."""
    return bars.groupBy("trade_date").agg(F.count("*").alias("n_bars"), F.count("deliv_pct").alias("n_delivery"), F.bool_or(F.col("deliv_pct").isNotNull()).alias("any_delivery"))


def latest_bar(bars: DataFrame) -> DataFrame:
    return bars.agg(F.max("trade_date").alias("latest"), F.count("*").alias("n_bars"))


def load_status(expected: DataFrame, bars: DataFrame, today: Column, refused: DataFrame | None = None) -> DataFrame:
    """trade_date, status, rows_loaded of every expected date, in one scan of bars.

    Dates without bars are failed or no_data by their age; dates with an error among their findings are
    failed whole; others are loaded or partial. One bad date does not touch the others. refused: trade
    dates whose file landed and gave nothing; without bars from elsewhere they are failed at any age.
    """
    joined = expected.join(judged_dates(bars), "trade_date", "left")
    landed = F.lit(False)
    if refused is not None:
        joined = joined.join(refused.select("trade_date").distinct().withColumn("_landed", F.lit(True)), "trade_date", "left")
        landed = F.coalesce("_landed", F.lit(False))
    d, good = F.col("trade_date"), F.col("n_bars").isNotNull() & ~F.col("has_error")
    status = F.when(F.col("n_bars").isNull() & landed, "failed").when(F.col("n_bars").isNull(), classify_missing(d, today)).when(F.col("has_error"), "failed").otherwise(classify_loaded(F.col("n_delivery") > 0, d, today))
    return joined.select("trade_date", status.alias("status"), F.when(good, F.col("n_bars")).otherwise(0).cast("int").alias("rows_loaded"), (F.col("n_bars").isNull() & ~landed & (status == "failed")).alias("pending"))


def finding_rows(findings: DataFrame, run_id: Column) -> DataFrame:
    """Findings as they are appended to the stored table."""
    return findings.withColumns({"detail": F.left("detail", F.lit(DETAIL_WIDTH)), "run_id": run_id})


FINDINGS = "check_name string, severity string, detail string, symbol_id long, trade_date date, run_id long"
EVENTS = "run_id long, event_time timestamp, status string, commit_sha string, notes string"


def findings_table(spark: SparkSession, path: str) -> Table:
    return Table(spark, path, FINDINGS, "findings", "trade_date")


def events_table(spark: SparkSession, path: str) -> Table:
    return Table(spark, path, EVENTS, "runs")


def append_findings(findings: DataFrame, run_id: int, path: str, batch: str = "") -> None:
    """Appends a batch of a run's findings to the stored ones, if their severities are known; one that is there already is not appended again."""
    findings_table(findings.sparkSession, path).append(finding_rows(findings, F.lit(run_id).cast("long")), f"{run_id}/{batch}")


def record_event(spark: SparkSession, path: str, run_id: int, status: str, at: datetime, commit: str | None = None, notes: str = "") -> None:
    """Appends one event of a run: running, succeeded, halted or failed. A run has each of them once."""
    events_table(spark, path).append(spark.createDataFrame([(run_id, at, status, commit, notes[:DETAIL_WIDTH])], EVENTS), f"{run_id}/{status}")


def recorded_run(spark: SparkSession, path: str, run_id: int, work: Callable[[], DataFrame], clock: Callable[[], datetime], commit: str | None = None) -> str:
    """Runs work, which returns its findings, between an opening and a closing event; returns the closing status.

    An error among the findings closes the run as halted; what was written before stays. An exception
    closes it as failed and is raised again.
    """
    record_event(spark, path, run_id, "running", clock(), commit)
    try:
        status = "succeeded" if work().filter("severity = 'error'").isEmpty() else "halted"
    except Exception as error:
        record_event(spark, path, run_id, "failed", clock(), commit, str(error))
        raise
    record_event(spark, path, run_id, status, clock(), commit)
    return status


def run_state(events: DataFrame) -> DataFrame:
    """Current state of each run from its appended events (run_id, event_time, status, notes)."""
    last = F.max_by(F.struct("status", F.left("notes", F.lit(DETAIL_WIDTH)).alias("notes")), F.col("event_time"))
    return events.groupBy("run_id").agg(F.min("event_time").alias("started"), last.alias("last")).select("run_id", "started", "last.*")


def run_summary(status: DataFrame, findings: DataFrame, run_id: Column | None = None, **counted: DataFrame) -> DataFrame:
    """One row: date lists by outcome, counts of what was written and found, and the run's status (halted on any error).

    counted: the tables whose rows are counted, by the name of their counter, such as universe_symbols,
    adjusted_bars_written, corporate_actions_written and factors_written.
    """
    def dates(which: Column) -> Column:
        return F.sort_array(F.collect_set(F.when(which, F.col("trade_date"))))

    of = F.col("status")
    pending = F.col("pending") if "pending" in status.columns else F.lit(False)
    out = status.agg(
        dates(of.isin("loaded", "partial")).alias("dates_loaded"), dates(of == "no_data").alias("dates_no_data"), dates((of == "failed") & ~pending).alias("dates_failed"),
        dates(pending).alias("dates_pending"), dates(of == "partial").alias("dates_partial"), F.coalesce(F.sum("rows_loaded"), F.lit(0)).alias("bars_written"),
    )
    parts = [df.agg(F.count("*").alias(name)) for name, df in counted.items()]
    parts.append(findings.agg(F.count("*").alias("n_findings"), F.count_if(F.col("severity") == "error").alias("n_errors")))
    for part in parts:  # single rows
        out = out.join(part)
    return out.select((F.lit(None).cast("long") if run_id is None else run_id).alias("run_id"), "*", F.when(F.col("n_errors") > 0, "halted").otherwise("succeeded").alias("run_status"))


def summary_text(summary: DataFrame) -> DataFrame:
    parts = [F.concat(F.lit(f"{c}="), F.array_join(F.col(c).cast("array<string>"), ",") if c.startswith("dates") else F.col(c).cast("string")) for c in summary.columns]
    return summary.select(F.concat_ws("\n", *parts).alias("text"))
