"""The daily run: from what has landed to what is stored, for all outstanding dates at once.

The order of its steps is the one that loses least: the universe first, for a day's listing cannot be had
later; then the bars of every outstanding date, each judged for itself; then corporate actions, adjusted
bars, and the factors of the dates that were loaded. A date that is broken, rejected or absent does not
touch the others. Whatever happens the run is closed; an error among its findings closes it as halted.

Every step may be done again: tables are upserted by key, findings are appended once a run. A run that was
broken off is run again under the same number.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, datetime
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..sources import files, landing
from . import calendar, ingest, quality, universe, upsert
from .store import Table

DAILY, UNIVERSE = "daily", "universe"

#: Schema, constraints and date column of each stored table.
STORED = {
    "symbols": ("symbol_id long, isin string, symbol string, name string, face_value double, first_seen date, last_seen date", "symbols", None),
    "membership": ("symbol_id long, series string, valid_from date, valid_to date, listing_date date", "membership", None),
    "observations": ("snapshot_date date", None, None),
    "bars": ("symbol_id long, trade_date date, series string, open double, high double, low double, close double, prev_close double, last_price double, volume long, turnover double, trades long, deliv_qty long, deliv_pct double, source string", "bars", "trade_date"),
    "adjusted": ("symbol_id long, trade_date date, open double, high double, low double, close double, volume long, source string", "adjusted", "trade_date"),
    "actions": ("symbol_id long, ex_date date, purpose string, face_value double, source string", "actions", None),
    "factors": ("symbol_id long, trade_date date, factor double", "factors", "trade_date"),
    "log": ("source string, data_date date, status string, rows_loaded int, run_id long", "log", None),
    "findings": (ingest.FINDINGS, "findings", "trade_date"),
    "runs": (ingest.EVENTS, "runs", None),
}


#: What the readers of daily files give, and from which of them it is.
_READ = "path string, error string, symbol string, isin string, series string, trade_date date, file_date date, open double, high double, low double, close double, prev_close double, last_price double, volume long, turnover double, trades long, deliv_qty long, deliv_pct double, origin int"


@dataclass(frozen=True)
class Landed:
    """Where files land. A folder that is not there has no files; without the listing a run fails.

    listing: the day's listing. delivery, archives: daily files, named by their dates; the archives stand in for
    dates without a delivery file. actions: JSON arrays. candles: adjusted bars, named by their ISIN.
    delivery_date, archive_date: where the daily files' paths have their date.
    """

    listing: str
    delivery: str
    archives: str | None = None
    actions: str | None = None
    candles: str | None = None
    delivery_date: tuple[str, str] = landing.DELIVERY_DATE
    archive_date: tuple[str, str] = landing.UDIFF_DATE


def tables(spark: SparkSession, folder: str) -> dict[str, Table]:
    """The store's tables. What names a symbol must name one that is stored, and the log and the findings a run."""
    out: dict[str, Table] = {}
    for name in ("symbols", "runs", *(n for n in STORED if n not in ("symbols", "runs"))):
        schema, rules, month = STORED[name]
        refers = {c: out[t] for c, t in (("symbol_id", "symbols"), ("run_id", "runs")) if t in out and c in schema and name not in (t, "runs")}
        out[name] = Table(spark, f"{folder}/{name}", schema, rules, month, refers)
    return out


def _files(spark: SparkSession, path: str | None, where: tuple[str, str] | None = None, dates: list[date] | None = None, read: Callable[..., DataFrame] = landing.landed) -> DataFrame | None:
    """What `read` gives of the files below path (path, content), of those dates only, which are few; None if there are no files."""
    try:
        if path is None:
            return None
        if dates is None:
            found = read(spark, path)
            return None if found.select("path").isEmpty() else found
        named = landing.manifest(spark, path, where).filter(F.col("trade_date").isin(dates)).select("path").collect()
        return read(spark, [r["path"] for r in named]) if named else None
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return None


class DailyRun:
    """One run over a store. Its steps are methods, so that one can be run or replaced by itself."""

    def __init__(self, spark: SparkSession, folder: str, landed: Landed, today: date, run_id: int, catchup: int = calendar.CATCHUP_DAYS, source: str = DAILY):
        self.spark, self.folder, self.landed, self.today, self.run_id, self.catchup, self.source = spark, folder.rstrip("/"), landed, today, run_id, catchup, source
        self.at = tables(spark, self.folder)
        self.counted: dict[str, int] = {}

    def run(self, clock: Callable[[], datetime], commit: str | None = None) -> DataFrame:
        """Its summary: one row, as ingest.run_summary gives it. A fault is recorded and raised again."""
        kept: dict[str, DataFrame] = {}

        def work() -> DataFrame:
            self.update_universe()
            kept["status"], found = self.update_bars()
            self.update_actions()
            self.update_adjusted()
            loaded = [r["trade_date"] for r in kept["status"].filter(F.col("status").isin("loaded", "partial")).collect()]
            self.append_findings(found.unionByName(self.cross_check(loaded)))
            kept["findings"] = self.at["findings"].read().filter(F.col("run_id") == self.run_id)
            return kept["findings"]

        ingest.recorded_run(self.spark, f"{self.folder}/runs", self.run_id, work, clock, commit)
        counts = {name: self.spark.range(n) for name, n in self.counted.items()}
        return ingest.run_summary(kept["status"], kept["findings"], F.lit(self.run_id).cast("long"), **counts)

    # --- steps

    def update_universe(self) -> None:
        """Symbols, membership and observation of the day, from its listing."""
        listed = self._staged(landing.taken(landing.listing_read(landing.landed_lines(self.spark, self.landed.listing))).drop("path"), "listing")
        if listed.isEmpty():
            raise ValueError("the listing has no rows")
        today = F.lit(self.today)
        self.at["symbols"].replace(upsert.seen_symbols(self.at["symbols"].read(), listed, today))
        ids = self.at["symbols"].read().select("isin", "symbol_id")
        rows = listed.join(ids, "isin").select(today.alias("snapshot_date"), "symbol_id", "series", "listing_date")
        self.at["membership"].replace(universe.record_snapshots(self.at["membership"].read(), self.at["observations"].read(), rows))
        self.at["observations"].append(self.spark.createDataFrame([(self.today,)], "snapshot_date date"), str(self.today))
        self.counted["universe_symbols"] = n = rows.select("symbol_id", "series").distinct().count()
        self._log(self.spark.createDataFrame([(UNIVERSE, self.today, "loaded", n)], "source string, data_date date, status string, rows_loaded int"))

    def _staged(self, df: DataFrame, name: str) -> DataFrame:
        """df, written once: what was read is judged, counted and stored from there."""
        path = f"{self.folder}/staged/{self.run_id}-{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def pending(self) -> list[date]:
        """The dates of the catch-up window that have not settled, some days."""
        return [r["trade_date"] for r in calendar.outstanding_dates(self.spark, self.at["log"].read(), self.source, self.today, self.catchup).collect()]

    def update_bars(self) -> tuple[DataFrame, DataFrame]:
        """(status of each pending date, findings). Bars of dates without an error are stored, and the log says how it went."""
        pending = self.pending()
        expected = self.spark.createDataFrame([(d,) for d in pending], "trade_date date")
        parts = [self.spark.createDataFrame([], _READ)]
        delivery = (self.landed.delivery, self.landed.delivery_date, landing.landed_lines, landing.delivery_read)
        archives = (self.landed.archives, self.landed.archive_date, landing.landed, landing.udiff_read)
        for origin, (path, where, read, reader) in enumerate((delivery, archives), 1):
            found = _files(self.spark, path, where, pending, read)
            if found is not None:
                parts.append(reader(found, where).withColumns({"origin": F.lit(origin), "trade_date": F.coalesce("trade_date", landing.dated(F.col("path"), where))}))
        read = self._staged(reduce(DataFrame.unionByName, parts), "bars")
        bars = files.first_source(landing.taken(read.filter("origin = 1")).drop("path"), landing.taken(read.filter("origin = 2")).drop("path"))
        known = upsert.ticker_ids(self.at["symbols"].read())
        # A ticker that nobody knows is judged like any other, by a number of its own, and is not stored.
        own = -F.abs(F.xxhash64("symbol")) - 1
        bars = bars.join(known, "symbol", "left").withColumn("symbol_id", F.coalesce("symbol_id", own))
        status = ingest.load_status(expected, bars, F.lit(self.today), landing.refused(read).select("trade_date"))
        good = status.filter(F.col("status").isin("loaded", "partial")).select("trade_date")
        stored = bars.filter("symbol_id >= 0").join(good, "trade_date", "left_semi").withColumn("source", F.lit(self.source))
        self.at["bars"].upsert(stored.select(*self.at["bars"].schema.names), *upsert.RAW_BARS)
        rows = stored.groupBy("trade_date").agg(F.count("*").cast("int").alias("_n"))
        outcome = status.join(rows, "trade_date", "left").select("trade_date", "status", F.coalesce("_n", F.lit(0)).alias("rows_loaded"), "pending")
        empty = F.col("error") == "no rows"
        faults = landing.refused(read).join(bars.select("trade_date").distinct(), "trade_date", "left_anti").select(
            F.when(empty, "empty_batch").otherwise("file_refused").alias("check_name"), F.when(empty, "error").otherwise("warning").alias("severity"),
            F.when(empty, "no bars").otherwise(F.col("error")).alias("detail"), F.lit(None).cast("long").alias("symbol_id"), "trade_date",
        )
        found = quality.batch_findings(bars).unionByName(faults)
        found = found.withColumn("symbol_id", F.when(F.col("symbol_id") >= 0, F.col("symbol_id")))
        kept = self.spark.createDataFrame([tuple(r) for r in outcome.collect()], "trade_date date, status string, rows_loaded int, pending boolean")  # a row a pending date
        self._log(kept.select(F.lit(self.source).alias("source"), F.col("trade_date").alias("data_date"), "status", "rows_loaded"))
        return kept, found

    def update_actions(self) -> None:
        found = _files(self.spark, self.landed.actions)
        self.counted["corporate_actions_written"] = 0
        if found is None:
            return
        rows = found.select(landing.text_of(F.col("content")).alias("value"))
        known, _ = upsert.with_ids(files.action_columns(rows), upsert.ticker_ids(self.at["symbols"].read()), "symbol")
        rows = known.select("symbol_id", "ex_date", "purpose", "face_value", F.lit(self.source).alias("source"))
        keys, rules = upsert.ACTIONS
        new = upsert.last_by_key(rows, keys, "face_value")
        self.counted["corporate_actions_written"] = new.count()
        self.at["actions"].upsert(new, keys, rules)

    def update_adjusted(self) -> None:
        found = _files(self.spark, self.landed.candles)
        self.counted["adjusted_bars_written"] = 0
        if found is None:
            return
        bars = self._staged(landing.taken(landing.candle_read(found)).drop("path"), "adjusted")
        known, _ = upsert.with_ids(bars, self.at["symbols"].read().select("isin", "symbol_id"), "isin")
        keys, rules = upsert.ADJUSTED_BARS
        new = upsert.last_by_key(known.withColumn("source", F.lit(self.source)), keys, "close", "volume").select(*self.at["adjusted"].schema.names)
        self.counted["adjusted_bars_written"] = new.count()
        self.at["adjusted"].upsert(new, keys, rules)

    def cross_check(self, loaded: list[date]) -> DataFrame:
        """Findings of the loaded dates' pairs of raw and adjusted closes; their factors are stored."""
        self.counted["factors_written"] = 0
        if not loaded or self.at["adjusted"].version().number == 0:
            return self.spark.createDataFrame([], ingest.FINDINGS).select(*quality.FINDING)
        of = F.col("trade_date").isin(loaded)
        pairs = quality.paired_closes(self.at["bars"].read().filter(of), self.at["adjusted"].read().filter(of))
        factors = quality.adjustment_factors(pairs)
        self.counted["factors_written"] = factors.count()
        self.at["factors"].upsert(factors, *upsert.FACTORS)
        return quality.cross_findings(pairs)

    def append_findings(self, found: DataFrame, batch: str = "") -> None:
        rows = ingest.finding_rows(found.select(*quality.FINDING), F.lit(self.run_id).cast("long"))
        self.at["findings"].append(rows, f"{self.run_id}/{batch}")

    def _log(self, rows: DataFrame) -> None:
        self.at["log"].upsert(rows.withColumn("run_id", F.lit(self.run_id).cast("long")), *upsert.LOG)


class Backfill(DailyRun):
    """Unsettled weekdays of a range, the newest first, in rounds of some dates: a run that stops goes on there the next time.

    The universe is read only if no symbol is known yet. budget() says between rounds why to stop, or None.
    """

    def __init__(self, spark: SparkSession, folder: str, landed: Landed, today: date, run_id: int, start: date, end: date, limit: int = 0, dates_a_round: int = 60, source: str = DAILY):
        super().__init__(spark, folder, landed, today, run_id, source=source)
        self.start, self.end, self.limit, self.dates_a_round = start, end, limit, dates_a_round
        self.todo: list[date] = []

    def pending(self) -> list[date]:
        """The dates of this round."""
        return self.todo[: self.dates_a_round]

    def fill(self, clock: Callable[[], datetime], budget: Callable[[], str | None] = lambda: None, commit: str | None = None) -> tuple[DataFrame, str | None]:
        """(trade_date, status, rows_loaded, pending of the dates that were tried; why it stopped, or None)."""
        worklist = calendar.backfill_worklist(self.spark, self.at["log"].read(), self.source, self.start, self.end, self.limit)
        self.todo = [r["trade_date"] for r in worklist.collect()]  # the weekdays of a range
        tried: list[DataFrame] = []
        stopped: list[str | None] = [None]

        def work() -> DataFrame:
            if self.at["symbols"].version().number == 0:
                self.update_universe()
            said = None
            while self.todo and not (said := budget()):
                status, found = self.update_bars()
                tried.append(status)
                self.append_findings(found, str(self.todo[0]))
                self.todo = self.todo[self.dates_a_round :]
            stopped[0] = said
            return self.at["findings"].read().filter(F.col("run_id") == self.run_id)

        ingest.recorded_run(self.spark, f"{self.folder}/runs", self.run_id, work, clock, commit)
        return reduce(DataFrame.unionByName, tried, self.spark.createDataFrame([], "trade_date date, status string, rows_loaded int, pending boolean")), stopped[0]


def universe_at(spark: SparkSession, folder: str, day: Column) -> DataFrame:
    """symbol_id, symbol, series of the store's universe on a day."""
    at = tables(spark, folder)
    return universe.universe_on(at["membership"].read(), at["symbols"].read(), day)
