"""One query for each operator or group of operators, and the same in SQL."""

from __future__ import annotations

import io
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from datetime import date, datetime, timedelta

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import columns as C
from ..operators import audit, calendar, daily, ingest, quality, universe, upsert
from ..operators.store import Table
from ..sources import files, landing
from ..streaming import feeds
from .views import query, sql, view, views

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

DAY, TODAY, START = date(1998, 3, 15), date(1998, 3, 31), date(1998, 1, 1)
_INTERVALS = """
    SELECT symbol_id, series, min(snapshot_date) AS valid_from, max(snapshot_date) AS valid_to, min(listing_date) AS listing_date
    FROM (SELECT s.*, d.ordinal - row_number() OVER (PARTITION BY symbol_id, series ORDER BY s.snapshot_date) AS island
          FROM ({snapshots}) s JOIN (SELECT snapshot_date, row_number() OVER (ORDER BY snapshot_date) AS ordinal FROM (SELECT DISTINCT snapshot_date FROM ({snapshots}) q) r) d ON s.snapshot_date = d.snapshot_date) i
    GROUP BY symbol_id, series, island"""
_DATES = "SELECT snapshot_date, lag(snapshot_date) OVER (ORDER BY snapshot_date) AS previous, lead(snapshot_date) OVER (ORDER BY snapshot_date) AS following FROM (SELECT DISTINCT snapshot_date FROM ({snapshots}) q) r"


def registered(oracle: str | None = None) -> Callable[[Query], Query]:
    def keep(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = sql(oracle.replace("{intervals}", _INTERVALS).replace("{dates}", _DATES))
        return f

    return keep


def _intervals(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    snapshots = view(spark, sf_dir, "snapshots")
    return snapshots, universe.build_intervals(snapshots), universe.observations(snapshots)


# --- universe


@registered("{intervals}")
def universe_intervals(spark, sf_dir):
    return _intervals(spark, sf_dir)[1].select("symbol_id", "series", "valid_from", "valid_to", "listing_date")


@registered("SELECT i.symbol_id, s.symbol, i.series FROM ({intervals}) i JOIN ({symbols}) s ON i.symbol_id = s.symbol_id WHERE valid_from <= DATE '1998-03-15' AND valid_to >= DATE '1998-03-15'")
def universe_on_date(spark, sf_dir):
    return universe.universe_on(_intervals(spark, sf_dir)[1], view(spark, sf_dir, "symbols"), F.lit(DAY))


@registered("SELECT snapshot_date, count(*) AS n_listed FROM ({snapshots}) s GROUP BY snapshot_date")
def universe_size_by_date(spark, sf_dir):
    _, intervals, dates = _intervals(spark, sf_dir)
    return universe.size_by_date(intervals, dates)


@registered("""
    SELECT (SELECT count(*) FROM (SELECT snapshot_date, symbol_id, series FROM ({snapshots}) a EXCEPT SELECT d.snapshot_date, v.symbol_id, v.series FROM ({intervals}) v JOIN ({dates}) d ON d.snapshot_date BETWEEN v.valid_from AND v.valid_to) e) AS missing,
           (SELECT count(*) FROM (SELECT d.snapshot_date, v.symbol_id, v.series FROM ({intervals}) v JOIN ({dates}) d ON d.snapshot_date BETWEEN v.valid_from AND v.valid_to EXCEPT SELECT snapshot_date, symbol_id, series FROM ({snapshots}) a) e) AS extra, r.n AS n_rows, i.n AS n_intervals, round(100.0 * (r.n - i.n) / r.n, 1) AS reduction_pct
    FROM (SELECT count(*) AS n FROM (SELECT DISTINCT snapshot_date, symbol_id, series FROM ({snapshots}) s) x) r, (SELECT count(*) AS n FROM ({intervals}) y) i""")
def interval_equivalence(spark, sf_dir):
    snapshots, intervals, _ = _intervals(spark, sf_dir)
    return universe.equivalence(snapshots, intervals)


_CHANGES = """
    SELECT m.symbol_id, m.series, m.valid_from,
           CASE WHEN p.valid_from IS NULL THEN 'new_symbol' WHEN p.series <> m.series THEN 'series_change' WHEN p.valid_to = d.previous THEN 'SUSPECT_SPLIT' ELSE 'gap_relist' END AS kind
    FROM ({intervals}) m JOIN ({dates}) d ON d.snapshot_date = m.valid_from
    LEFT JOIN (SELECT a.symbol_id, a.series, a.valid_from, b.valid_from AS q_from, b.series AS q_series, b.valid_to AS q_to,
                      row_number() OVER (PARTITION BY a.symbol_id, a.series, a.valid_from ORDER BY b.valid_from DESC, b.series DESC, b.valid_to DESC) AS n
               FROM ({intervals}) a JOIN ({intervals}) b ON a.symbol_id = b.symbol_id AND b.valid_from < a.valid_from) r
           ON r.symbol_id = m.symbol_id AND r.series = m.series AND r.valid_from = m.valid_from AND r.n = 1
    LEFT JOIN (SELECT 1 AS one) u ON true
    CROSS JOIN LATERAL (SELECT r.q_from AS valid_from, r.q_series AS series, r.q_to AS valid_to) p
    WHERE d.previous IS NOT NULL"""


@registered(_CHANGES)
def universe_changes(spark, sf_dir):
    _, intervals, dates = _intervals(spark, sf_dir)
    return universe.changes(intervals, dates)


@registered(f"SELECT count(*) FILTER (kind = 'new_symbol') AS new_symbol, count(*) FILTER (kind = 'series_change') AS series_change, count(*) FILTER (kind = 'gap_relist') AS gap_relist, count(*) FILTER (kind = 'SUSPECT_SPLIT') AS suspect_split, CASE WHEN count(*) FILTER (kind = 'SUSPECT_SPLIT') > 0 THEN 'fail' ELSE 'ok' END AS verdict FROM ({_CHANGES}) c")
def universe_change_counts(spark, sf_dir):
    _, intervals, dates = _intervals(spark, sf_dir)
    return universe.report_verdict(universe.changes(intervals, dates))


@registered("""
    SELECT i.symbol_id, i.series, i.valid_from, i.valid_to, d.following AS closed_on,
           EXISTS (SELECT 1 FROM ({intervals}) o WHERE o.symbol_id = i.symbol_id AND o.valid_from = d.following) AS reappears
    FROM ({intervals}) i JOIN ({dates}) d ON d.snapshot_date = i.valid_to WHERE d.following IS NOT NULL""")
def closed_intervals(spark, sf_dir):
    _, intervals, dates = _intervals(spark, sf_dir)
    return universe.closed(intervals, dates)


@registered("SELECT snapshot_date FROM (SELECT DISTINCT snapshot_date FROM ({snapshots}) s) d ORDER BY snapshot_date DESC LIMIT 2")
def latest_observations(spark, sf_dir):
    return universe.latest_two(universe.observations(view(spark, sf_dir, "snapshots")))


@registered("{intervals}")
def universe_incremental(spark, sf_dir):
    """All but the last three snapshots at once, these day by day: the same intervals as all at once."""
    snapshots, _, dates = _intervals(spark, sf_dir)
    steps = [(r["snapshot_date"], r["previous"]) for r in dates.orderBy(F.desc("snapshot_date")).limit(3).collect()][::-1]
    out = universe.build_intervals(snapshots.filter(F.col("snapshot_date") < F.lit(steps[0][0]))).select("symbol_id", "series", "valid_from", "valid_to", "listing_date")
    for day, previous in steps:
        out = universe.record_snapshot(out, snapshots.filter(F.col("snapshot_date") == F.lit(day)), F.lit(day), F.lit(previous))
    return out


@registered("{intervals}")
def universe_bulk(spark, sf_dir):
    """Every third snapshot at once; then the latest ones and some of the first, again; then all others, which fall between those: three plans for all days."""
    snapshots, _, dates = _intervals(spark, sf_dir)
    numbered = snapshots.join(dates.select("snapshot_date", "ordinal"), "snapshot_date")
    batches = [numbered.filter(w).drop("ordinal") for w in ("ordinal % 3 = 0 AND ordinal < 60", "ordinal >= 60 OR ordinal % 6 = 0", "ordinal % 3 <> 0")]
    out, known = universe.build_intervals(batches[0]), batches[0].select("snapshot_date")
    for batch in batches[1:]:
        out, known = universe.record_snapshots(out, known, batch), known.union(batch.select("snapshot_date"))
    return out.select("symbol_id", "series", "valid_from", "valid_to", "listing_date")


_LATEST = "(SELECT max(snapshot_date) FROM ({snapshots}) z)"
_PREVIOUS = "(SELECT max(previous) FROM ({dates}) z)"
_OPENED = f"""
    SELECT m.symbol_id, m.series, m.valid_from, m.valid_to,
           CASE WHEN p.series IS NULL THEN 'new_symbol' WHEN p.series <> m.series THEN 'series_change' WHEN p.valid_to = {_PREVIOUS} THEN 'SUSPECT_SPLIT' ELSE 'gap_relist' END AS kind
    FROM ({{intervals}}) m LEFT JOIN (
        SELECT a.symbol_id, a.series AS own, a.valid_from AS own_from, b.series, b.valid_to, row_number() OVER (PARTITION BY a.symbol_id, a.series, a.valid_from ORDER BY b.valid_from DESC, b.series DESC) AS n
        FROM ({{intervals}}) a JOIN ({{intervals}}) b ON a.symbol_id = b.symbol_id AND b.valid_from < a.valid_from) p ON p.symbol_id = m.symbol_id AND p.own = m.series AND p.own_from = m.valid_from AND p.n = 1
    WHERE m.valid_from >= {_LATEST}"""


@registered(f"""
    SELECT 'size' AS section, NULL AS symbol_id, NULL AS series, NULL AS valid_from, NULL AS valid_to, CAST(d.day AS VARCHAR) AS note, count(*) AS n
    FROM (SELECT {_LATEST} AS day UNION ALL SELECT {_PREVIOUS}) d JOIN ({{intervals}}) i ON i.valid_from <= d.day AND i.valid_to >= d.day GROUP BY d.day
    UNION ALL SELECT 'kind', NULL, NULL, NULL, NULL, kind, count(*) FROM ({_OPENED}) o GROUP BY kind
    UNION ALL SELECT 'opened', symbol_id, series, valid_from, valid_to, kind, NULL FROM ({_OPENED}) o
    UNION ALL SELECT 'closed', symbol_id, series, valid_from, valid_to, CASE WHEN symbol_id IN (SELECT symbol_id FROM ({_OPENED}) o) THEN 'reappears under another series' ELSE 'absent from the latest list' END, NULL FROM ({{intervals}}) i WHERE valid_to = {_PREVIOUS}
    UNION ALL SELECT 'verdict', NULL, NULL, NULL, NULL, CASE WHEN count(*) > 0 THEN 'FAIL' ELSE 'OK' END, count(*) FROM ({_OPENED}) o WHERE kind = 'SUSPECT_SPLIT'""")
def universe_report(spark, sf_dir):
    """What the latest observation changed."""
    _, intervals, dates = _intervals(spark, sf_dir)
    latest, previous = (r["snapshot_date"] for r in universe.latest_two(dates).collect())
    return universe.change_report(intervals, F.lit(latest), F.lit(previous))


# --- parsing


@registered("""
    SELECT concat('SYM', CAST(l_partkey AS VARCHAR)) AS symbol, CASE l_returnflag WHEN 'A' THEN 'EQ' ELSE 'BE' END AS series, ship_date AS file_date, whole_price + 0.5 AS close,
           CAST(l_quantity AS BIGINT) AS volume, (whole_price + 0.5) * 100000 AS turnover
    FROM ({dirty}) d WHERE l_returnflag <> 'R' AND l_orderkey % 11 <> 0 AND l_orderkey % 13 <> 0 AND l_orderkey % 17 <> 0""")
def parse_delivery(spark, sf_dir):
    d = view(spark, sf_dir, "dirty")
    raw = d.select(F.col("symbol_text").alias("SYMBOL"), F.col("series_text").alias(" SERIES"), F.col("date_text").alias(" DATE1"), *(F.col("price_text").alias(f" {c}") for c in ("OPEN_PRICE", "HIGH_PRICE", "LOW_PRICE", "CLOSE_PRICE", "TURNOVER_LACS")), F.col("qty_text").alias(" TTL_TRD_QNTY"))
    return files.delivery_columns(raw, F.lit(DAY)).select("symbol", "series", "file_date", "close", "volume", "turnover")


@registered("""
    SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 11 = 0 OR l_orderkey % 13 = 0 OR l_orderkey % 17 = 0 THEN NULL ELSE whole_price + 0.5 END AS price,
           CASE WHEN l_orderkey % 11 = 0 OR l_orderkey % 13 = 0 OR l_orderkey % 17 = 0 THEN NULL ELSE CAST(whole_price AS BIGINT) END AS whole, ship_date AS parsed, strftime(ship_date, '%d%m%Y') AS stamp, strftime(ship_date, '%Y%m%d') AS sortable,
           concat('NSE_EQ|', trim(symbol_text)) AS instrument
    FROM ({dirty}) d""")
def parse_numbers_and_dates(spark, sf_dir):
    d = view(spark, sf_dir, "dirty")
    day = C.dashed_date(F.col("date_text"))
    return d.select("l_orderkey", "l_linenumber", C.to_double(F.col("price_text")).alias("price"), C.to_long(F.col("price_text")).alias("whole"), day.alias("parsed"), C.compact_date(day).alias("stamp"), C.sortable_date(day).alias("sortable"), C.instrument_key(C.clean(F.col("symbol_text"))).alias("instrument"))


@registered("SELECT symbol, name, 'EQ' AS series, DATE '2001-02-03' AS listing_date, isin, face_value FROM ({symbols}) s WHERE symbol_id % 7 <> 0 AND symbol_id % 11 <> 0")
def parse_listing(spark, sf_dir):
    """Listing rows with padded cells; every seventh lacks its ISIN, every eleventh its ticker."""
    s = view(spark, sf_dir, "symbols")
    raw = s.select(
        F.when(F.col("symbol_id") % 11 != 0, F.concat(F.lit(" "), "symbol")).alias("SYMBOL"), F.concat("name", F.lit(" ")).alias("NAME OF COMPANY"), F.lit(" EQ").alias(" SERIES"), F.lit("03-FEB-2001").alias(" DATE OF LISTING"),
        F.when(F.col("symbol_id") % 7 == 0, F.lit("  ")).otherwise(F.col("isin")).alias(" ISIN NUMBER"), F.col("face_value").cast("string").alias(" FACE VALUE"),
    )
    return files.listing_columns(raw)


@registered("SELECT concat('INE', CAST(l_partkey AS VARCHAR)) AS isin, ship_date AS trade_date, whole_price AS close, CAST(l_quantity AS BIGINT) AS volume FROM ({dirty}) d WHERE l_orderkey % 5 <> 0")
def parse_candles(spark, sf_dir):
    """Nested arrays written from line items; every fifth order has a broken body or a short candle."""
    d = view(spark, sf_dir, "dirty")
    cell = lambda c: F.col(c).cast("bigint").cast("string")
    whole = F.concat(F.lit('{"status":"success","data":{"candles":[["bad"],["'), F.col("ship_date").cast("string"), F.lit('T00:00:00+05:30",1.5,'), cell("whole_price"), F.lit(",1,"), cell("whole_price"), F.lit(","), cell("l_quantity"), F.lit(",0]]}}"))
    body = F.when(F.col("l_orderkey") % 5 != 0, whole).when(F.col("l_orderkey") % 2 == 0, F.lit("no json")).otherwise(F.lit('{"data":{"candles":[["2020-01-01T00:00:00+05:30",1]]}}'))
    return files.candle_columns(d.select(body.alias("body"), "l_partkey"), "body", F.concat(F.lit("INE"), F.col("l_partkey").cast("string"))).select("isin", "trade_date", "close", "volume")


def _zipped(rows: pd.DataFrame) -> pd.DataFrame:
    """One day's rows, or a part of them, as a zipped file."""
    content = io.BytesIO()
    folder = f"/landed/{rows['part'].iloc[0]}" if "part" in rows else "/landed"
    with zipfile.ZipFile(content, "w") as archive:
        archive.writestr("about.txt", "no data")
        archive.writestr("DAY.CSV", rows.drop(columns=[c for c in ("day", "part") if c in rows]).to_csv(index=False))
    return pd.DataFrame({"path": [f"{folder}/BhavCopy_{rows['day'].iloc[0]}_F.zip"], "content": [content.getvalue()]}, dtype=object)


@registered("""
    SELECT concat('SYM', CAST(l_partkey AS VARCHAR)) AS symbol, concat('INE', CAST(l_partkey AS VARCHAR)) AS isin, CASE l_returnflag WHEN 'A' THEN 'EQ' ELSE 'BE' END AS series, ship_date AS trade_date, ship_date AS file_date,
           whole_price + 0.5 AS close, CAST(l_quantity AS BIGINT) AS volume
    FROM ({dirty}) d WHERE l_returnflag <> 'R' AND l_orderkey % 11 <> 0 AND l_orderkey % 13 <> 0 AND l_orderkey % 17 <> 0 AND l_orderkey % 5 <> 0""")
def parse_zip(spark, sf_dir):
    """A zipped file for each ship date; every fifth order is no stock."""
    d = view(spark, sf_dir, "dirty")
    cells = {"TradDt": F.col("ship_date").cast("string"), "FinInstrmTp": F.when(F.col("l_orderkey") % 5 == 0, " IDX").otherwise(" STK "), "ISIN": F.concat(F.lit("INE"), F.col("l_partkey").cast("string")), "TckrSymb": F.col("symbol_text"), " SctySrs": F.col("series_text")}
    cells |= {c: F.col("price_text") for c in ("OpnPric", "HghPric", "LwPric", "ClsPric")} | {"TtlTradgVol": F.col("qty_text")}
    rows = d.select(F.date_format("ship_date", "yyyyMMdd").alias("day"), *(c.alias(n) for n, c in cells.items()))
    archives = rows.groupBy("day").applyInPandas(_zipped, "path string, content binary")
    return files.udiff_columns(archives).select("symbol", "isin", "series", "trade_date", "file_date", "close", "volume")


@registered("""
    SELECT concat('SYM', CAST(l_partkey AS VARCHAR)) AS symbol, ship_date AS ex_date, CASE WHEN l_linenumber % 2 = 0 THEN 'DIVIDEND' ELSE 'unspecified' END AS purpose, l_quantity AS face_value
    FROM ({dirty}) d WHERE l_orderkey % 7 <> 0""")
def parse_actions(spark, sf_dir):
    """JSON objects written from line items, with alternate keys; every seventh has no ex-date."""
    d = view(spark, sf_dir, "dirty")
    one = F.struct(
        F.when(F.col("l_orderkey") % 2 == 0, F.col("symbol_text")).otherwise(" ").alias("symbol"), F.col("symbol_text").alias("comp"),
        F.when(F.col("l_orderkey") % 7 == 0, F.lit("-")).otherwise(F.col("date_text")).alias("exDate"), F.col("l_quantity").cast("string").alias("faceVal"),
        F.when(F.col("l_linenumber") % 2 == 0, F.lit("DIVIDEND")).alias("purpose"), F.lit("").alias("subject"),
    )
    return files.action_columns(d.select(F.to_json(F.array(one)).alias("value"))).select("symbol", "ex_date", "purpose", "face_value")


@registered("SELECT trim(series_text) AS series, count(*) AS n FROM ({dirty}) d GROUP BY 1")
def series_profile(spark, sf_dir):
    return files.series_profile(view(spark, sf_dir, "dirty"), "series_text")


@registered("SELECT event_id, CAST(ts + INTERVAL '330' MINUTE AS DATE) AS local_day FROM events")
def local_trade_date(spark, sf_dir):
    e = query(spark, sf_dir, "SELECT * FROM {events}")
    return e.select("event_id", C.local_date(F.unix_millis(F.col("ts").cast("timestamp"))).alias("local_day"))


@registered("""
    SELECT trade_date, symbol_id, origin FROM (
        SELECT b.trade_date, b.symbol_id, 1 AS origin FROM ({bars}) b WHERE day(b.trade_date) % 3 <> 0 AND series = 'EQ'
        UNION ALL
        SELECT b.trade_date, b.symbol_id, 2 AS origin FROM ({bars}) b WHERE series = 'BE' AND b.trade_date NOT IN (SELECT trade_date FROM ({bars}) c WHERE day(c.trade_date) % 3 <> 0 AND series = 'EQ')) u""")
def source_preference(spark, sf_dir):
    bars = view(spark, sf_dir, "bars").select("trade_date", "symbol_id", "series")
    first = bars.filter((F.day("trade_date") % 3 != 0) & (F.col("series") == "EQ")).drop("series")
    return files.preferred_by_date(first, bars.filter("series = 'BE'").drop("series")).select("trade_date", "symbol_id", "origin")


# --- bars and quality


@registered("SELECT trade_date, count(*) AS n_bars, count(deliv_pct) AS n_delivery, count(deliv_pct) > 0 AS any_delivery FROM ({bars}) b GROUP BY trade_date")
def coverage_by_date(spark, sf_dir):
    return ingest.coverage(view(spark, sf_dir, "bars"))


@registered("SELECT max(trade_date) AS latest, count(*) AS n_bars FROM ({bars}) b")
def latest_bar(spark, sf_dir):
    return ingest.latest_bar(view(spark, sf_dir, "bars"))


_OHLC = " UNION ALL ".join(
    f"SELECT 'ohlc_insane' AS check_name, 'error' AS severity, '{name}' AS detail, symbol_id, trade_date FROM ({{bars}}) b WHERE {rule}"
    for name, rule in (("high below low", "high < low"), ("high below open or close", "high < open OR high < close"), ("low above open or close", "low > open OR low > close"), ("price not positive", "open <= 0 OR close <= 0"), ("negative volume", "volume < 0"))
)
_BATCH = _OHLC + " UNION ALL SELECT 'date_mismatch', 'error', 'bar dated 1999-12-31', symbol_id, trade_date FROM ({bars}) b WHERE file_date <> trade_date"


@registered(_BATCH)
def bar_findings(spark, sf_dir):
    return quality.batch_findings(view(spark, sf_dir, "bars"))


@registered("SELECT l_partkey % 50 AS symbol_id, CAST(l_shipdate AS DATE) AS trade_date, l_returnflag AS series, count(*) AS n FROM lineitem GROUP BY 1, 2, 3 HAVING count(*) > 1")
def duplicate_bars(spark, sf_dir):
    rows = query(spark, sf_dir, "SELECT l_partkey % 50 AS symbol_id, CAST(l_shipdate AS DATE) AS trade_date, l_returnflag AS series FROM {lineitem}")
    return quality.duplicate_keys(rows)


_ROWS = "SELECT l_partkey % 50 AS symbol_id, CAST(l_shipdate AS DATE) AS trade_date, l_returnflag AS series, CAST(1 AS DOUBLE) AS open, CAST(2 AS DOUBLE) AS high, CAST(1 AS DOUBLE) AS low, CAST(2 AS DOUBLE) AS close, CAST(l_orderkey % 40 - 1 AS BIGINT) AS volume, CAST(l_shipdate AS DATE) AS file_date FROM {lineitem} WHERE day(l_shipdate) % 10 <> 0"


@registered(f"""
    SELECT 'duplicate_bar' AS check_name, 'error' AS severity, concat('series ', series) AS detail, symbol_id, trade_date FROM ({_ROWS}) r GROUP BY symbol_id, trade_date, series HAVING count(*) > 1
    UNION ALL SELECT 'ohlc_insane', 'error', 'negative volume', symbol_id, trade_date FROM ({_ROWS}) r WHERE volume < 0
    UNION ALL SELECT 'empty_batch', 'error', 'no bars', NULL, CAST(d AS DATE) FROM range(DATE '1998-01-01', DATE '1998-04-01', INTERVAL 1 DAY) w(d) WHERE isodow(CAST(d AS DATE)) < 6 AND CAST(d AS DATE) NOT IN (SELECT trade_date FROM ({_ROWS}) r)""")
def repeated_and_empty_batches(spark, sf_dir):
    """Line items as bars: keys repeat, and every tenth day has none."""
    return quality.batch_findings(query(spark, sf_dir, _ROWS), calendar.candidate_dates(spark, START, TODAY))


@registered(f"SELECT symbol_id, trade_date, series, close FROM ({{bars}}) b WHERE trade_date NOT IN (SELECT trade_date FROM ({_BATCH}) f)")
def accepted_batches(spark, sf_dir):
    bars = view(spark, sf_dir, "bars")
    return quality.accepted(bars, quality.batch_findings(bars)).select("symbol_id", "trade_date", "series", "close")


@registered(f"SELECT count(*) FILTER (severity = 'info') AS n_info, count(*) FILTER (severity = 'warning') AS n_warning, count(*) FILTER (severity = 'error') AS n_error, count(*) FILTER (severity = 'error') > 0 AS has_errors FROM ({_BATCH}) f")
def severity_rollup(spark, sf_dir):
    return quality.severity_rollup(quality.batch_findings(view(spark, sf_dir, "bars")))


@registered(f"SELECT check_name, severity, left(detail, 4000) AS detail, symbol_id, trade_date, 7 AS run_id FROM ({_BATCH}) f")
def stored_findings(spark, sf_dir):
    return ingest.finding_rows(quality.batch_findings(view(spark, sf_dir, "bars")), F.lit(7))


@registered(f"SELECT check_name, severity, detail, symbol_id, trade_date FROM ({_BATCH}) f ORDER BY trade_date, symbol_id, check_name, detail LIMIT 20")
def first_errors(spark, sf_dir):
    return quality.first_errors(quality.batch_findings(view(spark, sf_dir, "bars")))


_PAIRS = "SELECT r.symbol_id, r.trade_date, r.series, r.close AS raw_close, r.volume AS raw_volume, a.close AS adj_close, a.volume AS adj_volume FROM ({bars}) r JOIN ({adjusted}) a ON r.symbol_id = a.symbol_id AND r.trade_date = a.trade_date"
_JUDGED = f"""
    SELECT *, CASE WHEN factor IS NULL THEN 'factor_uncomputable' WHEN factor > 1000 OR factor < 1 / CAST(1000 AS DOUBLE) THEN 'implausible_factor'
                   WHEN NOT coalesce(raw_volume <> 0 AND abs(CAST(raw_volume AS DOUBLE) / nullif(CAST(adj_volume AS DOUBLE), 0) - 1 / factor) <= 0.005 * greatest(1 / factor, CAST(1 AS DOUBLE)), false) THEN 'volume_factor_mismatch' END AS check_name
    FROM (SELECT *, CASE WHEN raw_close > 0 AND adj_close > 0 THEN CAST(raw_close AS DOUBLE) / CAST(adj_close AS DOUBLE) END AS factor FROM ({_PAIRS}) p) f"""


def _pairs(spark, sf_dir):
    bars, adjusted = views(spark, sf_dir, "bars", "adjusted")
    both = quality.paired_closes(bars, adjusted)
    return both.withColumns({c: F.col(c).cast("double") for c in ("raw_close", "adj_close")})


@registered(f"SELECT symbol_id, trade_date, series, CAST(raw_close AS DOUBLE) AS raw_close, raw_volume, adj_volume FROM ({_PAIRS}) p")
def paired_closes(spark, sf_dir):
    return _pairs(spark, sf_dir).select("symbol_id", "trade_date", "series", "raw_close", "raw_volume", "adj_volume")


@registered(f"SELECT check_name, CASE check_name WHEN 'implausible_factor' THEN 'error' ELSE 'warning' END AS severity, concat('series ', series) AS detail, symbol_id, trade_date FROM ({_JUDGED}) j WHERE check_name IS NOT NULL")
def factor_findings(spark, sf_dir):
    return quality.cross_findings(_pairs(spark, sf_dir))


@registered(f"""
    SELECT symbol_id, trade_date, CAST(round(factor, 8) AS DECIMAL(18, 8)) AS factor
    FROM (SELECT *, row_number() OVER (PARTITION BY symbol_id, trade_date ORDER BY CASE series WHEN 'EQ' THEN 1 WHEN 'BE' THEN 2 ELSE 3 END) AS n FROM ({_JUDGED}) j WHERE check_name IS NULL OR check_name = 'volume_factor_mismatch') k WHERE n = 1""")
def adjustment_factors(spark, sf_dir):
    return quality.adjustment_factors(_pairs(spark, sf_dir)).select("symbol_id", "trade_date", F.col("factor").cast("decimal(18,8)").alias("factor"))


@registered("SELECT symbol_id, trade_date, series, CASE WHEN open <> 0 AND high <> 0 AND low <> 0 AND close <> 0 AND symbol_id % 2 = 0 THEN CAST(2.0 AS DOUBLE) END AS ratio FROM ({bars}) b WHERE volume > 0")
def ohlc_ratio(spark, sf_dir):
    """Raw prices against halves of themselves; symbols with odd numbers get one that disagrees."""
    bars = view(spark, sf_dir, "bars").filter("volume > 0")
    raw = [F.col(c).cast("double") for c in ("open", "high", "low", "close")]
    halves = [raw[0] / 2, F.when(F.col("symbol_id") % 2 == 0, raw[1] / 2).otherwise(raw[1] / 3), raw[2] / 2, raw[3] / 2]
    return bars.select("symbol_id", "trade_date", "series", C.agreed_ratio(raw, halves).alias("ratio"))


# --- upserts: a first batch is the even orders, a second all


def _halves(df: DataFrame, by: str) -> tuple[DataFrame, DataFrame]:
    return df.filter(F.col(by) % 2 == 0), df


@registered("""
    SELECT isin, symbol_id, concat(symbol, 'N') AS symbol, CASE WHEN symbol_id % 3 = 0 AND symbol_id % 2 = 0 THEN name WHEN symbol_id % 3 = 0 THEN NULL ELSE concat(name, '!') END AS name,
           DATE '1999-01-01' AS first_seen, CASE WHEN symbol_id % 2 = 0 THEN DATE '2001-01-01' ELSE DATE '2000-06-01' END AS last_seen
    FROM ({symbols}) s""")
def upsert_symbols(spark, sf_dir):
    old, new = _halves(view(spark, sf_dir, "symbols"), "symbol_id")
    new = new.select("symbol_id", "isin", F.concat("symbol", F.lit("N")).alias("symbol"), F.when(F.col("symbol_id") % 3 != 0, F.concat("name", F.lit("!"))).alias("name"), F.lit(date(1999, 1, 1)).alias("first_seen"), F.lit(date(2000, 6, 1)).alias("last_seen"), "face_value")
    return upsert.keyed_upsert(old, new, *upsert.SYMBOLS).select("isin", "symbol_id", "symbol", "name", "first_seen", "last_seen")


@registered("""
    SELECT isin, CASE WHEN symbol_id % 2 = 0 THEN symbol_id ELSE (SELECT max(symbol_id) FROM ({symbols}) m WHERE symbol_id % 2 = 0) + row_number() OVER (PARTITION BY symbol_id % 2 ORDER BY isin) END AS symbol_id, symbol,
           CASE WHEN symbol_id % 5 = 0 AND symbol_id % 2 = 1 THEN NULL ELSE name END AS name,
           CASE WHEN symbol_id % 2 = 0 THEN DATE '1995-01-02' WHEN symbol_id % 3 = 0 THEN DATE '1998-03-31' ELSE DATE '1995-01-02' END AS first_seen, CASE WHEN symbol_id % 2 = 0 THEN DATE '2001-01-01' ELSE DATE '1998-03-31' END AS last_seen
    FROM ({symbols}) s WHERE symbol_id % 6 <> 0""")
def seen_symbols(spark, sf_dir):
    """A day's listing: new ISINs get ids and their listing date, or the day itself, as first seen; blank names fill nothing."""
    all_ = view(spark, sf_dir, "symbols").filter("symbol_id % 6 <> 0")
    listed = all_.select("isin", "symbol", F.when(F.col("symbol_id") % 5 == 0, F.lit(" ")).otherwise(F.col("name")).alias("name"), "face_value", F.when(F.col("symbol_id") % 3 != 0, F.lit(date(1995, 1, 2))).alias("listing_date"))
    return upsert.seen_symbols(all_.filter("symbol_id % 2 = 0"), listed, F.lit(TODAY)).select("isin", "symbol_id", "symbol", "name", "first_seen", "last_seen")


@registered("SELECT isin, symbol_id, symbol FROM ({symbols}) s ORDER BY symbol, isin LIMIT 40")
def symbols_by_ticker(spark, sf_dir):
    return upsert.symbols_by_ticker(view(spark, sf_dir, "symbols"), 40)


@registered("SELECT symbol_id, trade_date, series, CASE WHEN trade_date BETWEEN DATE '1998-03-10' AND DATE '1998-05-20' THEN close + 1 ELSE close END AS close, deliv_qty FROM ({bars}) b")
def upsert_stored_bars(spark, sf_dir):
    """Bars stored by month; a revision of some weeks reads and replaces the months it touches."""
    folder = _folder(spark)
    bars = view(spark, sf_dir, "bars").select("symbol_id", "trade_date", "series", F.col("close").cast("double").alias("close"), "deliv_qty")
    upsert.write_partitions(bars, f"{folder}/bars", "trade_date")
    revised = bars.filter("trade_date BETWEEN DATE '1998-03-10' AND DATE '1998-05-20'").withColumns({"close": F.col("close") + 1, "deliv_qty": F.lit(None).cast("long")})
    keys, rules = upsert.RAW_BARS
    for _ in range(2):  # the second time changes nothing
        upsert.upsert_months(spark, f"{folder}/bars", bars.schema, revised, keys, rules, "trade_date")
    return spark.read.parquet(f"{folder}/bars").drop("trade_month")


@registered("""
    SELECT symbol_id, trade_date, series, close + 1 AS close, CASE WHEN symbol_id % 2 = 0 THEN deliv_qty END AS deliv_qty
    FROM ({bars}) b""")
def upsert_bars(spark, sf_dir):
    """Revised prices win; delivery figures that the revision lacks stay."""
    old, new = _halves(view(spark, sf_dir, "bars"), "symbol_id")
    new = new.withColumns({"close": F.col("close") + 1, "deliv_qty": F.lit(None).cast("bigint"), "deliv_pct": F.lit(None).cast("double")})
    old = old.withColumn("close", F.col("close").cast(new.schema["close"].dataType))
    return upsert.keyed_upsert(old, new, *upsert.RAW_BARS).select("symbol_id", "trade_date", "series", "close", "deliv_qty")


@registered("SELECT symbol_id, trade_date, volume + 1 AS volume FROM ({adjusted}) a")
def upsert_adjusted(spark, sf_dir):
    old, new = _halves(view(spark, sf_dir, "adjusted"), "symbol_id")
    return upsert.keyed_upsert(old, new.withColumn("volume", F.col("volume") + 1), *upsert.ADJUSTED_BARS).select("symbol_id", "trade_date", "volume")


_ACTIONS = "SELECT DISTINCT l_partkey % 50 AS symbol_id, CAST(l_shipdate AS DATE) AS ex_date, l_returnflag AS purpose FROM {lineitem}"


@registered(f"SELECT symbol_id, ex_date, purpose, CASE WHEN symbol_id % 3 = 0 AND symbol_id % 2 = 0 THEN 1 WHEN symbol_id % 3 = 0 THEN NULL ELSE 2 END AS face_value, CASE WHEN symbol_id % 2 = 0 THEN 'first' ELSE 'second' END AS source FROM ({_ACTIONS}) a")
def upsert_actions(spark, sf_dir):
    """Face values are filled in; the source of a known action stays."""
    old, new = _halves(query(spark, sf_dir, _ACTIONS), "symbol_id")
    old = old.withColumns({"face_value": F.lit(1), "source": F.lit("first")})
    new = new.withColumns({"face_value": F.when(F.col("symbol_id") % 3 != 0, 2), "source": F.lit("second")})
    return upsert.keyed_upsert(old, new, *upsert.ACTIONS)


@registered("SELECT symbol_id, trade_date, CASE WHEN symbol_id % 2 = 0 THEN 3 ELSE 2 END AS factor FROM ({adjusted}) a")
def upsert_factors(spark, sf_dir):
    keys = view(spark, sf_dir, "adjusted").select("symbol_id", "trade_date")
    new = keys.filter("symbol_id % 2 = 0").withColumn("factor", F.lit(3))
    return upsert.keyed_upsert(keys.withColumn("factor", F.lit(2)), new, *upsert.FACTORS)


@registered("{log}")
def upsert_log(spark, sf_dir):
    """Outcomes of a date one after the other: the last one holds."""
    events = view(spark, sf_dir, "log_events")
    first, rest = events.filter("seq % 2 = 0"), events
    keys, rules = upsert.LOG
    old = upsert.last_by_key(first, keys, "seq").drop("seq")
    return upsert.keyed_upsert(old, upsert.last_by_key(rest, keys, "seq").drop("seq"), keys, rules).select("source", "data_date", "status", "rows_loaded")


@registered("SELECT symbol_id, trade_date, CASE WHEN symbol_id % 2 = 0 THEN 1 ELSE 2 END AS origin FROM ({adjusted}) a")
def insert_missing(spark, sf_dir):
    keys = view(spark, sf_dir, "adjusted").select("symbol_id", "trade_date")
    return upsert.insert_missing(keys.filter("symbol_id % 2 = 0").withColumn("origin", F.lit(1)), keys.withColumn("origin", F.lit(2)), ["symbol_id", "trade_date"])


@registered("""
    SELECT concat('SYM', CAST(o_custkey % 1500 AS VARCHAR)) AS symbol, o_orderkey, t.symbol_id
    FROM orders o LEFT JOIN (SELECT symbol, min(symbol_id) AS symbol_id FROM ({symbols}) s GROUP BY symbol) t ON t.symbol = concat('SYM', CAST(o_custkey % 1500 AS VARCHAR))""")
def ticker_lookup(spark, sf_dir):
    """Known tickers with their id, and the rows that nobody knows."""
    rows = query(spark, sf_dir, "SELECT concat('SYM', CAST(o_custkey % 1500 AS STRING)) AS symbol, o_orderkey FROM {orders}")
    known, unknown = upsert.with_ids(rows, upsert.ticker_ids(view(spark, sf_dir, "symbols")), "symbol")
    return known.unionByName(unknown, allowMissingColumns=True)


@registered("SELECT b.isin, b.o_orderkey, s.symbol_id FROM (SELECT concat('INE', lpad(CAST(o_custkey % 1800 AS VARCHAR), 9, '0')) AS isin, o_orderkey FROM orders) b LEFT JOIN ({symbols}) s ON s.isin = b.isin")
def isin_lookup(spark, sf_dir):
    """Adjusted bars come with an ISIN: those known with their id, and those that nobody knows."""
    rows = query(spark, sf_dir, "SELECT concat('INE', lpad(CAST(o_custkey % 1800 AS STRING), 9, '0')) AS isin, o_orderkey FROM {orders}")
    known, unknown = upsert.with_ids(rows, view(spark, sf_dir, "symbols").select("isin", "symbol_id"), "isin")
    return known.unionByName(unknown, allowMissingColumns=True)


@registered("""
    SELECT a.symbol, a.ex_date, a.purpose, t.symbol_id
    FROM (SELECT DISTINCT concat('SYM', CAST(l_partkey AS VARCHAR)) AS symbol, ship_date AS ex_date, CASE WHEN l_linenumber % 2 = 0 THEN 'DIVIDEND' ELSE 'unspecified' END AS purpose FROM ({dirty}) d WHERE l_orderkey % 7 <> 0) a
    JOIN (SELECT symbol, min(symbol_id) AS symbol_id FROM ({symbols}) s GROUP BY symbol) t ON t.symbol = a.symbol""")
def action_lookup(spark, sf_dir):
    """Corporate actions with the id of their ticker; unknown tickers are left out."""
    known, _ = upsert.with_ids(parse_actions(spark, sf_dir).select("symbol", "ex_date", "purpose").distinct(), upsert.ticker_ids(view(spark, sf_dir, "symbols")), "symbol")
    return known


@registered("SELECT concat('X', CAST(n_nationkey AS VARCHAR)) AS isin, (SELECT max(c_custkey) FROM customer) + row_number() OVER (ORDER BY concat('X', CAST(n_nationkey AS VARCHAR))) AS symbol_id FROM nation")
def new_symbol_ids(spark, sf_dir):
    rows = query(spark, sf_dir, "SELECT concat('X', CAST(n_nationkey AS STRING)) AS isin FROM {nation}")
    return upsert.new_symbol_ids(view(spark, sf_dir, "symbols"), rows)


# --- calendar and status

_WEEKDAYS = "SELECT CAST(d AS DATE) AS trade_date FROM range(DATE '{a}', DATE '{b}' + INTERVAL 1 DAY, INTERVAL 1 DAY) r(d) WHERE isodow(CAST(d AS DATE)) < 6"
_SETTLED = "SELECT data_date FROM ({log}) l WHERE status IN ('loaded', 'no_data')"


def _span(a: str, b: str) -> str:
    return _WEEKDAYS.replace("{a}", a).replace("{b}", b)


@registered(f"SELECT trade_date FROM ({_span('1998-03-21', '1998-03-31')}) w WHERE trade_date NOT IN ({_SETTLED})")
def outstanding_dates(spark, sf_dir):
    return calendar.outstanding_dates(spark, view(spark, sf_dir, "log"), "daily", TODAY)


@registered(f"SELECT trade_date FROM ({_span('1998-01-01', '1998-03-31')}) w WHERE trade_date NOT IN ({_SETTLED}) ORDER BY trade_date DESC LIMIT 15")
def backfill_worklist(spark, sf_dir):
    return calendar.backfill_worklist(spark, view(spark, sf_dir, "log"), "daily", START, TODAY, 15)


@registered(f"""
    SELECT w.trade_date, CASE WHEN t.trade_date IS NULL THEN CASE WHEN date_diff('day', w.trade_date, DATE '1998-03-31') <= 3 THEN 'failed' ELSE 'no_data' END WHEN g.trade_date IS NULL THEN 'failed'
           WHEN g.n_delivery > 0 THEN 'loaded' WHEN date_diff('day', w.trade_date, DATE '1998-03-31') <= 3 THEN 'partial' ELSE 'loaded' END AS status, CAST(coalesce(g.n, 0) AS INTEGER) AS rows_loaded, t.trade_date IS NULL AND date_diff('day', w.trade_date, DATE '1998-03-31') <= 3 AS pending
    FROM ({_span('1998-01-01', '1998-03-31')}) w
    LEFT JOIN (SELECT DISTINCT trade_date FROM ({{bars}}) b) t ON t.trade_date = w.trade_date
    LEFT JOIN (SELECT trade_date, count(*) AS n, count(deliv_pct) AS n_delivery FROM ({{bars}}) b WHERE trade_date NOT IN (SELECT trade_date FROM ({_BATCH}) f) GROUP BY trade_date) g ON g.trade_date = w.trade_date""")
def load_status(spark, sf_dir):
    return ingest.load_status(calendar.candidate_dates(spark, START, TODAY), view(spark, sf_dir, "bars"), F.lit(TODAY))


_ASSESSED = f"""
    SELECT w.trade_date, l.status, CASE WHEN l.status IN ('loaded', 'partial', 'no_data') THEN 'ok' WHEN m.published IS NULL THEN 'UNVERIFIED' WHEN m.published THEN 'STALE' ELSE 'ok' END AS verdict
    FROM ({_span('1998-03-01', '1998-03-30')}) w LEFT JOIN ({{log}}) l ON l.data_date = w.trade_date LEFT JOIN ({{manifest}}) m ON m.trade_date = w.trade_date"""


def _freshness(spark, sf_dir):
    log, manifest = views(spark, sf_dir, "log", "manifest")
    return audit.freshness(spark, log, manifest, "daily", TODAY, 30)


@registered(_ASSESSED)
def freshness(spark, sf_dir):
    return _freshness(spark, sf_dir)


@registered(f"SELECT CASE WHEN count(*) FILTER (verdict = 'STALE') > 0 THEN 7 WHEN count(*) FILTER (verdict = 'UNVERIFIED') > 0 THEN 8 ELSE 0 END AS exit_code FROM ({_ASSESSED}) a")
def freshness_verdict(spark, sf_dir):
    return audit.overall(_freshness(spark, sf_dir))


@registered("SELECT max(data_date) AS last_loaded FROM ({log}) l WHERE source = 'daily' AND status = 'loaded'")
def last_loaded(spark, sf_dir):
    return calendar.last_loaded(view(spark, sf_dir, "log"), "daily")


@registered("""
    SELECT CAST(o_orderdate AS DATE) AS trade_date, count(*) AS total, count(*) FILTER (o_orderstatus = 'O') AS active, count(*) FILTER (o_orderstatus = 'F') AS succeeded, count(*) FILTER (o_orderstatus = 'P') AS failed
    FROM orders GROUP BY 1""")
def run_counts(spark, sf_dir):
    runs = query(spark, sf_dir, "SELECT CAST(o_orderdate AS DATE) AS trade_date, CASE WHEN o_orderstatus = 'O' THEN 'queued' ELSE 'completed' END AS status, CASE o_orderstatus WHEN 'F' THEN 'success' END AS conclusion FROM {orders}")
    return audit.run_counts(runs)


@registered("""
    SELECT symbol_id, CAST(c.d AS DATE) AS chunk_start, CAST(least(c.d + INTERVAL 30 DAY, b) AS DATE) AS chunk_end
    FROM (SELECT symbol_id, min(snapshot_date) AS a, max(snapshot_date) AS b FROM ({snapshots}) s GROUP BY symbol_id) w, LATERAL (SELECT unnest(range(CAST(a AS TIMESTAMP), CAST(b AS TIMESTAMP) + INTERVAL 1 DAY, INTERVAL 31 DAY)) AS d) c""")
def date_chunks(spark, sf_dir):
    spans = view(spark, sf_dir, "snapshots").groupBy("symbol_id").agg(F.min("snapshot_date").alias("a"), F.max("snapshot_date").alias("b"))
    return calendar.split_window(spans, "a", "b", 30).select("symbol_id", "chunk_start", "chunk_end")


# --- audits


_DIFFER = "(SELECT count(*) FROM (({a}) EXCEPT ALL ({b})) x) + (SELECT count(*) FROM (({b}) EXCEPT ALL ({a})) y)"


def _compared(name: str, a: str, b: str) -> str:
    return f"SELECT '{name}' AS table_name, CASE WHEN {_DIFFER.format(a=a, b=b)} = 0 THEN 'identical' ELSE 'changed' END AS verdict"


@registered(" UNION ALL ".join((
    _compared("bars", "SELECT * FROM ({bars}) p", "SELECT * REPLACE (CASE WHEN symbol_id = 1 THEN close + 1 ELSE close END AS close) FROM ({bars}) p"),
    _compared("log", "SELECT * FROM ({log}) p", "SELECT * FROM ({log}) q ORDER BY data_date"),
    _compared("orders", "SELECT * FROM orders", "SELECT * FROM orders ORDER BY o_totalprice"),
)))
def fingerprint_compare(spark, sf_dir):
    """The same rows in another order are identical; one changed close is not."""
    bars, log = views(spark, sf_dir, "bars", "log")
    orders = query(spark, sf_dir, "SELECT * FROM {orders}")
    edited = bars.withColumn("close", F.when((F.col("symbol_id") == 1), F.col("close") + 1).otherwise(F.col("close")))
    def prints(b: DataFrame, o: DataFrame) -> DataFrame:
        return audit.fingerprint(b, "bars", b.columns, "trade_date").unionByName(audit.fingerprint(log, "log", log.columns, "data_date")).unionByName(audit.fingerprint(o, "orders", sorted(o.columns), "o_orderdate"))

    return audit.compare_fingerprints(prints(bars.withColumn("close", F.col("close").cast("double")), orders), prints(edited.withColumn("close", F.col("close").cast("double")), orders.repartition(3)))


@registered("""
    SELECT coalesce(b.name, a.name) AS table_name, CASE WHEN a.name IS NULL THEN 'gone' WHEN b.name IS NULL AND a.n = 0 THEN 'new, empty' WHEN b.name IS NULL THEN 'new, not empty' WHEN a.n = b.n AND a.h = b.h THEN 'identical' ELSE 'changed' END AS verdict
    FROM (SELECT 'log' AS name, count(*) AS n, sum(hash(l)) AS h FROM ({log}) l UNION ALL SELECT 'orders', count(*), sum(hash(o_orderkey)) FROM orders) b
    FULL JOIN (SELECT 'log' AS name, count(*) AS n, sum(hash(l)) AS h FROM ({log}) l UNION ALL SELECT 'empty', count(*), sum(hash(o_orderkey)) FROM orders WHERE o_orderkey IS NULL UNION ALL SELECT 'added', count(*), sum(hash(o_orderkey)) FROM orders) a ON a.name = b.name""")
def fingerprint_new_tables(spark, sf_dir):
    log = view(spark, sf_dir, "log")
    orders = query(spark, sf_dir, "SELECT o_orderkey, o_custkey FROM {orders}")
    one = lambda df, name: audit.fingerprint(df, name, df.columns, df.columns[0])
    before = one(log, "log").unionByName(one(orders, "orders"))
    return audit.compare_fingerprints(before, one(log.repartition(3), "log").unionByName(one(orders.limit(0), "empty")).unionByName(one(orders, "added")))


@registered("SELECT * FROM (SELECT 'ohlc' AS rule, count(*) AS n FROM ({bars}) b WHERE high < low OR high < open OR high < close OR low > open OR low > close UNION ALL SELECT 'positive', count(*) FROM ({bars}) b WHERE open <= 0 OR close <= 0 UNION ALL SELECT 'volume', count(*) FROM ({bars}) b WHERE volume < 0) v WHERE n > 0")
def constraint_violations(spark, sf_dir):
    return quality.violations(view(spark, sf_dir, "bars"), quality.bar_constraints(), ("symbol_id", "trade_date", "series"))


@registered("""
    SELECT * FROM (
        SELECT 'membership' AS table_name, 'range' AS rule, count(*) AS n FROM ({intervals}) i WHERE symbol_id % 5 = 0
        UNION ALL SELECT 'membership', 'not_null', count(*) FROM ({intervals}) i WHERE symbol_id % 7 = 0 AND symbol_id % 5 <> 0
        UNION ALL SELECT 'log', 'status', count(*) FROM ({log}) l WHERE status = 'partial'
        UNION ALL SELECT 'log', 'unique', count(*) FROM (SELECT data_date FROM ({log_events}) e GROUP BY data_date HAVING count(*) > 1) u
        UNION ALL SELECT 'findings', 'severity', count(*) FROM ({log}) l WHERE status = 'failed'
        UNION ALL SELECT 'factors', 'positive', count(*) FROM ({adjusted}) a WHERE close = 0
        UNION ALL SELECT 'actions', 'unique', count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_partkey, l_shipdate HAVING count(*) > 1) u
        UNION ALL SELECT 'symbols', 'not_null', count(*) FROM ({symbols}) s WHERE symbol_id % 9 = 0) v
    WHERE n > 0""")
def table_constraints(spark, sf_dir):
    """The rule sets that are checked before a table is written, on tables with planted faults."""
    _, intervals, _ = _intervals(spark, sf_dir)
    log, events, adjusted, symbols = views(spark, sf_dir, "log", "log_events", "adjusted", "symbols")
    day = F.col("valid_from")
    faulty = {
        "membership": intervals.select("symbol_id", "series", F.when((F.col("symbol_id") % 7 != 0) | (F.col("symbol_id") % 5 == 0), day).alias("valid_from"), F.when(F.col("symbol_id") % 5 == 0, F.date_sub(day, 1)).otherwise(F.col("valid_to")).alias("valid_to")),
        "log": log.withColumn("status", F.when(F.col("status") == "partial", "unknown").otherwise(F.col("status"))),
        "findings": log.select(F.when(F.col("status") == "failed", "fatal").otherwise("error").alias("severity")),
        "factors": adjusted.select("symbol_id", "trade_date", F.col("close").alias("factor")),
        "actions": query(spark, sf_dir, "SELECT l_partkey AS symbol_id, CAST(l_shipdate AS DATE) AS ex_date, 'SPLIT' AS purpose, 'x' AS source FROM {lineitem}"),
        "symbols": symbols.withColumn("symbol", F.when(F.col("symbol_id") % 9 != 0, F.col("symbol"))),
    }
    parts = [quality.violations(df, quality.CONSTRAINTS[name](), quality.UNIQUE[name]).select(F.lit(name).alias("table_name"), "rule", "n") for name, df in faulty.items()]
    parts.append(quality.violations(events, {}, quality.UNIQUE["log"]).select(F.lit("log").alias("table_name"), "rule", "n"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@registered("SELECT 'daybook_nation' AS table_name, count(*) AS n FROM nation UNION ALL SELECT 'daybook_events', count(*) FROM events UNION ALL SELECT 'orders', count(*) FROM orders")
def table_counts(spark, sf_dir):
    """Rows of the tables and paths that are there; those that are not are skipped."""
    for name in ("nation", "events"):
        query(spark, sf_dir, f"SELECT * FROM {{{name}}}").createOrReplaceTempView(f"daybook_{name}")
    out = audit.table_counts(spark, ["daybook_nation", "daybook_absent", "daybook_events", f"{sf_dir}/orders.parquet", f"{sf_dir}/absent.parquet"])
    return out.withColumn("table_name", F.regexp_replace("table_name", r".*/(\w+)\.parquet", "$1"))


@registered()
def footprint(spark, sf_dir):
    """Bytes of the line items' files, by their listing, against an allowance of twice as many rows of 100 bytes."""
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return audit.footprint(landing.manifest(spark, f"{sf_dir}/lineitem.parquet"), F.lit(200 * items.count()))


@registered("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 4 <> 0)")
def orphans(spark, sf_dir):
    child = query(spark, sf_dir, "SELECT o_orderkey, o_custkey FROM {orders}")
    parent = query(spark, sf_dir, "SELECT c_custkey AS o_custkey FROM {customer} WHERE c_custkey % 4 <> 0")
    return quality.orphans(child, parent, "o_custkey").select("o_orderkey", "o_custkey")


@registered("""
    SELECT concat('f', CAST(symbol_id AS VARCHAR)) AS file, CASE WHEN symbol_id % 9 = 8 THEN 0 ELSE n END AS n_rows,
           CASE WHEN symbol_id % 9 = 4 THEN 'missing columns' WHEN symbol_id % 9 = 8 THEN 'no rows' WHEN symbol_id % 9 = 2 THEN 'wrong date' WHEN n < 960 THEN 'too few rows' ELSE 'ready' END AS verdict
    FROM (SELECT symbol_id, count(*) AS n FROM ({bars}) b GROUP BY symbol_id) g""")
def file_completeness(spark, sf_dir):
    """One delivery file for each symbol, as lines."""
    bars = view(spark, sf_dir, "bars")
    head = F.when(F.col("symbol_id") % 9 == 4, F.lit("SYMBOL, SERIES, DATE1")).otherwise(F.lit("SYMBOL, SERIES, DATE1, DELIV_PER"))
    day = F.when(F.col("symbol_id") % 9 == 2, F.lit("14-MAR-1998")).otherwise(F.lit("15-Mar-1998"))
    name = F.concat(F.lit("f"), F.col("symbol_id").cast("string"))
    headers = bars.select(name.alias("file"), F.lit(0).cast("long").alias("line_no"), head.alias("line")).distinct()
    rows = bars.filter("symbol_id % 9 <> 8").select(name.alias("file"), (F.date_diff("trade_date", F.lit(date(1990, 1, 1))) + 1).cast("long").alias("line_no"), F.concat(F.lit("X, EQ, "), day, F.lit(", 1")).alias("line"))
    return files.file_verdict(headers.unionByName(rows).withColumn("expected", F.lit(DAY)), 960)


@registered(f"""
    SELECT CAST(17 AS BIGINT) AS run_id, count(*) FILTER (status IN ('loaded', 'partial')) AS n_loaded, count(*) FILTER (status = 'no_data') AS n_no_data, count(*) FILTER (status = 'failed' AND NOT pending) AS n_failed,
           count(*) FILTER (pending) AS n_pending, count(*) FILTER (status = 'partial') AS n_partial, min(trade_date) FILTER (status = 'failed' AND NOT pending) AS first_failed, CAST(sum(rows_loaded) AS BIGINT) AS bars_written,
           (SELECT count(*) FROM ({{symbols}}) y) AS universe_symbols, (SELECT count(*) FROM ({{adjusted}}) a) AS adjusted_bars_written, (SELECT count(*) FROM ({{adjusted}}) a WHERE close > 0) AS factors_written,
           (SELECT count(*) FROM ({_BATCH}) f) AS n_findings, (SELECT count(*) FROM ({_BATCH}) f WHERE severity = 'error') AS n_errors,
           CASE WHEN EXISTS (SELECT 1 FROM ({_BATCH}) f WHERE severity = 'error') THEN 'halted' ELSE 'succeeded' END AS run_status
    FROM ({ORACLES['load_status']}) s""")
def run_summary(spark, sf_dir):
    bars, symbols, adjusted = views(spark, sf_dir, "bars", "symbols", "adjusted")
    status = ingest.load_status(calendar.candidate_dates(spark, START, TODAY), bars, F.lit(TODAY))
    out = ingest.run_summary(status, quality.batch_findings(bars), F.lit(17).cast("long"), universe_symbols=symbols, adjusted_bars_written=adjusted, factors_written=adjusted.filter("close > 0"))
    size = lambda c: F.size(f"dates_{c}").cast("long").alias(f"n_{c}")
    return out.select("run_id", *map(size, ("loaded", "no_data", "failed", "pending", "partial")), F.get("dates_failed", F.lit(0)).alias("first_failed"), "bars_written", "universe_symbols", "adjusted_bars_written", "factors_written", "n_findings", "n_errors", "run_status")


@registered(f"SELECT CAST(r_regionkey AS BIGINT) AS run_id, CASE WHEN r_regionkey = 4 THEN 'failed' WHEN r_regionkey IN (SELECT symbol_id FROM ({_BATCH}) f WHERE severity = 'error') THEN 'halted' ELSE 'succeeded' END AS status, CASE WHEN r_regionkey = 4 THEN 'no listing' ELSE '' END AS notes FROM region")
def recorded_runs(spark, sf_dir):
    """A run for each region, over the findings of one symbol; the last one breaks."""
    folder, bars = _folder(spark), view(spark, sf_dir, "bars")
    ticks = iter(datetime(2020, 1, 1) + timedelta(seconds=k) for k in range(1000))
    for region in query(spark, sf_dir, "SELECT r_regionkey FROM {region} ORDER BY 1").collect():
        def work(number=region["r_regionkey"]) -> DataFrame:
            if number == 4:
                raise ValueError("no listing")
            return quality.batch_findings(bars.filter(F.col("symbol_id") == number))

        try:
            ingest.recorded_run(spark, f"{folder}/runs", region["r_regionkey"], work, lambda: next(ticks))
        except ValueError:
            pass
    return ingest.run_state(ingest.events_table(spark, f"{folder}/runs").read()).select("run_id", "status", "notes")


@registered(f"SELECT run_id, check_name, count(*) AS n FROM (SELECT CAST(1 AS BIGINT) AS run_id, check_name FROM ({_BATCH}) f WHERE symbol_id < 10 UNION ALL SELECT 2, check_name FROM ({_BATCH}) f WHERE symbol_id >= 10) u GROUP BY ALL")
def appended_findings(spark, sf_dir):
    """The findings of two runs, one appended after the other; the first one is replayed, which appends nothing."""
    folder, bars = _folder(spark), view(spark, sf_dir, "bars")
    for run, which in ((1, "symbol_id < 10"), (2, "symbol_id >= 10"), (1, "symbol_id < 10")):
        ingest.append_findings(quality.batch_findings(bars.filter(which)), run, f"{folder}/findings")
    return ingest.findings_table(spark, f"{folder}/findings").read().groupBy("run_id", "check_name").agg(F.count("*").alias("n"))


@registered("SELECT o_custkey AS run_id, arg_max(o_orderstatus, o_orderkey) AS status, min(o_orderkey) AS started FROM orders GROUP BY o_custkey")
def run_state(spark, sf_dir):
    events = query(spark, sf_dir, "SELECT o_custkey AS run_id, o_orderkey AS event_time, o_orderstatus AS status, o_orderpriority AS notes FROM {orders}")
    return ingest.run_state(events).select("run_id", "status", "started")


@registered("SELECT event_id, left(trim(replace(replace(concat('a ', event_type, ' ', props), '@', ''), '`', '')), 300) AS detail, left(replace(props, 'k', '***'), 200) AS hidden, concat(CAST(event_id AS VARCHAR), '|', event_type) AS row_text FROM events")
def clean_detail(spark, sf_dir):
    e = query(spark, sf_dir, "SELECT * FROM {events}")
    dirty = F.concat(F.lit("\ta@`\n"), "event_type", F.lit("\x07"), "props", F.lit("@ "))
    return e.select("event_id", C.plain_detail(dirty).alias("detail"), C.redacted(F.col("props"), "k").alias("hidden"), C.row_key(F.col("event_id"), F.col("event_type")).alias("row_text"))


# --- landed files: one for each month of line items, in a folder; headers differ, and some files are broken

_FILE_DAY = "CAST(date_trunc('month', ship_date) AS DATE)"
_FAULT = "CASE month(ship_date) WHEN 5 THEN 'no column CLOSE_PRICE' WHEN 7 THEN 'open quote' WHEN 9 THEN 'no rows' END"
_GOOD = "month(ship_date) NOT IN (5, 7, 9)"
#: Rows of line items for each archive that a month is cut into, so that an archive has about 25,000 rows.
_ARCHIVED = 2_000_000
#: The same for each file that a month is cut into, so that a file has about 200,000 lines; and rows for each task that writes files.
_FILED, _WRITTEN = 16_000_000, 200_000
_BY_MONTH = (r"file=daily_(\d{8})/", "ddMMyyyy")


def _landed_files(spark: SparkSession, sf_dir: str, unique: bool = False, cut: bool = False) -> str:
    """The folder: every third file has its columns in another order, others pad their headers. unique: a symbol and series once a file. cut: a month of a large table is in several files.

    A task sorts what it writes, so tasks grow in number with the rows.
    """
    names = ("SYMBOL", "SERIES", "DATE1", "OPEN_PRICE", "HIGH_PRICE", "LOW_PRICE", "CLOSE_PRICE", "TTL_TRD_QNTY", "DELIV_QTY", "DELIV_PER")
    folder = f"{_folder(spark)}/landed"
    d = query(spark, sf_dir, f"SELECT *, {_FILE_DAY} AS file_day, month(ship_date) AS m, year(ship_date) AS y FROM ({{dirty}}) d")
    n = d.count()
    parts = 1 + n // _FILED if cut else 1
    if unique:
        first = F.min_by(F.struct(*d.columns), F.struct("l_orderkey", "l_linenumber", "whole_price", "l_quantity", "ship_date"))
        d = d.groupBy(F.col("file_day").alias("_day"), F.col("l_partkey").alias("_part"), F.col("l_returnflag").alias("_flag")).agg(first.alias("d")).select("d.*")
    turned = (F.col("m") + F.col("y")) % 3 == 0
    quoted = F.concat(F.lit('"'), "price_text", F.lit('"'))
    day = F.when(F.col("m") % 6 == 2, F.lit("01-Jan-1990")).otherwise(F.date_format("file_day", "dd-MMM-yyyy"))
    cells = {"SYMBOL": F.col("symbol_text"), "SERIES": F.col("series_text"), "DATE1": day, **dict.fromkeys(names[3:7], quoted), "TTL_TRD_QNTY": F.col("qty_text"), "DELIV_QTY": F.lit(" - "), "DELIV_PER": F.lit("40.5")}
    line = F.when(turned, F.concat_ws(",", *(cells[n] for n in names[::-1]))).otherwise(F.concat_ws(",", *(cells[n] for n in names)))
    line = F.when((F.col("m") == 7) & (F.col("l_linenumber") == 1), F.concat(line, F.lit(',"x'))).otherwise(line)
    head = F.when(turned, F.lit(",".join(names[::-1]))).otherwise(F.lit(", ".join(names)))
    head = F.when(F.col("m") == 5, F.replace(head, F.lit("CLOSE_PRICE"), F.lit("CLOSE"))).otherwise(head)
    if parts > 1:  # a file need not have one of the lines that leave a quote open
        head = F.when(F.col("m") == 7, F.concat(head, F.lit(',"x'))).otherwise(head)
    name = F.concat(F.lit("daily_"), F.date_format("file_day", "ddMMyyyy"))
    part = F.pmod(F.xxhash64("l_orderkey", "l_linenumber"), F.lit(parts)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    heads = d.select("file_day", "m", "y").distinct().select(name.alias("file"), every.alias("part"), F.lit(0).alias("at"), head.alias("line"))
    lines = heads.unionByName(d.filter("m <> 9").select(name.alias("file"), part.alias("part"), F.lit(1).alias("at"), line.alias("line")))
    by = ["file", "part"] if parts > 1 else ["file"]
    lines.repartition(8 + n // _WRITTEN, *by).sortWithinPartitions(*by, "at").select(*by, "line").write.partitionBy(*by).text(folder)
    return folder


@registered(f"""
    SELECT concat('SYM', CAST(l_partkey AS VARCHAR)) AS symbol, CASE l_returnflag WHEN 'A' THEN 'EQ' ELSE 'BE' END AS series, {_FILE_DAY} AS trade_date, whole_price + 0.5 AS close, CAST(l_quantity AS BIGINT) AS volume, 40.5 AS deliv_pct
    FROM ({{dirty}}) d WHERE l_returnflag <> 'R' AND l_orderkey % 11 <> 0 AND l_orderkey % 13 <> 0 AND l_orderkey % 17 <> 0 AND {_GOOD}""")
def mixed_files(spark, sf_dir):
    """The bars of all files that can be read, whatever the order of their columns."""
    read = landing.delivery_read(landing.landed_lines(spark, _landed_files(spark, sf_dir, cut=True)), _BY_MONTH)
    return landing.taken(read).select("symbol", "series", "trade_date", "close", "volume", "deliv_pct")


@registered(f"""
    SELECT DISTINCT 'delivery' AS kind, {_FILE_DAY} AS trade_date, {_FAULT} AS error FROM ({{dirty}}) d WHERE {_FAULT} IS NOT NULL
    UNION ALL SELECT DISTINCT 'archive', {_FILE_DAY}, CASE month(ship_date) WHEN 3 THEN 'unreadable: BadZipFile' ELSE 'no .csv entry' END FROM ({{dirty}}) d WHERE month(ship_date) IN (3, 4)""")
def files_refused(spark, sf_dir):
    """What is wrong with which file: delivery files of a folder, and archives of which some are cut short or empty. A month of a large table is in several archives."""
    read = landing.delivery_read(landing.landed_lines(spark, _landed_files(spark, sf_dir)), _BY_MONTH)
    d = query(spark, sf_dir, f"SELECT l_orderkey, l_linenumber, symbol_text, {_FILE_DAY} AS file_day FROM ({{dirty}}) d")
    parts = 1 + d.count() // _ARCHIVED
    part = F.pmod(F.xxhash64("l_orderkey", "l_linenumber"), F.lit(parts)).alias("part")
    d = d.select(F.date_format("file_day", "yyyyMMdd").alias("day"), part, F.col("symbol_text").alias("TckrSymb"), *(F.lit(c).alias(c) for c in landing.UDIFF_NEEDS if c != "TckrSymb"))
    archives = d.groupBy("day", "part").applyInPandas(_zipped, "path string, content binary")
    cut = F.when(F.col("path").rlike(r"0301_F\.zip"), F.substring("content", 1, 60)).when(F.col("path").rlike(r"0401_F\.zip"), F.unhex(F.lit("504B0506" + "00" * 18))).otherwise(F.col("content"))
    bad = landing.refused(landing.udiff_read(archives.withColumn("content", cut), (r"_(\d{8})_F", "yyyyMMdd")).select("path", "error"))
    bad = bad.select(F.lit("archive").alias("kind"), landing.dated(F.col("path"), (r"_(\d{8})_F", "yyyyMMdd")).alias("trade_date"), "error").distinct()
    return landing.refused(read).select(F.lit("delivery").alias("kind"), landing.dated(F.col("path"), _BY_MONTH).alias("trade_date"), "error").unionByName(bad)


@registered(f"""
    SELECT {_FILE_DAY} AS trade_date, CASE WHEN month(ship_date) = 9 THEN 0 ELSE count(*) END AS n_rows,
           CASE WHEN month(ship_date) = 9 THEN 'no rows' WHEN month(ship_date) % 6 = 2 THEN 'wrong date' WHEN count(*) < 700 THEN 'too few rows' ELSE 'ready' END AS verdict
    FROM ({{dirty}}) d GROUP BY {_FILE_DAY}, month(ship_date)""")
def landed_completeness(spark, sf_dir):
    """Is each landed file whole, as read from its lines?"""
    out = landing.verdicts(landing.landed(spark, _landed_files(spark, sf_dir)), _BY_MONTH, 700)
    return out.select(landing.dated(F.col("file"), _BY_MONTH).alias("trade_date"), "n_rows", "verdict")


@registered(f"""
    SELECT w.trade_date, l.status, CASE WHEN l.status IN ('loaded', 'partial', 'no_data') THEN 'ok' WHEN w.trade_date IN (SELECT {_FILE_DAY} FROM ({{dirty}}) d) THEN 'STALE' ELSE 'ok' END AS verdict
    FROM (SELECT CAST(d AS DATE) AS trade_date FROM range(DATE '1997-01-01', DATE '1998-04-01', INTERVAL 1 DAY) r(d) WHERE isodow(CAST(d AS DATE)) < 6) w LEFT JOIN ({{log}}) l ON l.data_date = w.trade_date""")
def landed_freshness(spark, sf_dir):
    """Published is what the listing of the folder has; no file is opened."""
    expected = calendar.candidate_dates(spark, date(1997, 1, 1), TODAY)
    files_there = landing.manifest(spark, _landed_files(spark, sf_dir), _BY_MONTH)
    return audit.assess(expected, view(spark, sf_dir, "log"), landing.published(expected, files_there), "daily")


@registered(f"""
    SELECT w.trade_date, CASE WHEN g.n IS NULL AND x.day IS NOT NULL THEN 'failed' WHEN g.n IS NULL AND date_diff('day', w.trade_date, DATE '1998-03-31') <= 3 THEN 'failed' WHEN g.n IS NULL THEN 'no_data' WHEN g.repeats THEN 'failed' ELSE 'loaded' END AS status
    FROM (SELECT CAST(d AS DATE) AS trade_date FROM range(DATE '1995-01-01', DATE '1998-04-01', INTERVAL 1 DAY) r(d) WHERE isodow(CAST(d AS DATE)) < 6) w
    LEFT JOIN (SELECT day, sum(k) AS n, max(k) > 1 OR month(day) % 6 = 2 AS repeats FROM (
                   SELECT {_FILE_DAY} AS day, l_partkey, CASE l_returnflag WHEN 'A' THEN 'EQ' ELSE 'BE' END AS series, count(*) AS k
                   FROM ({{dirty}}) d WHERE l_returnflag <> 'R' AND l_orderkey % 11 <> 0 AND l_orderkey % 13 <> 0 AND l_orderkey % 17 <> 0 AND {_GOOD} GROUP BY ALL) k GROUP BY day) g ON g.day = w.trade_date
    LEFT JOIN (SELECT DISTINCT {_FILE_DAY} AS day FROM ({{dirty}}) d WHERE {_FAULT} IS NOT NULL) x ON x.day = w.trade_date""")
def landed_status(spark, sf_dir):
    """A refused file fails its date, at any age, and no other."""
    read = landing.delivery_read(landing.landed_lines(spark, _landed_files(spark, sf_dir)), _BY_MONTH)
    bars = landing.taken(read).withColumn("symbol_id", F.regexp_extract("symbol", r"(\d+)", 1).cast("long"))
    expected = calendar.candidate_dates(spark, date(1995, 1, 1), TODAY)
    return ingest.load_status(expected, bars, F.lit(TODAY), landing.refused(read).select("trade_date")).select("trade_date", "status")


@registered(f"""
    SELECT {_FILE_DAY} AS trade_date, count(*) AS n FROM ({{dirty}}) d
    WHERE l_returnflag <> 'R' AND l_orderkey % 11 <> 0 AND l_orderkey % 13 <> 0 AND l_orderkey % 17 <> 0 AND {_GOOD} GROUP BY 1""")
def stream_landed_files(spark, sf_dir):
    """The folder as a stream of files, parsed batch by batch; a second run finds nothing new."""
    folder, out = _landed_files(spark, sf_dir), _folder(spark)

    def each(rows: DataFrame, _: int) -> None:
        read = landing.taken(landing.delivery_read(rows, _BY_MONTH))
        read.groupBy("trade_date").agg(F.count("*").alias("n")).write.mode("append").parquet(f"{out}/counts")

    for _ in range(2):
        feeds.run_available(feeds.landed_lines(spark, folder, 20), f"{out}/state", each).awaitTermination()
    return spark.read.parquet(f"{out}/counts")


@registered(f"""
    WITH first AS (SELECT *, {_FILE_DAY} AS day, CASE l_returnflag WHEN 'A' THEN 'EQ' ELSE 'BE' END AS kept FROM (
                       SELECT *, row_number() OVER (PARTITION BY {_FILE_DAY}, l_partkey, l_returnflag ORDER BY l_orderkey, l_linenumber, whole_price, l_quantity, ship_date) AS n FROM ({{dirty}}) d) r WHERE n = 1),
         good AS (SELECT day, count(*) FILTER (concat('SYM', CAST(l_partkey AS VARCHAR)) IN (SELECT symbol FROM ({{symbols}}) s)) AS n
                  FROM first WHERE l_returnflag <> 'R' AND l_orderkey % 11 <> 0 AND l_orderkey % 13 <> 0 AND l_orderkey % 17 <> 0 AND month(day) NOT IN (5, 7, 9) GROUP BY day)
    SELECT 'daily' AS source, w.trade_date AS data_date,
           CASE WHEN month(f.day) IN (5, 7, 9) OR (g.day IS NOT NULL AND month(f.day) % 6 = 2) THEN 'failed' WHEN g.day IS NOT NULL THEN 'loaded' WHEN date_diff('day', w.trade_date, DATE '1998-03-31') <= 3 THEN 'failed' ELSE 'no_data' END AS status,
           CAST(CASE WHEN g.day IS NOT NULL AND month(f.day) % 6 <> 2 THEN g.n ELSE 0 END AS INTEGER) AS rows_loaded
    FROM ({_span('1995-01-01', '1998-03-31')}) w LEFT JOIN (SELECT DISTINCT day FROM first) f ON f.day = w.trade_date LEFT JOIN good g ON g.day = w.trade_date
    UNION ALL SELECT 'universe', DATE '1998-03-31', 'loaded', CAST(count(*) AS INTEGER) FROM ({{symbols}}) s""")
def daily_run(spark, sf_dir):
    """A run over the folder: a listing, all weekdays of some years outstanding, refused and rejected files among theirs. What the log says then."""
    symbols, folder = view(spark, sf_dir, "symbols"), _folder(spark)
    rows = symbols.select((F.col("symbol_id") % 4).alias("file"), F.lit(1).alias("at"), F.concat_ws(",", "symbol", "isin", F.lit("EQ"), F.concat(F.lit('"'), "name", F.lit('"'))).alias("line"))
    heads = rows.select("file", F.lit(0).alias("at"), F.lit("SYMBOL, ISIN NUMBER, SERIES, NAME OF COMPANY").alias("line")).distinct()
    heads.unionByName(rows).repartition("file").sortWithinPartitions("file", "at").select("file", "line").write.partitionBy("file").text(f"{folder}/listing")
    landed = daily.Landed(f"{folder}/listing", _landed_files(spark, sf_dir, True), delivery_date=_BY_MONTH)
    ticks = iter(datetime(2020, 1, 1) + timedelta(seconds=k) for k in range(1000))
    daily.DailyRun(spark, f"{folder}/store", landed, TODAY, 1, (TODAY - date(1995, 1, 1)).days).run(lambda: next(ticks))
    return daily.tables(spark, f"{folder}/store")["log"].read().select("source", "data_date", "status", "rows_loaded")


# --- stored tables


_BAR_TABLE = "symbol_id long, trade_date date, series string, close double, deliv_qty long"


def _stored_bars(spark: SparkSession, sf_dir: str) -> tuple[Table, DataFrame]:
    """Bars of a kept close as a stored table, appended year by year."""
    bars = view(spark, sf_dir, "bars").select("symbol_id", "trade_date", "series", F.col("close").cast("double").alias("close"), "deliv_qty")
    t = Table(spark, f"{_folder(spark)}/bars", _BAR_TABLE, "bars", "trade_date")
    for year in range(1995, 2002):
        t.append(bars.filter(F.year("trade_date") == year).repartitionByRange(4, "trade_date"), str(year))
    return t, bars


@registered("SELECT symbol_id, trade_date, series, CASE WHEN trade_date = DATE '1998-03-16' THEN close + 1 ELSE close END AS close, CASE WHEN trade_date = DATE '1998-03-16' THEN coalesce(deliv_qty, 5) ELSE deliv_qty END AS deliv_qty FROM ({bars}) b")
def upsert_touched_files(spark, sf_dir):
    """A day's late figures rewrite the files that hold its keys; a year that is appended again changes nothing."""
    t, bars = _stored_bars(spark, sf_dir)
    late = bars.filter(F.col("trade_date") == F.lit(date(1998, 3, 16))).select("symbol_id", "trade_date", "series", (F.col("close") + 1).alias("close"), F.coalesce("deliv_qty", F.lit(5)).alias("deliv_qty"))
    keys, rules = upsert.RAW_BARS
    t.upsert(late, keys, rules)
    t.append(bars.filter("year(trade_date) = 1997"), "1997")
    return t.read()


@registered("""
    SELECT strftime(trade_date, '%Y-%m') AS month, count(*) AS n, min(trade_date) AS lo, max(trade_date) AS hi, strftime(trade_date, '%Y-%m') = '1998-03' AS changed
    FROM ({bars}) b GROUP BY ALL""")
def kept_digests(spark, sf_dir):
    """Counts and ends of each month, and whether an upsert has changed it, from what the versions keep: no row is read for it."""
    t, bars = _stored_bars(spark, sf_dir)
    before = t.version()
    keys, rules = upsert.RAW_BARS
    after = t.upsert(bars.filter("trade_date BETWEEN DATE '1998-03-10' AND DATE '1998-03-12'").withColumn("close", F.col("close") + 1), keys, rules)
    changed = set(t.changed_months(before, after))
    return spark.createDataFrame([(m, n, date.fromisoformat(lo), date.fromisoformat(hi), m in changed) for m, (n, lo, hi, _) in after.digests.items()], "month string, n long, lo date, hi date, changed boolean")


@registered("SELECT symbol_id, trade_date, series, rule FROM ({bars}) b, LATERAL (SELECT 'ohlc' AS rule WHERE high < low OR high < open OR high < close OR low > open OR low > close UNION ALL SELECT 'positive' WHERE open <= 0 OR close <= 0 UNION ALL SELECT 'volume' WHERE volume < 0) r")
def refused_rows(spark, sf_dir):
    """The bars that the stored table would refuse, by rule."""
    return quality.refused_rows(view(spark, sf_dir, "bars"), "bars").select("symbol_id", "trade_date", "series", "rule")


# --- streams: each is run to its end, and its result read


def _folder(spark: SparkSession) -> str:
    """A new folder in the one that the driver and all executors share; a local session may name none."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return f"{shared or 'file://' + tempfile.mkdtemp(prefix='spark-daybook-')}/stream-{uuid.uuid4().hex}"


_STORED = ("symbol_id", "trade_date", "series", "open", "high", "low", "close", "volume", "deliv_qty", "deliv_pct", "file_date")


def _landed_bars(spark: SparkSession, sf_dir: str, folder: str, raised: float = 1.0) -> DataFrame:
    """Bars as files: prices first, then delivery figures for the same keys, with prices that are raised. A file has the bars of a range of days, so that a batch of files touches the months of few."""
    bars = view(spark, sf_dir, "bars").select(*_STORED).withColumns({c: F.col(c).cast("double") for c in ("open", "high", "low", "close")})
    bars.write.parquet(f"{folder}/whole")  # worked out once for both parts
    bars = spark.read.schema(bars.schema).parquet(f"{folder}/whole")
    early = bars.withColumns({"deliv_qty": F.lit(None).cast("bigint"), "deliv_pct": F.lit(None).cast("double"), "seq": F.lit(1)})
    late = bars.filter("deliv_qty IS NOT NULL").withColumns({"close": F.col("close") + raised, "seq": F.lit(2)})
    for part in (early, late):
        part.repartitionByRange("trade_date", "symbol_id").write.mode("append").parquet(f"{folder}/landed")
    return feeds.landed(spark, f"{folder}/landed", spark.read.parquet(f"{folder}/landed").schema, 8)


#: What a stored bar becomes: as in RAW_BARS, and the file's date with the prices.
_BAR_RULES = {**upsert.RAW_BARS[1], "file_date": "new"}


@registered("SELECT symbol_id, trade_date, series, CAST(close AS DOUBLE) + CASE WHEN deliv_qty IS NULL THEN 0 ELSE 1 END AS close, deliv_qty FROM ({bars}) b")
def stream_upsert(spark, sf_dir):
    folder = _folder(spark)
    stream = _landed_bars(spark, sf_dir, folder)
    schema = stream.drop("seq").schema
    feeds.upsert_stream(spark, stream, f"{folder}/bars", schema, f"{folder}/state", upsert.RAW_BARS[0], {c: r for c, r in _BAR_RULES.items() if c in schema.names}, ("seq",)).awaitTermination()
    return spark.read.parquet(f"{folder}/bars").select("symbol_id", "trade_date", "series", "close", "deliv_qty")


@registered(f"""
    SELECT 'daily' AS source, b.trade_date AS data_date,
           CASE WHEN b.trade_date IN (SELECT trade_date FROM ({_BATCH}) f) THEN 'failed' WHEN count(deliv_pct) > 0 THEN 'loaded' WHEN date_diff('day', b.trade_date, DATE '2001-11-04') <= 3 THEN 'partial' ELSE 'loaded' END AS status,
           CAST(CASE WHEN b.trade_date IN (SELECT trade_date FROM ({_BATCH}) f) THEN 0 ELSE count(*) END AS INTEGER) AS rows_loaded
    FROM ({{bars}}) b GROUP BY b.trade_date""")
def stream_enrich(spark, sf_dir):
    """Bars land without delivery figures, which follow for some. A second run, years later and without a new file, settles the dates that were open."""
    folder = _folder(spark)
    stream = _landed_bars(spark, sf_dir, folder, 0.0)
    schema = stream.drop("seq").schema
    for today in (TODAY, date(2001, 11, 4)):
        feeds.enrich_available(spark, stream, f"{folder}/bars", schema, f"{folder}/log", f"{folder}/state", upsert.RAW_BARS[0], {c: r for c, r in _BAR_RULES.items() if c in schema.names}, ("seq",), F.lit(today), "daily")
    return spark.read.parquet(f"{folder}/log").select("source", "data_date", "status", "rows_loaded")


@registered("SELECT CAST(1 + event_id % 2 AS INTEGER) AS run, count(*) AS n FROM events GROUP BY 1")
def stream_files_once(spark, sf_dir):
    """Two runs over one checkpoint: the second reads only the files that landed after the first."""
    folder = _folder(spark)
    e = query(spark, sf_dir, "SELECT event_id, value FROM {events}")
    for run in (1, 2):
        e.filter(F.col("event_id") % 2 == run - 1).write.mode("append").parquet(f"{folder}/events")
        stream = feeds.landed(spark, f"{folder}/events", e.schema)
        feeds.run_available(stream, f"{folder}/state", lambda rows, _, run=run: rows.withColumn("run", F.lit(run)).write.mode("append").parquet(f"{folder}/out")).awaitTermination()
    return spark.read.parquet(f"{folder}/out").groupBy("run").agg(F.count("*").alias("n"))


def _drained(spark: SparkSession, out: DataFrame, folder: str) -> DataFrame:
    """The rows an append stream gives when its input has been read."""
    out.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/out-state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(out.schema).parquet(f"{folder}/out")


def _event_files(spark: SparkSession, sf_dir: str, folder: str, twice: bool) -> DataFrame:
    e = query(spark, sf_dir, "SELECT event_id, CAST(ts AS TIMESTAMP) AS ts, value FROM {events}")
    for _ in range(2 if twice else 1):
        e.write.mode("append").parquet(f"{folder}/events")
    return feeds.landed(spark, f"{folder}/events", e.schema, 10)


@registered("SELECT event_id, CAST(ts AS DATE) AS day FROM events")
def stream_dedupe(spark, sf_dir):
    """Every event lands twice and is kept once."""
    folder = _folder(spark)
    kept = feeds.without_repeats(_event_files(spark, sf_dir, folder, True), ["event_id"], "ts", "60 days")
    return _drained(spark, kept, folder).select("event_id", F.to_date("ts").alias("day"))


@registered("SELECT CAST(ts AS DATE) AS trade_date, count(*) AS n_rows, count(value) AS n_values FROM events GROUP BY 1 HAVING CAST(ts AS DATE) + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 3 DAY FROM events)")
def stream_daily(spark, sf_dir):
    """Days that the watermark has passed; later ones are still open."""
    folder = _folder(spark)
    return _drained(spark, feeds.daily_rollup(_event_files(spark, sf_dir, folder, False), "ts"), folder)
