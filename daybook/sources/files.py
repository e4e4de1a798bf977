"""Landed market files as DataFrames: one scan over a directory, never a loop over days."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator, Mapping
from functools import reduce
from operator import and_

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.columns import SERIES, blank_to_null, by_header, candle_date, clean, csv_cells, dashed_date, field, first_filled, lakh_to_rupee, to_double

LISTING_HEADERS = ("SYMBOL", "NAME OF COMPANY", "SERIES", "DATE OF LISTING", "PAID UP VALUE", "MARKET LOT", "ISIN NUMBER", "FACE VALUE")
DELIVERY_HEADERS = ("SYMBOL", "SERIES", "DATE1", "PREV_CLOSE", "OPEN_PRICE", "HIGH_PRICE", "LOW_PRICE", "LAST_PRICE", "CLOSE_PRICE", "AVG_PRICE", "TTL_TRD_QNTY", "TURNOVER_LACS", "NO_OF_TRADES", "DELIV_QTY", "DELIV_PER")
BAR = ("symbol", "isin", "series", "trade_date", "file_date", "open", "high", "low", "close", "prev_close", "last_price", "volume", "turnover", "trades", "deliv_qty", "deliv_pct")


def _csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text. Files of one scan whose headers differ are refused, not mixed up."""
    return spark.read.csv(path, header=True, inferSchema=False, enforceSchema=False, ignoreLeadingWhiteSpace=True)


def listing(spark: SparkSession, path: str) -> DataFrame:
    return listing_columns(_csv(spark, path))


def listing_columns(raw: DataFrame) -> DataFrame:
    """symbol, name, series, listing_date, isin, face_value; rows without ISIN or symbol are left out."""
    raw = by_header(raw)
    out = raw.select(
        clean(field(raw, "SYMBOL")).alias("symbol"), clean(field(raw, "NAME OF COMPANY")).alias("name"), clean(field(raw, "SERIES")).alias("series"),
        dashed_date(field(raw, "DATE OF LISTING")).alias("listing_date"), clean(field(raw, "ISIN NUMBER")).alias("isin"), to_double(field(raw, "FACE VALUE")).alias("face_value"),
    )
    return out.filter((F.col("isin") != "") & (F.col("symbol") != ""))


#: The numbers of a bar in the order that they are read in; the first five must be there.
NUMBERS = ("open", "high", "low", "close", "volume", "prev_close", "last_price", "turnover", "trades", "deliv_qty", "deliv_pct")
WHOLE = ("volume", "trades", "deliv_qty")


def whole_bars(rows: DataFrame, cells: Mapping[str, Column], also: tuple[str, ...] = ()) -> DataFrame:
    """Bars of rows (symbol, isin, series, trade_date, file_date), with numbers read from text cells, and the columns `also`; rows with an `error` among those are kept as they are.

    Kept are bars of a kept series, complete in prices and volume. The numbers of a row come out of an
    explosion, so that a filter on them does not read them again; rows of other series are left out before.
    """
    kept = lambda rule: rule | F.col("error").isNotNull() if "error" in also else rule
    read = F.array(*(to_double(cells[n]) if n in cells else F.lit(None).cast("double") for n in NUMBERS))
    rows = rows.filter(kept((F.col("symbol") != "") & F.col("series").isin(*SERIES)))
    rows = rows.select(*also, "symbol", "isin", "series", "trade_date", "file_date", F.explode(F.array(read)).alias("_n"))
    # Beyond 64 bits a volume is no number.
    there = reduce(and_, (F.coalesce(F.abs(F.get("_n", F.lit(k))) < 2.0**63, F.lit(False)) for k in range(5)))
    rows = rows.filter(kept(there))
    number = {n: F.get("_n", F.lit(k)) for k, n in enumerate(NUMBERS)}
    number |= {n: number[n].try_cast("bigint") for n in WHOLE}
    return rows.select(*also, *BAR[:5], *(number[n].alias(n) for n in BAR[5:]))


def delivery_columns(raw: DataFrame, trade_date) -> DataFrame:
    """Bars from a delivery file's text columns, complete in prices and volume and of a kept series."""
    raw = by_header(raw)
    named = {"open": "OPEN_PRICE", "high": "HIGH_PRICE", "low": "LOW_PRICE", "close": "CLOSE_PRICE", "volume": "TTL_TRD_QNTY", "prev_close": "PREV_CLOSE", "last_price": "LAST_PRICE", "turnover": "TURNOVER_LACS", "trades": "NO_OF_TRADES", "deliv_qty": "DELIV_QTY", "deliv_pct": "DELIV_PER"}
    cells = {n: field(raw, c) for n, c in named.items()}
    rows = raw.select(
        clean(field(raw, "SYMBOL")).alias("symbol"), F.lit(None).cast("string").alias("isin"), clean(field(raw, "SERIES")).alias("series"),
        trade_date.alias("trade_date"), dashed_date(field(raw, "DATE1")).alias("file_date"), *(c.alias(n) for n, c in cells.items()),
    )
    out = whole_bars(rows, {n: F.col(n) for n in cells})
    return out.withColumn("turnover", lakh_to_rupee(F.col("turnover")))


def delivery_bars(spark: SparkSession, path: str) -> DataFrame:
    """Daily delivery files; the trade date is the last ddMMyyyy in the file's name."""
    name = F.regexp_extract(F.col("_metadata.file_name"), r"(\d{8})\D*$", 1)
    raw = _csv(spark, path)
    return delivery_columns(raw.select("*", F.try_to_date(name, "ddMMyyyy").alias("_trade_date")), F.col("_trade_date"))


#: What is read of the zipped daily files.
UDIFF_HEADERS = ("TradDt", "FinInstrmTp", "ISIN", "TckrSymb", "SctySrs", "OpnPric", "HghPric", "LwPric", "ClsPric", "LastPric", "PrvsClsgPric", "TtlTradgVol", "TtlTrfVal", "TtlNbOfTxsExctd")


def _unzipped(files: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The rows of the first .csv entry of each archive; an archive without one gives no rows."""
    for batch in files:
        for path, content in zip(batch["path"], batch["content"]):
            with zipfile.ZipFile(io.BytesIO(content)) as archive:
                entry = next((n for n in archive.namelist() if n.lower().endswith(".csv")), None)
                if entry is None:
                    continue
                with archive.open(entry) as lines:
                    for part in pd.read_csv(lines, dtype=str, keep_default_na=False, skipinitialspace=True, chunksize=50_000):
                        part.columns = [c.strip() for c in part.columns]
                        yield part.reindex(columns=list(UDIFF_HEADERS)).assign(path=path).astype(object)


def udiff_bars(spark: SparkSession, path: str) -> DataFrame:
    return udiff_columns(spark.read.format("binaryFile").load(path))


def udiff_columns(archives: DataFrame) -> DataFrame:
    """Zipped daily files (path, content): stocks only, with their ISIN; delivery columns are null. The trade date is the name's first yyyyMMdd."""
    raw = archives.select("path", "content").mapInPandas(_unzipped, ", ".join(f"{c} string" for c in (*UDIFF_HEADERS, "path")))
    stocks = raw.filter(clean(F.col("FinInstrmTp")) == "STK")
    name = F.regexp_extract(F.element_at(F.split("path", "/"), -1), r"(\d{8})", 1)
    named = {"open": "OpnPric", "high": "HghPric", "low": "LwPric", "close": "ClsPric", "volume": "TtlTradgVol", "prev_close": "PrvsClsgPric", "last_price": "LastPric", "turnover": "TtlTrfVal", "trades": "TtlNbOfTxsExctd"}
    rows = stocks.select(
        clean(F.col("TckrSymb")).alias("symbol"), blank_to_null(F.col("ISIN")).alias("isin"), clean(F.col("SctySrs")).alias("series"),
        F.try_to_date(name, "yyyyMMdd").alias("trade_date"), F.try_to_date(clean(F.col("TradDt")), "yyyy-MM-dd").alias("file_date"), *(F.col(c).alias(n) for n, c in named.items()),
    )
    return whole_bars(rows, {n: F.col(n) for n in named})


ACTION = "array<struct<symbol:string,comp:string,exDate:string,faceVal:string,isin:string,subject:string,purpose:string>>"


def action_columns(text: DataFrame, body: str = "value") -> DataFrame:
    """Corporate actions in JSON arrays of objects; texts that are no such array give no rows."""
    rows = text.select(F.explode(F.from_json(body, ACTION)).alias("a")).select("a.*")
    out = rows.select(
        first_filled(F.col("symbol"), F.col("comp")).alias("symbol"), blank_to_null(F.col("isin")).alias("isin"), dashed_date(F.col("exDate")).alias("ex_date"),
        F.coalesce(first_filled(F.col("subject"), F.col("purpose")), F.lit("unspecified")).alias("purpose"), to_double(F.col("faceVal")).alias("face_value"),
    )
    return out.filter(F.col("symbol").isNotNull() & F.col("ex_date").isNotNull())


def corporate_actions(spark: SparkSession, path: str) -> DataFrame:
    return action_columns(spark.read.text(path, wholetext=True))


def candle_columns(text: DataFrame, body: str, isin, also: tuple[str, ...] = ()) -> DataFrame:
    """Adjusted bars in nested arrays [timestamp, open, high, low, close, volume, ...], with the columns `also`; short and unreadable ones are left out."""
    parsed = F.from_json(body, "struct<data:struct<candles:array<array<string>>>>")
    rows = text.select(*also, isin.alias("isin"), F.explode(parsed["data"]["candles"]).alias("c")).filter(F.size("c") >= 6)
    # The numbers are read in one expression, as in whole_bars.
    rows = rows.select(*also, "isin", candle_date(F.get("c", F.lit(0))).alias("trade_date"), F.transform(F.slice("c", 2, 5), to_double).alias("_n"))
    rows = rows.filter(F.col("isin").isNotNull() & F.col("trade_date").isNotNull() & F.forall("_n", lambda x: x.isNotNull() & (F.abs(x) < 2.0**63)))
    number = lambda k: F.get("_n", F.lit(k))
    return rows.select(*also, "isin", "trade_date", *(number(k).alias(n) for k, n in enumerate(("open", "high", "low", "close"))), number(4).try_cast("bigint").alias("volume"))


def candles(spark: SparkSession, path: str) -> DataFrame:
    """One file for each ISIN, named by it; oldest first within an ISIN."""
    name = F.regexp_extract(F.col("_metadata.file_name"), r"([A-Z]{2}[A-Z0-9]{9}\d)", 1)
    text = spark.read.text(path, wholetext=True).select("value", name.alias("_isin"))
    return candle_columns(text, "value", F.col("_isin")).orderBy("isin", "trade_date")


def first_source(first: DataFrame, second: DataFrame) -> DataFrame:
    """The rows of the first source, and those of the second for trade dates that the first has none of. Only the first one's dates are read twice."""
    return first.unionByName(second.join(first.select("trade_date").distinct(), "trade_date", "left_anti"))


def preferred_by_date(first: DataFrame, second: DataFrame) -> DataFrame:
    """first_source with `origin`, which says where a row is from."""
    return first_source(first.withColumn("origin", F.lit(1)), second.withColumn("origin", F.lit(2)))


def missing_dates(expected: DataFrame, bars: DataFrame) -> DataFrame:
    """Expected trade dates for which no source has a row."""
    return expected.join(bars.select("trade_date").distinct(), "trade_date", "left_anti")


def series_profile(raw: DataFrame, series: str = "series") -> DataFrame:
    """Rows for each series; a missing column counts as the empty series."""
    return raw.groupBy((clean(F.col(series)) if series in raw.columns else F.lit("")).alias("series")).agg(F.count("*").alias("n"))


def file_verdict(lines: DataFrame, least_rows: int = 500) -> DataFrame:
    """Is a landed delivery file complete? lines: file, line_no (0: header), line, expected date.

    The reasons come in this order: a header that lacks DATE1 or DELIV_PER, no rows, a first row of
    another date, too few rows; else "ready".
    """
    cells = F.transform(csv_cells(F.col("line")), lambda c: F.trim(c))
    header = lines.filter("line_no = 0").select("file", "expected", cells.alias("header"))
    header = header.select("file", "expected", F.array_position("header", "DATE1").alias("at"), (F.array_contains("header", "DATE1") & F.array_contains("header", "DELIV_PER")).alias("whole"))
    rows = lines.filter((F.col("line_no") > 0) & (F.trim("line") != "")).select("file", "line_no", cells.alias("cells"))
    body = rows.groupBy("file").agg(F.count("*").alias("n_rows"), F.min_by("cells", "line_no").alias("first"))
    out = header.join(body, "file", "left").withColumn("n_rows", F.coalesce("n_rows", F.lit(0)))
    first = dashed_date(F.get("first", F.col("at").cast("int") - 1))
    verdict = F.when(~F.col("whole"), "missing columns").when(F.col("n_rows") == 0, "no rows").when(~first.eqNullSafe(F.col("expected")), "wrong date").when(F.col("n_rows") < least_rows, "too few rows").otherwise("ready")
    return out.select("file", "n_rows", verdict.alias("verdict"))


