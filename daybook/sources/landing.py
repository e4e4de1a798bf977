"""Landed files, each read for itself: a file's fault stays with the file.

A folder is read as rows of (path, content), so that its files may be of any kind, have any header and be
broken. Readers give their rows with a column `error`: null for a row that was read, and for a file that
is refused one row with the reason and nothing else. `taken` and `refused` part them. Nothing loops over
files; files whose headers differ are parsed in one plan, by positions that each file's own header gives.

Readers of CSV files also take a folder as rows of (path, at, line), see landed_lines: then no file is held
whole, and the lines of one are spread over tasks. What is to be known of a file before its lines are cut
(header, faults) is one row a file, found in a pass of its own.

Files over MOST_BYTES are refused by their listed size and never read, if they are read whole. Files of no
bytes are not listed by Spark: they have not landed yet.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.columns import blank_to_null, clean, csv_cells, dashed_date, lakh_to_rupee, to_double
from .files import DELIVERY_HEADERS, LISTING_HEADERS, UDIFF_HEADERS, candle_columns, file_verdict, whole_bars

MOST_BYTES = 256 << 20
#: Where the names of daily files have their date, and how it is written there.
DELIVERY_DATE, UDIFF_DATE = (r"(\d{8})\D*$", "ddMMyyyy"), (r"(\d{8})[^/]*$", "yyyyMMdd")
ISIN_NAME = r"([A-Z]{2}[A-Z0-9]{9}\d)[^/]*$"

UNDATED = "no date in its name"

DELIVERY_NEEDS = ("SYMBOL", "SERIES", "OPEN_PRICE", "HIGH_PRICE", "LOW_PRICE", "CLOSE_PRICE", "TTL_TRD_QNTY")
UDIFF_NEEDS = ("FinInstrmTp", "TckrSymb", "SctySrs", "OpnPric", "HghPric", "LwPric", "ClsPric", "TtlTradgVol")
LISTING_NEEDS = ("SYMBOL", "ISIN NUMBER")


def dated(path: Column, where: tuple[str, str]) -> Column:
    """The date in a path by (pattern, format); null if there is none."""
    return F.try_to_date(F.nullif(F.regexp_extract(path, where[0], 1), F.lit("")), where[1])


def manifest(spark: SparkSession, path: str, where: tuple[str, str] = DELIVERY_DATE) -> DataFrame:
    """path, size, modified, trade_date of every file, from the listing alone."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"), dated(F.col("path"), where).alias("trade_date"))


def published(expected: DataFrame, files: DataFrame) -> DataFrame:
    """trade_date, published: whether a file has landed for it; files is a manifest."""
    of = files.select("trade_date").filter("trade_date IS NOT NULL").distinct().withColumn("_landed", F.lit(True))
    return expected.join(of, "trade_date", "left").select("trade_date", F.coalesce("_landed", F.lit(False)).alias("published"))


def landed(spark: SparkSession, path: str | list[str], most_bytes: int = MOST_BYTES) -> DataFrame:
    """path, content of every file below path (or paths); the content of files over most_bytes is null, and is not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    small = files.filter(F.col("length") <= most_bytes).select("path", "content")
    return small.unionByName(files.filter(F.col("length") > most_bytes).select("path", F.lit(None).cast("binary").alias("content")))


def landed_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """path, at, line of every file below path (or paths), for files of any size. at is where the part of the file begins that its line was read in."""
    return lines_of_text(spark.read.option("recursiveFileLookup", "true").text(path, lineSep="\n"))


def lines_of_text(text: DataFrame) -> DataFrame:
    """path, at, line of rows of Spark's text source, also of a stream of it. Spark leaves out a byte order mark."""
    line = F.make_valid_utf8("value")
    line = F.when(line.endswith("\r"), F.left(line, F.length(line) - 1)).otherwise(line)
    return text.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"), line.alias("line"))


def taken(read: DataFrame) -> DataFrame:
    return read.filter("error IS NULL").drop("error")


def refused(read: DataFrame) -> DataFrame:
    """path, error of the files that were refused; with their trade_date, if the reader has one."""
    return read.filter("error IS NOT NULL").select("path", *(c for c in ("trade_date",) if c in read.columns), "error")


def text_of(content: Column) -> Column:
    """Bytes as text, without a byte order mark; what is not UTF-8 is replaced."""
    return F.regexp_replace(F.make_valid_utf8(content.cast("string")), "^﻿", "")


def _odd_quotes(line: Column) -> Column:
    return F.contains(line, F.lit('"')) & ((F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))) % 2 == 1)


def _header_columns(header: Column, names: Sequence[str], needs: Sequence[str]) -> tuple[Column, Column]:
    """(where each of `names` is in a header of cells, 0 or null for nowhere; which of `needs` it lacks)."""
    trimmed = F.transform(header, lambda c: F.trim(c))
    at = F.array(*(F.coalesce(*(F.nullif(F.array_position(c, name), F.lit(0)) for c in (header, trimmed))) for name in names))
    return at, F.filter(F.array(*map(F.lit, needs)), lambda n: ~F.array_contains(trimmed, n))


def csv_rows(files: DataFrame, names: Sequence[str], needs: Sequence[str], keep: Mapping[str, Column] | None = None, fault: Column | None = None) -> DataFrame:
    """path, the columns `keep` (made of the path), error and the text columns `names` of CSV files (path, content) or their lines (path, at, line). fault: what else a file is refused for.

    A header names the cells, blanks around it not counting; a name with none is preferred to one with
    some. Files are refused that are too large, empty or no text, that lack a column of `needs`, that
    leave a quote open, or that have no rows. Short lines lack their last cells; names that a file does not have are null.
    Of files given as lines, lines that repeat the header are no rows.
    """
    keep = keep or {}
    fault = F.lit(None).cast("string") if fault is None else fault
    lines = _file_lines(files, names, needs, keep, fault) if "content" in files.columns else _spread_lines(files, names, needs, keep, fault)
    # The cells of a line come out of an explosion, so that a filter on them does not cut them again.
    rows = lines.select("path", *keep, "error", "_at", F.explode(F.array(csv_cells(F.col("line")))).alias("_cells"))
    return rows.select("path", *keep, "error", *(F.get("_cells", (F.get("_at", F.lit(k)) - 1).cast("int")).alias(n) for k, n in enumerate(names)))


def _file_lines(files: DataFrame, names: Sequence[str], needs: Sequence[str], keep: Mapping[str, Column], fault: Column) -> DataFrame:
    """path, keep, error, _at and line of every line below the header of files that are read whole; a refused file is one row without line."""
    out = files.select("path", *(c.alias(n) for n, c in keep.items()), text_of(F.col("content")).alias("_text")).withColumn("_lines", F.split("_text", "\r?\n"))
    out = out.withColumn("_header", csv_cells(F.get("_lines", F.lit(0))))
    at, lacks = _header_columns(F.col("_header"), names, needs)
    body = F.filter(F.slice("_lines", 2, F.greatest(F.size("_lines"), F.lit(1))), lambda line: F.trim(line) != "")
    out = out.withColumns({"_at": at, "_body": body, "_lacks": lacks})
    error = (
        F.when(F.col("_text").isNull(), "too large")
        .when(F.col("_text").rlike(r"\A\s*\z"), "empty")
        .when(F.contains("_text", F.lit("\0")), "no text")
        .when(F.size("_lacks") > 0, F.concat(F.lit("no column "), F.array_join("_lacks", ", ")))
        .when(F.contains("_text", F.lit('"')) & F.exists("_lines", _odd_quotes), "open quote")
        .when(F.size("_body") == 0, "no rows")
        .otherwise(fault)
    )
    rows = out.select("path", *keep, error.alias("error"), "_at", "_body")
    return rows.select("path", *keep, "error", "_at", F.explode(F.when(F.col("error").isNull(), F.col("_body")).otherwise(F.array(F.lit(None).cast("string")))).alias("line"))


#: What is seen in a line, as bits.
_NUL, _ODD, _FILLED = 1, 2, 4


def file_facts(lines: DataFrame, names: Sequence[str], needs: Sequence[str], keep: Mapping[str, Column], fault: Column) -> DataFrame:
    """path, keep, error, _at, _head (the header's line) of each file of which these are the lines: one row a file."""
    bit = lambda when, n: F.when(when, n).otherwise(0)
    line = F.col("line")
    seen = lines.select("path", "at", "line", F.monotonically_increasing_id().alias("_n"))
    # The lines of one part of a file are numbered upwards, so the least number of its first part is the header's.
    facts = seen.groupBy("path").agg(
        F.min_by("line", F.when(F.col("at") == 0, F.col("_n"))).alias("_head"), F.count_if(F.trim("line") != "").alias("_filled"),
        F.collect_set(bit(F.contains(line, F.lit("\0")), _NUL) + bit(_odd_quotes(line), _ODD) + bit(line.rlike(r"\S"), _FILLED)).alias("_seen"),  # some of eight numbers
    )
    has = lambda n: F.exists("_seen", lambda s: s.bitwiseAND(n) > 0)
    at, lacks = _header_columns(F.col("_cells"), names, needs)
    facts = facts.withColumns({**keep, "_cells": csv_cells(F.col("_head"))}).withColumns({"_at": at, "_lacks": lacks})
    error = (
        F.when(~has(_FILLED), "empty")
        .when(has(_NUL), "no text")
        .when(F.size("_lacks") > 0, F.concat(F.lit("no column "), F.array_join("_lacks", ", ")))
        .when(has(_ODD), "open quote")
        .when(F.col("_filled") == F.when(F.trim("_head") != "", 1).otherwise(0), "no rows")
        .otherwise(fault)
    )
    return facts.select("path", *keep, error.alias("error"), "_at", "_head")


def _spread_lines(lines: DataFrame, names: Sequence[str], needs: Sequence[str], keep: Mapping[str, Column], fault: Column) -> DataFrame:
    """As _file_lines, from lines: each meets the row of its file, so that lines of one file are cut in many tasks."""
    facts = file_facts(lines, names, needs, keep, fault)
    good = facts.filter("error IS NULL").select("path", *keep, "_at", "_head")
    body = lines.join(F.broadcast(good), "path").filter((F.trim("line") != "") & (F.col("line") != F.col("_head")))
    # Each part says what its error is, so that `taken` reads no row of refused files and `refused` no line.
    body = body.select("path", *keep, F.lit(None).cast("string").alias("error"), "_at", "line")
    return body.unionByName(facts.filter("error IS NOT NULL").select("path", *keep, F.coalesce("error", F.lit("")).alias("error"), "_at", F.lit(None).cast("string").alias("line")))


def delivery_read(files: DataFrame, where: tuple[str, str] = DELIVERY_DATE) -> DataFrame:
    """path, error and the bars of daily delivery files (path, content) or their lines (path, at, line), whatever their headers' order; the trade date is the path's. Files without a date in their path are refused."""
    raw = csv_rows(files, DELIVERY_HEADERS, DELIVERY_NEEDS, {"_day": dated(F.col("path"), where)}, F.when(F.col("_day").isNull(), UNDATED))
    named = {"open": "OPEN_PRICE", "high": "HIGH_PRICE", "low": "LOW_PRICE", "close": "CLOSE_PRICE", "volume": "TTL_TRD_QNTY", "prev_close": "PREV_CLOSE", "last_price": "LAST_PRICE", "turnover": "TURNOVER_LACS", "trades": "NO_OF_TRADES", "deliv_qty": "DELIV_QTY", "deliv_pct": "DELIV_PER"}
    rows = raw.select(
        "path", "error", clean(F.col("SYMBOL")).alias("symbol"), F.lit(None).cast("string").alias("isin"), clean(F.col("SERIES")).alias("series"),
        F.col("_day").alias("trade_date"), dashed_date(F.col("DATE1")).alias("file_date"), *(F.col(c).alias(n) for n, c in named.items()),
    )
    return whole_bars(rows, {n: F.col(n) for n in named}, ("path", "error")).withColumn("turnover", lakh_to_rupee(F.col("turnover")))


def _archived(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The rows of the first .csv entry of each archive, all of them or none: an archive that cannot be read to its end gives one row with its error."""
    columns = [*UDIFF_HEADERS, "path", "error"]
    for batch in batches:
        for path, content, fault in zip(batch["path"], batch["content"], batch["fault"]):
            parts: list[pd.DataFrame] = []
            try:
                if fault is not None:
                    raise ValueError(fault)
                if content is None:
                    raise ValueError("too large")
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    entry = next((n for n in archive.namelist() if n.lower().endswith(".csv")), None)
                    if entry is None:
                        raise ValueError("no .csv entry")
                    with archive.open(entry) as lines:
                        for part in pd.read_csv(lines, dtype=str, keep_default_na=False, skipinitialspace=True, encoding_errors="replace", chunksize=50_000):
                            part.columns = [c.strip() for c in part.columns]
                            lacks = [c for c in UDIFF_NEEDS if c not in part.columns]
                            if lacks:
                                raise ValueError(f"no column {', '.join(lacks)}")
                            parts.append(part.reindex(columns=list(UDIFF_HEADERS)).assign(path=path, error=None))
                if not sum(map(len, parts)):
                    raise ValueError("no rows")
            except Exception as error:  # whatever is wrong with an archive is that archive's
                parts = [pd.DataFrame([{"path": path, "error": str(error) if type(error) is ValueError else f"unreadable: {type(error).__name__}"}])]
            for part in parts:
                yield part.reindex(columns=columns).astype(object).where(lambda x: x.notna(), None)


def udiff_read(archives: DataFrame, where: tuple[str, str] = UDIFF_DATE) -> DataFrame:
    """path, error and the bars of zipped daily files (path, content): stocks only, with their ISIN."""
    day = dated(F.col("path"), where)
    raw = archives.select("path", "content", F.when(day.isNull(), UNDATED).alias("fault")).mapInPandas(_archived, ", ".join(f"{c} string" for c in (*UDIFF_HEADERS, "path", "error")))
    named = {"open": "OpnPric", "high": "HghPric", "low": "LwPric", "close": "ClsPric", "volume": "TtlTradgVol", "prev_close": "PrvsClsgPric", "last_price": "LastPric", "turnover": "TtlTrfVal", "trades": "TtlNbOfTxsExctd"}
    rows = raw.filter("error IS NOT NULL OR trim(FinInstrmTp) = 'STK'").select(
        "path", "error", clean(F.col("TckrSymb")).alias("symbol"), blank_to_null(F.col("ISIN")).alias("isin"), clean(F.col("SctySrs")).alias("series"),
        day.alias("trade_date"), F.try_to_date(clean(F.col("TradDt")), "yyyy-MM-dd").alias("file_date"), *(F.col(c).alias(n) for n, c in named.items()),
    )
    return whole_bars(rows, {n: F.col(n) for n in named}, ("path", "error"))


def listing_read(files: DataFrame) -> DataFrame:
    """path, error, symbol, name, series, listing_date, isin, face_value of listings (path, content) or their lines (path, at, line)."""
    raw = csv_rows(files, LISTING_HEADERS, LISTING_NEEDS)
    out = raw.select(
        "path", "error", clean(F.col("SYMBOL")).alias("symbol"), clean(F.col("NAME OF COMPANY")).alias("name"), clean(F.col("SERIES")).alias("series"),
        dashed_date(F.col("DATE OF LISTING")).alias("listing_date"), clean(F.col("ISIN NUMBER")).alias("isin"), to_double(F.col("FACE VALUE")).alias("face_value"),
    )
    return out.filter("error IS NOT NULL OR (isin <> '' AND symbol <> '')")


def candle_read(files: DataFrame) -> DataFrame:
    """path, error and adjusted bars of JSON files that are named by their ISIN. Bodies without candles are refused; short and unreadable candles are left out."""
    text = files.select("path", text_of(F.col("content")).alias("_body"))
    isin = F.nullif(F.regexp_extract("path", ISIN_NAME, 1), F.lit(""))
    found = F.from_json("_body", "struct<data:struct<candles:array<array<string>>>>")["data"]["candles"]
    text = text.withColumn("error", F.when(F.col("_body").isNull(), "too large").when(found.isNull(), "no candles").when(isin.isNull(), "no ISIN in its name"))
    bad = text.filter("error IS NOT NULL").select("path", "error")
    good = candle_columns(text.filter("error IS NULL"), "_body", isin, ("path",))
    return good.withColumn("error", F.lit(None).cast("string")).unionByName(bad, allowMissingColumns=True)


def lines_of(files: DataFrame, where: tuple[str, str] = DELIVERY_DATE) -> DataFrame:
    """file, line_no (0: header), line, expected (the date in its path): what file_verdict reads, from files (path, content)."""
    text = files.select("path", dated(F.col("path"), where).alias("expected"), F.split(text_of(F.col("content")), "\r?\n").alias("lines"))
    rows = text.select(F.col("path").alias("file"), "expected", F.posexplode_outer("lines").alias("line_no", "line"))
    return rows.select("file", F.coalesce("line_no", F.lit(0)).cast("long").alias("line_no"), F.coalesce("line", F.lit("")).alias("line"), "expected")


def verdicts(files: DataFrame, where: tuple[str, str] = DELIVERY_DATE, least_rows: int = 500) -> DataFrame:
    """file, n_rows, verdict of landed delivery files: one that is whole is ready."""
    return file_verdict(lines_of(files, where), least_rows)
