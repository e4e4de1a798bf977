import io
import os
import zipfile
from datetime import date

from daybook.operators import audit, ingest
from daybook.sources import landing
from pyspark.sql import functions as F

HEAD = "SYMBOL, SERIES, DATE1, PREV_CLOSE, OPEN_PRICE, HIGH_PRICE, LOW_PRICE, LAST_PRICE, CLOSE_PRICE, AVG_PRICE, TTL_TRD_QNTY, TURNOVER_LACS, NO_OF_TRADES, DELIV_QTY, DELIV_PER".split(",")
ROW = "{s}, EQ, {d}-Mar-2024, 99, 100, 110, 95, 104, {c}, 101, 1000, 1.5, 10, 400, 40.0".split(",")
UDIFF = "TradDt,FinInstrmTp,ISIN,TckrSymb,SctySrs,OpnPric,HghPric,LwPric,ClsPric,LastPric,PrvsClsgPric,TtlTradgVol,TtlTrfVal,TtlNbOfTxsExctd\n"


def delivery(day, symbols, order=None, quoted=False):
    order = order or range(len(HEAD))
    lines = [",".join(HEAD[k] for k in order)]
    for k, s in enumerate(symbols):
        cells = [c.format(s=s, d=day, c=105 + k) for c in ROW]
        if quoted:
            cells[10] = '"1,000"'
        lines.append(",".join(cells[k] for k in order))
    return "\r\n".join(lines) + "\r\n"


def zipped(text, name="DAY.CSV"):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        if text is not None:
            z.writestr(name, text)
    return out.getvalue()


def delivery_folder(tmp_path):
    folder = tmp_path / "daily"
    folder.mkdir()
    put = lambda name, text: (folder / name).write_bytes(text if isinstance(text, bytes) else text.encode())
    put("full_11032024.csv", delivery(11, ["AAA", "BBB"]))
    put("full_12032024.csv", delivery(12, ["AAA", "BBB"], order=[1, 0, *range(14, 1, -1)]))  # other order
    put("full_13032024.csv", "﻿" + delivery(13, ["CCC"], quoted=True).replace("SYMBOL", "SYMBOL  "))
    put("full_14032024.csv", delivery(14, ["AAA"], order=range(13)))  # no delivery columns: still bars
    put("full_15032024.csv", "<html>not found</html>\n<p>")
    put("full_16032024.csv", " \n")
    put("full_17032024.csv", "")  # no bytes: not landed
    put("full_18032024.csv", delivery(18, []))
    put("full_19032024.csv", delivery(19, ["AAA", 'B"BB']))
    put("full_20032024.csv", b"\0\1\2" + delivery(20, ["AAA"]).encode())
    put("full_21032024.csv", b"SYMBOL, SERIES, OPEN_PRICE, HIGH_PRICE, LOW_PRICE, CLOSE_PRICE, TTL_TRD_QNTY\nA\xff\xfe, EQ, 1, 2, 1, 2, 5\nSHORT, EQ, 1\n")
    put("undated.csv", delivery(11, ["AAA"]))
    return str(folder)


def test_mixed_folder_of_delivery_files(spark, tmp_path):
    read = landing.delivery_read(landing.landed(spark, delivery_folder(tmp_path)))
    got = sorted((r["trade_date"].day, r["symbol"], r["close"], r["volume"], r["deliv_qty"], r["turnover"]) for r in landing.taken(read).collect())
    whole = lambda d, s, c: (d, s, c, 1000, 400, 150000.0)
    assert got[:5] == [whole(11, "AAA", 105.0), whole(11, "BBB", 106.0), whole(12, "AAA", 105.0), whole(12, "BBB", 106.0), whole(13, "CCC", 105.0)]
    assert got[5][:5] == (14, "AAA", 105.0, 1000, None) and got[6][0] == 21 and got[6][2:5] == (2.0, 5, None) and len(got) == 7
    bad = {r["path"].rsplit("/", 1)[1]: r["error"] for r in landing.refused(read).collect()}
    assert bad == {
        "full_15032024.csv": "no column SYMBOL, SERIES, OPEN_PRICE, HIGH_PRICE, LOW_PRICE, CLOSE_PRICE, TTL_TRD_QNTY", "full_16032024.csv": "empty",
        "full_18032024.csv": "no rows", "full_19032024.csv": "open quote", "full_20032024.csv": "no text", "undated.csv": "no date in its name",
    }


def test_one_scan_whatever_the_headers(spark, tmp_path):
    """One plan without joins, however many kinds of headers."""
    read = landing.taken(landing.delivery_read(landing.landed(spark, delivery_folder(tmp_path))))
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan and "PushedFilters" in plan


def test_size_limit_is_kept_without_reading(spark, tmp_path):
    folder = delivery_folder(tmp_path)
    read = landing.delivery_read(landing.landed(spark, folder, most_bytes=300))
    bad = {r["path"].rsplit("/", 1)[1]: r["error"] for r in landing.refused(read).collect()}
    assert bad["full_11032024.csv"] == "too large" and bad["full_16032024.csv"] == "empty"


def test_archives_fail_alone(spark, tmp_path):
    folder = tmp_path / "z"
    folder.mkdir()
    row = "2024-03-{d},{k},INE000A01011,AAA,EQ,1,2,0.5,1.5,1.5,1,100,1000,5\n"
    good = zipped(UDIFF + row.format(d=11, k="STK") + row.format(d=11, k=" IDX"))
    long = zipped(UDIFF + "".join(row.format(d=15, k="STK").replace("AAA", f"A{k * 7919 % 10007}") for k in range(5000)))
    broken = bytearray(long)
    broken[len(broken) // 2 : len(broken) // 2 + 40] = b"\0" * 40  # fails on the way, after rows were read
    files = {"11": good, "12": b"no archive", "13": zipped(None), "14": zipped("TradDt,ISIN\n1,2\n"), "15": bytes(broken), "16": zipped(UDIFF), "17": zipped(UDIFF.replace("TradDt,FinInstrmTp", " FinInstrmTp, TradDt") + row.format(d=0, k="x").replace("2024-03-0,x", "STK,2024-03-17"), "a.csv")}
    for day, content in files.items():
        (folder / f"Bhav_202403{day}_F.zip").write_bytes(content)
    read = landing.udiff_read(landing.landed(spark, str(folder)))
    assert sorted((r["trade_date"].day, r["symbol"], r["file_date"].day, r["isin"]) for r in landing.taken(read).collect()) == [(11, "AAA", 11, "INE000A01011"), (17, "AAA", 17, "INE000A01011")]
    bad = {r["trade_date"].day: r["error"] for r in landing.refused(read).collect()}
    assert bad[12] == "unreadable: BadZipFile" and bad[13] == "no .csv entry" and bad[14].startswith("no column FinInstrmTp") and bad[15].startswith("unreadable") and bad[16] == "no rows" and len(bad) == 5


def test_listing_and_candles(spark, tmp_path):
    (tmp_path / "l").mkdir()
    (tmp_path / "l" / "a.csv").write_text('ISIN NUMBER, SYMBOL,NAME OF COMPANY\nINE1,AAA,"One, Ltd"\n,BBB,x\n')
    (tmp_path / "l" / "b.csv").write_text("nothing\n1\n")
    read = landing.listing_read(landing.landed(spark, str(tmp_path / "l")))
    assert [(r["symbol"], r["name"], r["isin"], r["series"]) for r in landing.taken(read).collect()] == [("AAA", "One, Ltd", "INE1", "")]
    assert [r["error"] for r in landing.refused(read).collect()] == ["no column SYMBOL, ISIN NUMBER"]
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "INE000A01011.json").write_text('{"data":{"candles":[["2026-09-18T00:00:00+05:30",1,2,0.5,1.5,100,0],["bad"]]}}')
    (tmp_path / "c" / "INE000A01012.json").write_text('{"status":"error"}')
    (tmp_path / "c" / "other.json").write_text('{"data":{"candles":[]}}')
    read = landing.candle_read(landing.landed(spark, str(tmp_path / "c")))
    assert [(r["isin"], r["close"]) for r in landing.taken(read).collect()] == [("INE000A01011", 1.5)]
    assert sorted(r["error"] for r in landing.refused(read).collect()) == ["no ISIN in its name", "no candles"]


def test_manifest_verdicts_and_freshness(spark, tmp_path):
    folder = delivery_folder(tmp_path)
    files = landing.manifest(spark, folder)
    plan = files._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[-1]
    sizes = {r["path"].rsplit("/", 1)[1]: r["size"] for r in files.collect()}
    assert sizes["full_16032024.csv"] == 2 and sizes["full_11032024.csv"] == len(delivery(11, ["AAA", "BBB"])) and len(sizes) == 11
    got = {r["file"].rsplit("/", 1)[1]: (r["n_rows"], r["verdict"]) for r in landing.verdicts(landing.landed(spark, folder), least_rows=2).collect()}
    assert got["full_11032024.csv"] == (2, "ready") and got["full_12032024.csv"] == (2, "ready") and got["full_13032024.csv"] == (1, "too few rows")
    assert got["full_14032024.csv"][1] == "missing columns" and got["full_16032024.csv"] == (0, "missing columns") and got["full_18032024.csv"] == (0, "no rows")
    expected = spark.createDataFrame([(date(2024, 3, d),) for d in (11, 12, 16, 17, 22)], "trade_date date")
    log = spark.createDataFrame([("daily", date(2024, 3, 11), "loaded")], "source string, data_date date, status string")
    out = audit.assess(expected, log, landing.published(expected, files), "daily")
    assert {r["trade_date"].day: r["verdict"] for r in out.collect()} == {11: "ok", 12: "STALE", 16: "STALE", 17: "ok", 22: "ok"}


def test_a_refused_file_fails_its_date_only(spark, tmp_path):
    read = landing.delivery_read(landing.landed(spark, delivery_folder(tmp_path)))
    bars = landing.taken(read).withColumn("symbol_id", F.hash("symbol"))
    expected = spark.createDataFrame([(date(2024, 3, d),) for d in (11, 12, 15, 16, 22)], "trade_date date")
    out = ingest.load_status(expected, bars, F.lit(date(2024, 6, 1)), landing.refused(read).select("trade_date"))
    assert {r["trade_date"].day: (r["status"], r["rows_loaded"], r["pending"]) for r in out.collect()} == {11: ("loaded", 2, False), 12: ("loaded", 2, False), 15: ("failed", 0, False), 16: ("failed", 0, False), 22: ("no_data", 0, False)}


def test_files_as_lines_are_read_alike(spark, tmp_path):
    """A folder whose files are cut into many parts gives what it gives when each file is read whole."""
    folder = delivery_folder(tmp_path)
    (tmp_path / "daily" / "a b_22032024.csv").write_text(delivery(22, [f"S{k}" for k in range(3000)], order=[1, 0, *range(14, 1, -1)], quoted=True))
    (tmp_path / "daily" / "late_23032024.csv").write_text(delivery(23, [f"S{k}" for k in range(3000)]) + 'X, "open\n')
    (tmp_path / "daily" / "head_24032024.csv").write_bytes(b"\r\n\r\n")
    (tmp_path / "daily" / "blank_25032024.csv").write_bytes(b"\n" + delivery(25, ["AAA"]).encode())
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
        spark.conf.set("spark.sql.files.openCostInBytes", "1024")
        lines = landing.landed_lines(spark, folder)
        assert lines.filter("path LIKE '%22032024.csv'").select("at").distinct().count() > 20
        whole, spread = (landing.delivery_read(files) for files in (landing.landed(spark, folder), lines))
        for part in (landing.taken, landing.refused):
            a, b = (sorted(map(repr, part(read).drop("path" if part is landing.taken else "").collect())) for read in (whole, spread))
            assert a == b
        assert landing.taken(spread).count() == 3007
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


def test_a_file_of_any_size_is_never_one_value(spark, tmp_path):
    """No array and no binary value in the plan holds a file: lines meet one small row a file."""
    read = landing.delivery_read(landing.landed_lines(spark, delivery_folder(tmp_path)))
    plan = landing.taken(read)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "binary" not in plan.lower().replace("binaryfile", "binary file") and "\\r?\\n" not in plan and "Union" not in plan
    assert "Join" not in landing.refused(read)._jdf.queryExecution().optimizedPlan().toString()


def test_listing_as_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text('ISIN NUMBER, SYMBOL,NAME OF COMPANY\nINE1,AAA,"One, ""The"" Ltd"\n,BBB,x\n')
    (tmp_path / "b.csv").write_text("nothing\n1\n")
    read = landing.listing_read(landing.landed_lines(spark, str(tmp_path)))
    assert [(r["symbol"], r["name"], r["isin"]) for r in landing.taken(read).collect()] == [("AAA", 'One, "The" Ltd', "INE1")]
    assert [r["error"] for r in landing.refused(read).collect()] == ["no column SYMBOL, ISIN NUMBER"]


def test_cells_of_odd_lines(spark):
    """Lines of all kinds of quotes: in one match, or cell by cell."""
    from daybook.functions.columns import csv_cells

    said = {'a,"1,2",c': ["a", "1,2", "c"], ' "x"y ,z': ["x", "z"], 'a"b,c"d': ['a"b', 'c"d'], 'a"x,"b': ['a"x', ""], '"a""b",""': ['a"b', ""], '"p\x01q",r': ["p\x01q", "r"], "a,,": ["a", "", ""], '"",""': ["", ""], '$1,"\\"': ["$1", "\\"]}
    rows = spark.createDataFrame([(k,) for k in said], "line string").select("line", csv_cells(F.col("line")).alias("cells")).collect()
    assert {r["line"]: r["cells"] for r in rows} == said


def test_a_stream_of_lines_takes_each_file_once(spark, tmp_path):
    """Files cut into parts by the stream are whole in their batch: header and lines meet, and a second run finds nothing."""
    from daybook.streaming import feeds

    folder, out = delivery_folder(tmp_path), str(tmp_path / "out")
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "100")
        spark.conf.set("spark.sql.files.openCostInBytes", "10")
        for _ in range(2):
            each = lambda rows, _: landing.taken(landing.delivery_read(rows)).write.mode("append").parquet(out)
            feeds.run_available(feeds.landed_lines(spark, folder, 2), str(tmp_path / "state"), each).awaitTermination()
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert sorted((r["trade_date"].day, r["symbol"]) for r in spark.read.parquet(out).collect()) == [(11, "AAA"), (11, "BBB"), (12, "AAA"), (12, "BBB"), (13, "CCC"), (14, "AAA"), (21, "A��")]


def test_a_month_in_several_archives_is_one_fault(spark, sf_dir, monkeypatch):
    from daybook.plans import queries

    seen = []
    read = landing.udiff_read
    monkeypatch.setattr(queries, "_ARCHIVED", 1500)
    monkeypatch.setattr(landing, "udiff_read", lambda files, where: (seen.append(files), read(files, where))[1])
    got = [(r["trade_date"].year, r["trade_date"].month, r["error"]) for r in queries.files_refused(spark, sf_dir).filter("kind = 'archive'").collect()]
    assert len(got) == len(set(got)) == 14 and {m for _, m, _ in got} == {3, 4}
    paths = seen[0].filter("path LIKE '%0301_F.zip'").select("path").collect()
    assert len(paths) > 7


def test_the_daily_run_takes_the_lines_of_its_dates(spark, tmp_path):
    from daybook.operators import daily

    found = daily._files(spark, delivery_folder(tmp_path), landing.DELIVERY_DATE, [date(2024, 3, 12)], landing.landed_lines)
    assert found.columns == ["path", "at", "line"] and found.count() == 3


def test_mixed_files_cuts_files_over_tasks(spark, sf_dir):
    """The query's files are read in parts: no file is one value of one task."""
    from daybook.plans import queries

    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
        spark.conf.set("spark.sql.files.openCostInBytes", "512")
        read = queries.mixed_files(spark, sf_dir)
        assert "binary" not in read._jdf.queryExecution().executedPlan().toString().lower()
        assert read.rdd.getNumPartitions() > 2 * len(read.inputFiles()) > 100
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


def test_mixed_files_cuts_months_of_large_tables(spark, sf_dir, monkeypatch):
    """A task writes so many rows, whatever a month has: a month is several files, all of them refused if one would be."""
    from daybook.plans import queries

    whole = queries.mixed_files(spark, sf_dir)
    monkeypatch.setattr(queries, "_FILED", 1500)
    monkeypatch.setattr(queries, "_WRITTEN", 200)
    cut = queries.mixed_files(spark, sf_dir)
    assert len(cut.inputFiles()) > 3 * len(whole.inputFiles()) > 200
    rows = sorted(map(repr, cut.collect()))
    assert rows == sorted(map(repr, whole.collect())) and len(rows) > 1000
    assert max(map(os.path.getsize, (f.removeprefix("file://") for f in cut.inputFiles()))) < max(map(os.path.getsize, (f.removeprefix("file://") for f in whole.inputFiles()))) / 2
    parted = landing.refused(landing.delivery_read(landing.landed_lines(spark, queries._landed_files(spark, sf_dir, cut=True)), queries._BY_MONTH))
    assert {r["error"] for r in parted.filter("month(trade_date) = 7").collect()} == {"open quote"} and parted.filter("month(trade_date) = 7").count() > 20
