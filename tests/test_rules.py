import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from daybook.functions import columns as C
from daybook.operators import audit, calendar, ingest, quality, universe, upsert
from daybook.streaming import feeds

D = lambda d: date(2026, 9, d)
SNAPSHOT = "snapshot_date date, symbol_id long, series string, listing_date date"


def snapshots(spark, rows):
    return spark.createDataFrame([(D(d), s, x, None) for d, s, x in rows], SNAPSHOT)


def spans(df):
    return sorted((r["symbol_id"], r["series"], r["valid_from"].day, r["valid_to"].day) for r in df.collect())


def test_intervals_of_stable_days_gaps_and_series_changes(spark):
    stable = [(d, 1, "EQ") for d in (14, 15, 16, 17, 18, 21, 22, 23)]
    gap = [(14, 2, "EQ"), (15, 2, "EQ"), (18, 2, "EQ"), (21, 2, "EQ")]
    change = [(14, 3, "EQ"), (15, 3, "BE")]
    snap = snapshots(spark, stable + gap + change + stable[:2])
    built = universe.build_intervals(snap)
    assert spans(built) == [(1, "EQ", 14, 23), (2, "EQ", 14, 15), (2, "EQ", 18, 21), (3, "BE", 15, 15), (3, "EQ", 14, 14)]
    r = universe.equivalence(snap, built).first()
    assert (r["missing"], r["extra"], r["n_rows"], r["n_intervals"]) == (0, 0, 14, 5)


def test_change_report_finds_a_split(spark):
    snap = snapshots(spark, [(16, 1, "EQ"), (16, 2, "EQ"), (18, 1, "EQ"), (18, 3, "EQ"), (18, 4, "EQ"), (21, 1, "EQ"), (21, 3, "BE"), (21, 5, "EQ"), (21, 2, "EQ")])
    built, dates = universe.build_intervals(snap), universe.observations(snap)
    kinds = {(r["symbol_id"], r["kind"]) for r in universe.changes(built, dates).filter(F.col("valid_from") == F.lit(D(21))).collect()}
    assert kinds == {(5, "new_symbol"), (3, "series_change"), (2, "gap_relist")}
    assert {(r["symbol_id"], r["reappears"]) for r in universe.closed(built, dates).filter(F.col("closed_on") == F.lit(D(21))).collect()} == {(3, True), (4, False)}
    split = spark.createDataFrame([(1, "EQ", D(16), D(18), None), (1, "EQ", D(21), D(21), None)], "symbol_id long, series string, valid_from date, valid_to date, listing_date date")
    assert universe.report_verdict(universe.changes(split, dates)).first()["verdict"] == "fail"


def test_snapshots_one_by_one_repeated_empty_and_late(spark):
    rows = [(14, 1, "EQ"), (14, 2, "EQ"), (15, 2, "EQ"), (16, 2, "EQ"), (16, 1, "EQ")]
    snap = snapshots(spark, rows)
    out = universe.build_intervals(snap.limit(0)).select("symbol_id", "series", "valid_from", "valid_to", "listing_date")
    previous = None
    for d in (14, 15, 16, 16):
        out = universe.record_snapshot(out, snap.filter(F.day("snapshot_date") == d), F.lit(D(d)), F.lit(previous if d > 14 else None).cast("date"))
        previous = D(d) if d != 16 else previous
    assert spans(out) == spans(universe.build_intervals(snap)) == [(1, "EQ", 14, 14), (1, "EQ", 16, 16), (2, "EQ", 14, 16)]
    assert spans(universe.record_snapshot(out, snap.limit(0), F.lit(D(17)), F.lit(D(16)))) == spans(out)
    late = universe.record_snapshot(out, snap.filter(F.day("snapshot_date") == 15), F.lit(D(15)), F.lit(D(14)))
    assert (2, "EQ", 14, 16) in spans(late)


def test_upsert_rules_and_replay(spark):
    keys, rules = upsert.RAW_BARS
    schema = "symbol_id long, trade_date date, series string, close double, deliv_qty long"
    old = spark.createDataFrame([(1, D(14), "EQ", 105.0, 40), (2, D(14), "EQ", 7.0, None)], schema)
    new = spark.createDataFrame([(1, D(14), "EQ", 106.0, None), (3, D(14), "EQ", 1.0, 5)], schema)
    once = upsert.keyed_upsert(old, new, keys, rules)
    assert sorted(map(tuple, once.collect())) == [(1, D(14), "EQ", 106.0, 40), (2, D(14), "EQ", 7.0, None), (3, D(14), "EQ", 1.0, 5)]
    assert sorted(map(tuple, upsert.keyed_upsert(once, new, keys, rules).collect())) == sorted(map(tuple, once.collect()))
    batch = spark.createDataFrame([(1, D(14), "EQ", 1.0, 9, 1), (1, D(14), "EQ", 2.0, None, 2)], schema + ", seq int")
    assert tuple(upsert.applied_in_order(batch, keys, {"close": "new", "deliv_qty": "fill"}, "seq").first()) == (1, D(14), "EQ", 2.0, 9)


def test_ids_by_ticker_and_for_new_isins(spark):
    symbols = spark.createDataFrame([(1, "I1", "A", D(1)), (2, "I2", "A", D(2)), (3, "I3", "B", None)], "symbol_id long, isin string, symbol string, last_seen date")
    assert {tuple(r) for r in upsert.ticker_ids(symbols).collect()} == {("A", 2), ("B", 3)}
    new = upsert.new_symbol_ids(symbols, spark.createDataFrame([("I9",), ("I5",), ("I1",), (None,)], "isin string"))
    assert {tuple(r) for r in new.collect()} == {("I5", 4), ("I9", 5)}


def pair(spark, raw, adj, rv=1000, av=1000):
    df = spark.createDataFrame([(1, D(14), "EQ", raw, rv, adj, av)], "symbol_id long, trade_date date, series string, raw_close double, raw_volume long, adj_close double, adj_volume long")
    found = quality.cross_findings(df).collect()
    return [(r["check_name"], r["severity"]) for r in found], [r["factor"] for r in quality.adjustment_factors(df).collect()]


@pytest.mark.parametrize(
    "args, findings, factors",
    [
        ((846.30, 282.10, 410200, 1230600), [], [3.0]),
        ((200.0, 100.0), [("volume_factor_mismatch", "warning")], [2.0]),
        ((100000.0, 20.0), [("implausible_factor", "error")], []),
        ((100.0, 0.0), [("factor_uncomputable", "warning")], []),
        ((None, 1.0), [("factor_uncomputable", "warning")], []),
        ((100.0, 100.0, None, 5), [("volume_factor_mismatch", "warning")], [1.0]),
    ],
)
def test_cross_source_rules(spark, args, findings, factors):
    assert pair(spark, *args) == (findings, factors)


def bars(spark, *rows):
    return spark.createDataFrame([(i, d, "EQ", *prices, v, None, d) for i, d, prices, v in rows], "symbol_id long, trade_date date, series string, open double, high double, low double, close double, volume long, deliv_pct double, file_date date")


def test_bar_rules_and_whole_rejection(spark):
    df = bars(spark, (1, D(14), (10.0, 9.0, 11.0, 10.0), 5), (2, D(15), (10.0, 11.0, 9.0, 10.0), 5), (2, D(15), (10.0, 11.0, 9.0, 10.0), 5), (3, D(16), (10.0, 11.0, 9.0, 10.0), 5), (4, D(14), (0.0, 11.0, 0.0, 10.0), -1))
    found = quality.batch_findings(df, spark.createDataFrame([(D(d),) for d in (14, 15, 16, 17)], "trade_date date"))
    assert sorted((r["check_name"], r["trade_date"].day) for r in found.collect()) == [("duplicate_bar", 15), ("empty_batch", 17)] + [("ohlc_insane", 14)] * 5
    assert [r["symbol_id"] for r in quality.accepted(df, found).collect()] == [3]
    with pytest.raises(ValueError):
        quality.assert_constraints(df, quality.bar_constraints())


def test_calendar_and_grace(spark):
    assert [r[0].day for r in calendar.candidate_dates(spark, D(18), D(22)).collect()] == [18, 21, 22]
    assert calendar.candidate_dates(spark, D(22), D(18)).count() == 0
    log = spark.createDataFrame([("daily", D(21), "loaded"), ("daily", D(18), "partial"), ("other", D(22), "loaded")], "source string, data_date date, status string")
    assert [r[0].day for r in calendar.outstanding_dates(spark, log, "daily", D(22), 4).collect()] == [18, 22]
    ages = spark.createDataFrame([(D(22) - timedelta(days=a), a) for a in (0, 3, 4)], "d date, age int")
    got = ages.select("age", calendar.classify_missing(F.col("d"), F.lit(D(22))).alias("m"), calendar.classify_loaded(F.lit(False), F.col("d"), F.lit(D(22))).alias("l"), calendar.classify_loaded(F.lit(True), F.col("d"), F.lit(D(22))).alias("t")).collect()
    assert [tuple(r) for r in got] == [(0, "failed", "partial", "loaded"), (3, "failed", "partial", "loaded"), (4, "no_data", "loaded", "loaded")]
    w = spark.createDataFrame([(1, date(2000, 1, 1), date(2026, 9, 1)), (2, D(2), D(1))], "k int, a date, b date")
    chunks = calendar.split_window(w, "a", "b").orderBy("chunk_start").collect()
    assert all(r["k"] == 1 for r in chunks) and chunks[0]["chunk_start"] == date(2000, 1, 1) and chunks[-1]["chunk_end"] == date(2026, 9, 1)
    assert all((b["chunk_start"] - a["chunk_end"]).days == 1 for a, b in zip(chunks, chunks[1:])) and all((r["chunk_end"] - r["chunk_start"]).days <= 1800 for r in chunks)


def test_freshness_never_guesses(spark):
    dates = spark.createDataFrame([(D(d),) for d in range(14, 20)], "trade_date date")
    log = spark.createDataFrame([("s", D(14), "loaded"), ("s", D(15), "partial"), ("s", D(16), "no_data"), ("s", D(17), "failed")], "source string, data_date date, status string")
    manifest = spark.createDataFrame([(D(17), True), (D(18), False)], "trade_date date, published boolean")
    got = audit.assess(dates, log, manifest, "s")
    assert [r["verdict"] for r in got.orderBy("trade_date").collect()] == ["ok", "ok", "ok", "STALE", "ok", "UNVERIFIED"]
    assert audit.overall(got).first()[0] == 7 and audit.overall(got.filter("verdict <> 'STALE'")).first()[0] == 8


def test_listing_of_a_day(spark):
    symbols = spark.createDataFrame([(4, "IA", "A", "Alpha", 1.0, D(2), D(10))], "symbol_id long, isin string, symbol string, name string, face_value double, first_seen date, last_seen date")
    listed = spark.createDataFrame([("IA", "A2", " ", None, None), ("IC", "C", "Gamma", 2.0, D(5)), ("IB", "B", None, None, None), (None, "X", None, None, None), ("IC", "C", "Gamma", 2.0, D(5))], "isin string, symbol string, name string, face_value double, listing_date date")
    once = upsert.seen_symbols(symbols, listed, F.lit(D(22)))
    rows = {r["isin"]: (r["symbol_id"], r["symbol"], r["name"], r["first_seen"], r["last_seen"]) for r in once.collect()}
    assert rows == {"IA": (4, "A2", "Alpha", D(2), D(22)), "IB": (5, "B", None, D(22), D(22)), "IC": (6, "C", "Gamma", D(5), D(22))}
    again = upsert.seen_symbols(once, listed, F.lit(D(22)))
    assert sorted(map(str, again.collect())) == sorted(map(str, once.collect()))
    assert [r["symbol"] for r in upsert.symbols_by_ticker(once).collect()] == ["A2", "B", "C"] and upsert.symbols_by_ticker(once, 2).count() == 2


def test_only_touched_months_are_read(spark, tmp_path):
    path = str(tmp_path / "bars")
    schema = "symbol_id long, trade_date date, series string, close double, deliv_qty long"
    old = spark.createDataFrame([(1, date(2026, m, 3), "EQ", float(m), m) for m in range(1, 9)], schema)
    keys, rules = upsert.RAW_BARS
    upsert.upsert_months(spark, path, old.schema, old, keys, rules, "trade_date")
    new = spark.createDataFrame([(1, date(2026, 3, 3), "EQ", 30.0, None), (2, date(2026, 3, 4), "EQ", 1.0, None)], schema)
    after = upsert.months_after(spark, path, old.schema, new, keys, rules, "trade_date")
    plan = after._jdf.queryExecution().executedPlan().toString()
    assert "trade_month" in plan.split("PartitionFilters")[1][:120] and "2026-03" in plan.split("PartitionFilters")[1][:200]
    upsert.upsert_months(spark, path, old.schema, new, keys, rules, "trade_date")
    got = {(r["symbol_id"], r["trade_date"]): (r["close"], r["deliv_qty"]) for r in spark.read.parquet(path).collect()}
    assert len(got) == 9 and got[(1, date(2026, 3, 3))] == (30.0, 3) and got[(1, date(2026, 8, 3))] == (8.0, 8)


def test_runs_are_closed_whatever_happens(spark, tmp_path):
    path, ticks = str(tmp_path / "runs"), iter(datetime(2026, 9, 1, 0, 0, k) for k in range(20))
    finding = lambda severity: spark.createDataFrame([("x", severity, "d" * 5000, 1, D(14))], "check_name string, severity string, detail string, symbol_id long, trade_date date")

    def breaks():
        raise OSError("disk full")

    assert ingest.recorded_run(spark, path, 1, lambda: finding("warning"), lambda: next(ticks)) == "succeeded"
    assert ingest.recorded_run(spark, path, 2, lambda: finding("error"), lambda: next(ticks)) == "halted"
    with pytest.raises(OSError):
        ingest.recorded_run(spark, path, 3, breaks, lambda: next(ticks))
    ingest.record_event(spark, path, 4, "running", next(ticks))
    state = {r["run_id"]: (r["status"], r["notes"]) for r in ingest.run_state(ingest.events_table(spark, path).read()).collect()}
    assert state == {1: ("succeeded", ""), 2: ("halted", ""), 3: ("failed", "disk full"), 4: ("running", "")}
    ingest.append_findings(finding("error"), 2, str(tmp_path / "f"))
    ingest.append_findings(finding("info"), 3, str(tmp_path / "f"))
    assert sorted((r["run_id"], len(r["detail"])) for r in ingest.findings_table(spark, str(tmp_path / "f")).read().collect()) == [(2, 4000), (3, 4000)]
    with pytest.raises(Exception, match="constraints broken"):
        ingest.append_findings(finding("fatal"), 4, str(tmp_path / "f"))


STORED = "symbol_id long, trade_date date, series string, open double, high double, low double, close double, volume long, deliv_qty long, deliv_pct double, file_date date, seq int"


def test_a_stream_settles_dates_as_the_batch_does(spark, tmp_path):
    """The log is load_status of the stored rows at every age, with new files and without."""
    keys, rules = upsert.RAW_BARS
    rules = {c: r for c, r in {**rules, "file_date": "new"}.items() if c in STORED}
    at = {n: str(tmp_path / n) for n in ("landed", "bars", "log", "state")}
    schema = spark.createDataFrame([], STORED).schema

    def bar(symbol, day, seq=1, qty=None, pct=None, close=2.0):
        return (symbol, D(day), "EQ", 1.0, 3.0, 1.0, close, 5, qty, pct, D(day), seq)

    def run(today, *rows):
        if rows:
            spark.createDataFrame(list(rows), STORED).write.mode("append").parquet(at["landed"])
        stream = feeds.landed(spark, at["landed"], schema)
        bars_schema = spark.createDataFrame([], STORED).drop("seq").schema
        feeds.enrich_available(spark, stream, at["bars"], bars_schema, at["log"], at["state"], keys, rules, ("seq",), F.lit(D(today)), "daily")
        bars = spark.read.parquet(at["bars"])
        log = {r["data_date"].day: (r["status"], r["rows_loaded"]) for r in spark.read.parquet(at["log"]).collect()}
        batch = ingest.load_status(bars.select("trade_date").distinct(), bars, F.lit(D(today)))
        assert log == {r["trade_date"].day: (r["status"], r["rows_loaded"]) for r in batch.collect()}
        return log

    # 17: no figure; 18: a quantity but no share is no figure; 16: a price above the day's high.
    assert run(18, bar(1, 18, qty=40), bar(2, 18), bar(1, 17), bar(1, 16, close=9.0)) == {18: ("partial", 2), 17: ("partial", 1), 16: ("failed", 0)}
    assert run(20) == {18: ("partial", 2), 17: ("partial", 1), 16: ("failed", 0)}  # 17 is 3 days old
    assert run(21) == {18: ("partial", 2), 17: ("loaded", 1), 16: ("failed", 0)}  # 17 is 4 days old; nothing landed
    assert run(21, bar(2, 18, 2, 40, 40.0), bar(1, 21)) == {21: ("partial", 1), 18: ("loaded", 2), 17: ("loaded", 1), 16: ("failed", 0)}
    assert run(25, bar(1, 16, 3, close=2.5)) == {21: ("loaded", 1), 18: ("loaded", 2), 17: ("loaded", 1), 16: ("loaded", 1)}
    assert {(r["symbol_id"], r["trade_date"].day): r["deliv_pct"] for r in spark.read.parquet(at["bars"]).collect()} == {(1, 18): None, (2, 18): 40.0, (1, 17): None, (1, 21): None, (1, 16): None}


def test_a_run_settles_once_and_stores_a_month_in_one_file(spark, tmp_path, monkeypatch):
    """Whatever the tasks: months are not cut into files of each. Open dates are judged by the first batch only, or once by a run without files."""
    keys, rules = upsert.RAW_BARS
    rules = {c: r for c, r in {**rules, "file_date": "new"}.items() if c in STORED}
    at = {n: str(tmp_path / n) for n in ("landed", "bars", "log", "state")}
    settle, settled = feeds.settle_dates, []
    monkeypatch.setattr(feeds, "settle_dates", lambda *a: (settled.append(a[7:]), settle(*a))[1])
    days = [date(2026, m, 1 + k) for m in (1, 2, 3) for k in range(20)]
    rows = [(k, d, "EQ", 1.0, 3.0, 1.0, 2.0, 5, 40, 40.0, d, 1) for d in days for k in range(5)]
    spark.createDataFrame(rows, STORED).repartition(4).write.parquet(at["landed"])
    schema = spark.createDataFrame([], STORED).schema
    kept = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        for calls in (2, 3):
            stream = feeds.landed(spark, at["landed"], schema, 2)
            feeds.enrich_available(spark, stream, at["bars"], spark.createDataFrame([], STORED).drop("seq").schema, at["log"], at["state"], keys, rules, ("seq",), F.lit(D(1)), "daily")
            assert len(settled) == calls
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", kept)
    assert settled == [(True,), (False,), ()]  # two batches; then a run without files
    for name in ("bars", "log"):
        assert sorted(p.parent.name for p in (tmp_path / name).glob("*/*.parquet")) == [f"trade_month=2026-0{m}" for m in (1, 2, 3)]
    assert spark.read.parquet(at["bars"]).count() == len(rows) and spark.read.parquet(at["log"]).filter("status = 'loaded' AND rows_loaded = 5").count() == len(days)


def test_landed_bars_hold_ranges_of_days(spark, sf_dir, tmp_path):
    from daybook.plans import queries

    kept = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        queries._landed_bars(spark, sf_dir, str(tmp_path))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", kept)
    files = spark.read.parquet(str(tmp_path / "landed")).groupBy("seq", F.input_file_name().alias("file")).agg(F.min("trade_date").alias("lo"), F.max("trade_date").alias("hi"))
    for seq in (1, 2):
        ends = sorted((r["lo"], r["hi"]) for r in files.filter(F.col("seq") == seq).collect())
        assert len(ends) > 2 and all(a[1] <= b[0] for a, b in zip(ends, ends[1:]))


def test_a_stream_refuses_bad_rows(spark, tmp_path):
    keys, rules = upsert.RAW_BARS
    schema = spark.createDataFrame([], STORED).schema
    spark.createDataFrame([(1, D(18), "EQ", 1.0, 3.0, 1.0, -2.0, 5, None, None, D(18), 1)], STORED).write.parquet(str(tmp_path / "landed"))
    stream = feeds.landed(spark, str(tmp_path / "landed"), schema)
    with pytest.raises(Exception, match="constraints broken"):
        feeds.upsert_stream(spark, stream, str(tmp_path / "bars"), spark.createDataFrame([], STORED).drop("seq").schema, str(tmp_path / "state"), keys, {c: r for c, r in rules.items() if c in STORED}, ("seq",), table="bars").awaitTermination()


def test_report_of_one_date(spark):
    snap = snapshots(spark, [(16, 1, "EQ"), (16, 2, "EQ"), (18, 1, "EQ"), (18, 3, "EQ"), (18, 4, "EQ"), (21, 1, "EQ"), (21, 3, "BE"), (21, 5, "EQ"), (21, 2, "EQ")])
    built = universe.build_intervals(snap)
    got = [(r["section"], r["symbol_id"], r["note"], r["n"]) for r in universe.change_report(built, F.lit(D(21)), F.lit(D(18))).collect()]
    assert sorted(got, key=str) == sorted([
        ("size", None, "2026-09-18", 3), ("size", None, "2026-09-21", 4), ("kind", None, "new_symbol", 1), ("kind", None, "series_change", 1), ("kind", None, "gap_relist", 1),
        ("opened", 5, "new_symbol", None), ("opened", 3, "series_change", None), ("opened", 2, "gap_relist", None),
        ("closed", 3, "reappears under another series", None), ("closed", 4, "absent from the latest list", None), ("verdict", None, "OK", 0),
    ], key=str)
    split = spark.createDataFrame([(1, "EQ", D(16), D(18), None), (1, "EQ", D(21), D(21), None)], "symbol_id long, series string, valid_from date, valid_to date, listing_date date")
    assert [(r["note"], r["n"]) for r in universe.change_report(split, F.lit(D(21)), F.lit(D(18))).filter("section = 'verdict'").collect()] == [("FAIL", 1)]
    assert universe.change_report(split, F.lit(D(21)), F.lit(D(18)), F.lit(D(16))).filter("section = 'opened'").count() == 2


def test_fingerprint_is_blind_to_order_only(spark):
    df = spark.range(1000).select("id", (F.col("id") * 1.5).alias("close"))
    a = audit.fingerprint(df, "t", ["id", "close"], "id").first()
    assert a == audit.fingerprint(df.repartition(7, "close"), "t", ["id", "close"], "id").first()
    b = audit.fingerprint(df.withColumn("close", F.when(F.col("id") == 5, 7.55).otherwise(F.col("close"))), "t", ["id", "close"], "id").first()
    assert a["n"] == b["n"] and a["digest"] != b["digest"]
    assert audit.fingerprint(df.limit(0), "t", ["id", "close"], "id").first()["n"] == 0
    verdicts = lambda *v: spark.createDataFrame([(str(k), x) for k, x in enumerate(v)], "table_name string, verdict string")
    assert audit.protected(verdicts("identical", "new, empty")).first()[0] and not audit.protected(verdicts("identical", "gone")).first()[0]


def test_columns(spark):
    df = spark.createDataFrame([("1,234.5",), ("-",), ("12d",), ("1_0",), ("NaN",), (" 7.9 ",), (None,), ("-3.7",)], "t string")
    assert [r[0] for r in df.select(C.to_double(F.col("t"))).collect()] == [1234.5, None, None, None, None, 7.9, None, -3.7]
    assert [r[0] for r in df.select(C.to_long(F.col("t"))).collect()] == [1234, None, None, None, None, 7, None, -3]
    one = spark.range(1)
    assert tuple(one.select(C.month_name_date(F.lit(D(8))), C.compact_date(F.lit(D(8))), C.sortable_date(F.lit(D(8)))).first()) == ("08-Sep-2026", "08092026", "20260908")
    assert one.select(C.candle_date(F.lit("2026-09-18T00:00:00+05:30"))).first()[0] == D(18)
    ratio = lambda *a: one.select(C.agreed_ratio([F.lit(x) for x in a[:4]], [F.lit(x) for x in a[4:]])).first()[0]
    assert ratio(2.0, 4.0, 2.0, 3.0, 1.0, 2.0, 1.0, 1.5) == 2.0 and ratio(2.0, 4.0, 2.0, 3.0, 1.0, 2.0, 1.0, 1.6) is None and ratio(2.0, 4.0, 2.0, 3.0, 0.0, 2.0, 1.0, 1.5) is None


def test_run_summary(spark):
    status = spark.createDataFrame([(D(14), "loaded", 5), (D(15), "partial", 3), (D(16), "failed", 0)], "trade_date date, status string, rows_loaded int")
    none = spark.createDataFrame([], "check_name string, severity string, detail string, symbol_id long, trade_date date")
    out = ingest.run_summary(status, none)
    r = out.first()
    assert (r["dates_loaded"], r["dates_failed"], r["bars_written"], r["run_status"]) == ([D(14), D(15)], [D(16)], 8, "succeeded")
    assert "bars_written=8" in ingest.summary_text(out).first()[0]


def test_counts_sizes_and_partitions(spark, tmp_path):
    df = spark.createDataFrame([(1, date(2026, 8, 3), 1.0), (2, D(1), 2.0)], "symbol_id long, trade_date date, close double")
    path = str(tmp_path / "bars")
    upsert.write_partitions(df, path, "trade_date")
    upsert.write_partitions(df.filter("symbol_id = 2").withColumn("close", F.lit(9.0)), path, "trade_date")
    back = spark.read.parquet(path)
    assert {(r["symbol_id"], r["close"]) for r in back.collect()} == {(1, 1.0), (2, 9.0)}
    size = audit.footprint(back, F.lit(10**9)).first()
    assert size["bytes"] > 0 and size["verdict"] == "ok"
    back.createOrReplaceTempView("t_bars")
    assert [(r["table_name"], r["n"]) for r in audit.table_counts(spark, ["t_bars", "t_absent"]).collect()] == [("t_bars", 2)]


def test_many_late_and_repeated_snapshots_at_once(spark):
    """Days in any order and in batches of any size give the intervals of all days at once, in plans that do not grow with the days."""
    rng = random.Random(3)
    for trial in range(4):
        present = {(s, day): rng.random() < (0.85 if s % 2 else 0.4) for s in range(12) for day in range(1, 29)}
        rows = lambda days: [(day, s, "EQ" if s % 5 else "BE") for day in days for s in range(12) if present[s, day]]  # noqa: B023, E731
        days = rng.sample(range(1, 29), 24)
        cuts = sorted(rng.sample(range(1, 24), 3))
        batches = [days[a:b] for a, b in zip([0, *cuts], [*cuts, 24])]
        batches.append(rng.sample(days, 4))  # again
        known = snapshots(spark, rows(batches[0]))
        out, seen = universe.build_intervals(known), known.select("snapshot_date")
        for batch in batches[1:]:
            new = snapshots(spark, rows(batch))
            # A day on which nobody was seen is no observation.
            out, seen = universe.record_snapshots(out, seen, new), seen.union(new.select("snapshot_date"))
        whole = universe.build_intervals(snapshots(spark, rows(days)))
        key = lambda r: (r["symbol_id"], r["series"], r["valid_from"], r["valid_to"])
        assert sorted(map(key, out.collect())) == sorted(map(key, whole.collect()))


def test_sizes_and_equality_need_no_expansion(spark):
    snap = snapshots(spark, [(d, s, "EQ") for d in range(1, 20) for s in range(30) if (d * s) % 7 != 3])
    built, dates = universe.build_intervals(snap), universe.observations(snap)
    sizes = universe.size_by_date(built, dates)
    assert sorted(map(tuple, sizes.collect())) == sorted(map(tuple, snap.groupBy("snapshot_date").agg(F.count("*")).collect()))
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert "explode" not in plan(sizes).lower()
    assert universe.unequal_keys(snap.select("snapshot_date", *universe.KEYS).distinct(), built).count() == 0
    wrong = built.withColumn("valid_to", F.when(F.col("symbol_id") == 3, F.col("valid_from")).otherwise(F.col("valid_to"))).filter("symbol_id <> 4")
    wrong = wrong.unionByName(built.filter("symbol_id = 0").withColumn("symbol_id", F.lit(99).cast("long")))
    r = universe.equivalence(snap, wrong).first()
    days = {s: sum((d * s) % 7 != 3 for d in range(1, 20)) for s in (0, 3, 4)}
    assert (r["missing"], r["extra"]) == (days[3] - built.filter("symbol_id = 3").count() + days[4], days[0])
    assert {r["symbol_id"] for r in universe.unequal_keys(snap.select("snapshot_date", *universe.KEYS).distinct(), wrong).collect()} == {3, 4, 99}
    twice = universe.equivalence(snap, built.union(built.filter("symbol_id = 5"))).first()  # the same dates again: nothing is missing or too much
    assert (twice["missing"], twice["extra"]) == (0, 0)
