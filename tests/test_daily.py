import io
import itertools
import zipfile
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from daybook.operators import audit, daily, ingest

HEAD = "SYMBOL, SERIES, DATE1, PREV_CLOSE, OPEN_PRICE, HIGH_PRICE, LOW_PRICE, LAST_PRICE, CLOSE_PRICE, AVG_PRICE, TTL_TRD_QNTY, TURNOVER_LACS, NO_OF_TRADES, DELIV_QTY, DELIV_PER"
UDIFF = "TradDt,FinInstrmTp,ISIN,TckrSymb,SctySrs,OpnPric,HghPric,LwPric,ClsPric,LastPric,PrvsClsgPric,TtlTradgVol,TtlTrfVal,TtlNbOfTxsExctd"
D = lambda d: date(2026, 9, d)


class World:
    """A store and the folders that files land in."""

    def __init__(self, spark, path):
        self.spark, self.path = spark, path
        for name in ("daily", "zip", "candles"):
            (path / name).mkdir()
        self.ticks = (datetime(2026, 9, 1) + timedelta(seconds=k) for k in itertools.count())
        self.listing(["AAA", "BBB"])

    def listing(self, symbols):
        rows = "".join(f"{s},{s} Ltd,EQ,01-JAN-2000,1,1,INE000{s}011,10\n" for s in symbols)
        (self.path / "list.csv").write_text("SYMBOL,NAME OF COMPANY, SERIES, DATE OF LISTING, PAID UP VALUE, MARKET LOT, ISIN NUMBER, FACE VALUE\n" + rows)

    def bars(self, day, symbols=("AAA", "BBB"), close=105, delivery="40.0", high=110, text=None):
        rows = "".join(f"{s}, EQ, {day}-Sep-2026, 99, 100, {high}, 95, 104, {close}, 101, 1000, 1.5, 10, 400, {delivery}\n" for s in symbols)
        (self.path / "daily" / f"full_{day:02}092026.csv").write_text(text if text is not None else f"{HEAD}\n{rows}")

    def archive(self, day, whole=True):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            z.writestr("d.csv", f"{UDIFF}\n2026-09-{day:02},STK,INE000AAA011,AAA,EQ,100,110,95,105,104,99,1000,100000,10\n")
        (self.path / "zip" / f"Bhav_202609{day:02}_F.zip").write_bytes(out.getvalue() if whole else out.getvalue()[:40])

    def landed(self):
        return daily.Landed(*(f"file://{self.path}/{n}" for n in ("list.csv", "daily", "zip", "actions", "candles")))

    def run(self, today, run_id, catchup=4):
        at = lambda n: f"file://{self.path}/{n}"
        landed = self.landed()
        return daily.DailyRun(self.spark, at("store"), landed, D(today), run_id, catchup).run(lambda: next(self.ticks)).first()

    def table(self, name):
        return daily.tables(self.spark, f"file://{self.path}/store")[name].read()

    def log(self):
        return {r["data_date"].day: (r["status"], r["rows_loaded"]) for r in self.table("log").filter("source = 'daily'").collect()}

    def state(self):
        return {r["run_id"]: r["status"] for r in ingest.run_state(self.table("runs")).collect()}


@pytest.fixture
def world(spark, tmp_path):
    return World(spark, tmp_path)


def days(found):
    return [d.day for d in found]


def test_good_rejected_broken_and_absent_dates(world):
    """Sep 2026: 17 Thu, 18 Fri, 21 Mon, 22 Tue."""
    world.bars(17)
    world.bars(18, ["AAA", "AAA", "BBB"])  # a repeated key rejects the date whole
    world.archive(21, whole=False)
    r = world.run(22, 1, catchup=6)
    assert (days(r["dates_loaded"]), days(r["dates_failed"]), days(r["dates_pending"]), days(r["dates_no_data"])) == ([17], [18, 21], [22], [16])
    assert (r["bars_written"], r["universe_symbols"], r["run_status"], r["n_errors"]) == (2, 2, "halted", 1)
    assert world.log() == {16: ("no_data", 0), 17: ("loaded", 2), 18: ("failed", 0), 21: ("failed", 0), 22: ("failed", 0)} and world.state() == {1: "halted"}
    found = {(x["check_name"], x["severity"], x["trade_date"].day) for x in world.table("findings").collect()}
    assert found == {("duplicate_bar", "error", 18), ("file_refused", "warning", 21)}
    # The next run takes up what has not settled, and only that.
    world.bars(17, close=50, high=110)
    world.bars(18)
    world.archive(21)
    world.bars(22, delivery="-")
    r = world.run(22, 2, catchup=6)
    assert (days(r["dates_loaded"]), days(r["dates_partial"]), r["run_status"], r["n_errors"]) == ([18, 21, 22], [21, 22], "succeeded", 0)
    assert world.log() == {16: ("no_data", 0), 17: ("loaded", 2), 18: ("loaded", 2), 21: ("partial", 1), 22: ("partial", 2)} and world.state() == {1: "halted", 2: "succeeded"}
    assert world.table("bars").filter("close = 50").count() == 0  # a loaded date is not read again
    # Delivery figures come late, and the dates settle.
    world.bars(21, ["AAA"])
    r = world.run(26, 3, catchup=6)
    assert days(r["dates_loaded"]) == [21, 22] and days(r["dates_partial"]) == [] and world.log()[21] == ("loaded", 1)
    assert {(x["trade_date"].day, x["deliv_pct"]) for x in world.table("bars").filter("symbol_id = 1").collect()} == {(17, 40.0), (18, 40.0), (21, 40.0), (22, None)}
    prints = daily.tables(world.spark, f"file://{world.path}/store")["bars"]
    own = audit.fingerprint(prints.read(), "bars", prints.schema.names, "trade_date").first()
    assert (own["n"], own["lo"], own["hi"], int(own["digest"])) == prints.fingerprint()


def test_the_universe_comes_first_and_unknown_tickers_are_not_stored(world):
    world.bars(21, ["AAA", "ZZZ"])
    r = world.run(21, 1, catchup=1)
    assert (r["universe_symbols"], r["bars_written"], r["run_status"]) == (2, 1, "succeeded") and world.log() == {21: ("loaded", 1)}
    world.listing(["AAA", "ZZZ"])  # BBB goes, ZZZ comes
    world.run(22, 2, catchup=0)
    spans = {(x["symbol_id"], x["valid_from"].day, x["valid_to"].day) for x in world.table("membership").collect()}
    assert spans == {(1, 21, 22), (2, 21, 21), (3, 22, 22)}
    at = lambda d: sorted(x["symbol"] for x in daily.universe_at(world.spark, f"file://{world.path}/store", F.lit(D(d))).collect())
    assert at(21) == ["AAA", "BBB"] and at(22) == ["AAA", "ZZZ"]
    assert {x["source"] for x in world.table("log").filter("data_date = DATE '2026-09-22'").collect()} == {"daily", "universe"}


def test_factors_of_loaded_dates_and_implausible_pairs(world):
    candle = '{"data":{"candles":[["2026-09-%sT00:00:00+05:30",50,60,40,%s,2000,0]]}}'
    world.bars(21)
    (world.path / "candles" / "INE000AAA011.json").write_text(candle % (21, 52.5))
    (world.path / "candles" / "INE000BBB011.json").write_text("no json")
    r = world.run(21, 1, catchup=0)
    assert (r["factors_written"], r["adjusted_bars_written"], r["run_status"]) == (1, 1, "succeeded")
    assert [(x["symbol_id"], x["factor"]) for x in world.table("factors").collect()] == [(1, 2.0)]
    world.bars(22, close=109)
    (world.path / "candles" / "INE000AAA011.json").write_text((candle % (22, 0.01)).replace("40", "0.001"))
    r = world.run(22, 2, catchup=0)
    assert r["run_status"] == "halted" and {x["check_name"] for x in world.table("findings").filter("run_id = 2").collect()} == {"implausible_factor"}


def test_a_run_without_listing_fails_and_is_recorded(world):
    (world.path / "list.csv").write_text("nothing\n")
    with pytest.raises(ValueError, match="listing"):
        world.run(21, 1)
    assert world.state() == {1: "failed"} and world.table("bars").count() == 0


def test_backfill_goes_on_where_it_stopped(world):
    for day in (14, 15, 16, 17):
        world.bars(day)
    world.bars(15, high=1)  # rejected
    store = f"file://{world.path}/store"
    fill = lambda run_id, said: daily.Backfill(world.spark, store, world.landed(), D(30), run_id, D(11), D(17), dates_a_round=2).fill(lambda: next(world.ticks), lambda: next(said))
    tried, why = fill(1, iter([None, "time is up"]))
    assert sorted(r["trade_date"].day for r in tried.collect()) == [16, 17] and why == "time is up" and world.log() == {17: ("loaded", 2), 16: ("loaded", 2)}
    tried, why = fill(2, itertools.repeat(None))
    assert {r["trade_date"].day: r["status"] for r in tried.collect()} == {15: "failed", 14: "loaded", 11: "no_data"} and why is None
    assert world.state() == {1: "succeeded", 2: "halted"} and world.table("findings").filter("run_id = 2").count() > 0
    tables = daily.tables(world.spark, store)
    size = sum(f.stat().st_size for f in (world.path / "store" / "bars").rglob("*.parquet"))
    assert 0 < tables["bars"].bytes() <= size
    bar = tables["bars"].read().limit(1).withColumn("symbol_id", F.lit(77).cast("long"))
    with pytest.raises(ValueError, match="symbol_id 77"):
        tables["bars"].append(bar, "x")
    assert tables["bars"].read().filter("symbol_id = 77").isEmpty()
