import io
import zipfile
from datetime import date

import pytest

from daybook.sources import files

LISTING = """SYMBOL,NAME OF COMPANY, SERIES, DATE OF LISTING, PAID UP VALUE, MARKET LOT, ISIN NUMBER, FACE VALUE
AAA,First Ltd,EQ,23-Jul-1999,2,1,INE000A01011,2
BBB,Second Ltd,BE,,10,1,INE000A01012,"1,000"
CCC,No Isin,EQ,14-FEB-2011,10,1,,10
"""
DELIVERY = """SYMBOL, SERIES, DATE1, PREV_CLOSE, OPEN_PRICE, HIGH_PRICE, LOW_PRICE, LAST_PRICE, CLOSE_PRICE, AVG_PRICE, TTL_TRD_QNTY, TURNOVER_LACS, NO_OF_TRADES, DELIV_QTY, DELIV_PER
AAA, EQ, 15-Mar-2024, 99, 100, 110, 95, 104, 105, 101, 1000, 1.5, 10, 400, 40.0
BBB, BE, 15-Mar-2024, 99, 100, 110, 95, 104, 105, 101, 1000, 1.5, 10, -, -
FUT, FUTIDX, 15-Mar-2024, 99, 100, 110, 95, 104, 105, 101, 1000, 1.5, 10, 400, 40.0
DDD, EQ, 15-Mar-2024, 99, -, 110, 95, 104, 105, 101, 12d, 1.5, 10, 400, 40.0
"""


def test_listing(spark, tmp_path):
    (tmp_path / "list.csv").write_text(LISTING)
    got = {r["symbol"]: r for r in files.listing(spark, str(tmp_path)).collect()}
    assert set(got) == {"AAA", "BBB"}
    assert got["AAA"]["listing_date"] == date(1999, 7, 23) and got["BBB"]["listing_date"] is None
    assert got["BBB"]["face_value"] == 1000.0


def test_delivery(spark, tmp_path):
    (tmp_path / "full_15032024.csv").write_text(DELIVERY)
    got = {r["symbol"]: r for r in files.delivery_bars(spark, str(tmp_path)).collect()}
    assert set(got) == {"AAA", "BBB"}
    a = got["AAA"]
    assert (a["trade_date"], a["file_date"], a["close"], a["turnover"], a["deliv_qty"]) == (date(2024, 3, 15), date(2024, 3, 15), 105.0, 150000.0, 400)
    assert got["BBB"]["deliv_qty"] is None and got["BBB"]["deliv_pct"] is None


def _zip(rows, name="BHAV.CSV"):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        if rows is not None:
            z.writestr(name, rows)
    return out.getvalue()


def test_zipped_files_and_preference(spark, tmp_path):
    head = "TradDt,FinInstrmTp,ISIN,TckrSymb,SctySrs,OpnPric,HghPric,LwPric,ClsPric,LastPric,PrvsClsgPric,TtlTradgVol,TtlTrfVal,TtlNbOfTxsExctd\n"
    row = "2024-03-{d},{k},INE000A01011,AAA,EQ,1,2,0.5,1.5,1.5,1,100,1000,5\n"
    (tmp_path / "z").mkdir()
    (tmp_path / "z" / "Bhav_20240315.zip").write_bytes(_zip(head + row.format(d=15, k="STK") + row.format(d=15, k="IDX")))
    (tmp_path / "z" / "Bhav_20240316.zip").write_bytes(_zip(head + row.format(d=16, k="STK")))
    (tmp_path / "z" / "Bhav_20240317.zip").write_bytes(_zip(None))
    second = files.udiff_bars(spark, str(tmp_path / "z"))
    assert sorted((r["trade_date"].day, r["isin"], r["volume"], r["deliv_pct"]) for r in second.collect()) == [(15, "INE000A01011", 100, None), (16, "INE000A01011", 100, None)]
    (tmp_path / "full_15032024.csv").write_text(DELIVERY)
    best = files.preferred_by_date(files.delivery_bars(spark, str(tmp_path / "*.csv")), second)
    assert sorted((r["trade_date"].day, r["origin"]) for r in best.collect()) == [(15, 1), (15, 1), (16, 2)]
    expected = spark.createDataFrame([(date(2024, 3, d),) for d in (15, 16, 17)], "trade_date date")
    assert [r["trade_date"].day for r in files.missing_dates(expected, best).collect()] == [17]


def test_actions_and_candles(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "ok.json").write_text('[{"comp":"AAA","symbol":" ","exDate":"20-Sep-2026","faceVal":"10","isin":"","subject":"Bonus 1:1"},{"symbol":"B","exDate":"-"}]')
    (tmp_path / "a" / "bad.json").write_text("not json")
    (r,) = files.corporate_actions(spark, str(tmp_path / "a")).collect()
    assert (r["symbol"], r["isin"], r["ex_date"], r["purpose"], r["face_value"]) == ("AAA", None, date(2026, 9, 20), "Bonus 1:1", 10.0)
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "INE000A01011.json").write_text('{"status":"success","data":{"candles":[["2026-09-18T00:00:00+05:30",1,2,0.5,1.5,100,0],["2026-09-17T00:00:00+05:30",1,2,0.5,1.4,90,0],["bad"]]}}')
    (tmp_path / "c" / "INE000A01012.json").write_text('["error"]')
    got = files.candles(spark, str(tmp_path / "c")).collect()
    assert [(r["isin"], r["trade_date"], r["volume"]) for r in got] == [("INE000A01011", date(2026, 9, 17), 90), ("INE000A01011", date(2026, 9, 18), 100)]


def test_missing_columns_empty_files_and_other_headers(spark, tmp_path):
    lines = DELIVERY.splitlines()
    short = "\n".join(",".join(line.split(",")[:11]) for line in lines)  # no turnover, trades or delivery
    (tmp_path / "short").mkdir()
    (tmp_path / "short" / "d_15032024.csv").write_text(short)
    got = {r["symbol"]: r for r in files.delivery_bars(spark, str(tmp_path / "short")).collect()}
    assert set(got) == {"AAA", "BBB"} and got["AAA"]["deliv_qty"] is None and got["AAA"]["turnover"] is None
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "d_18032024.csv").write_text(lines[0] + "\n")
    assert files.delivery_bars(spark, str(tmp_path / "none")).count() == 0
    (tmp_path / "mixed").mkdir()
    (tmp_path / "mixed" / "d_15032024.csv").write_text(DELIVERY)
    swapped = [",".join([c[1], c[0], *c[2:]]) for c in (line.split(",") for line in lines)]
    (tmp_path / "mixed" / "d_18032024.csv").write_text("\n".join(swapped))
    with pytest.raises(Exception):  # columns in another order are refused, not mixed up
        files.delivery_bars(spark, str(tmp_path / "mixed")).collect()
