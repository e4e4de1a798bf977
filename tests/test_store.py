from datetime import date

import pytest
from pyspark.sql import functions as F

from daybook.operators import audit, ingest, upsert
from daybook.operators.store import Conflict, Table

SCHEMA = "symbol_id long, trade_date date, series string, open double, high double, low double, close double, volume long, deliv_qty long"
KEYS, RULES = upsert.RAW_BARS


def bar(symbol, day, close=10.0, month=3, qty=None, volume=5):
    return (symbol, date(2024, month, day), "EQ", 10.0, 20.0, 1.0, close, volume, qty)


def table(spark, tmp_path, **kw):
    return Table(spark, f"file://{tmp_path}/bars", SCHEMA, "bars", "trade_date", **kw)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_upsert_rewrites_touched_files_only(spark, tmp_path):
    t = table(spark, tmp_path)
    assert t.read().count() == 0 and t.version().number == 0
    for month in (1, 2, 3):
        t.append(spark.createDataFrame([bar(s, d, month=month) for s in range(5) for d in range(1, 9)], SCHEMA).coalesce(2), f"m{month}")
    before = t.version()
    late = spark.createDataFrame([bar(2, 4, 11.0, month=2, qty=7)], SCHEMA)
    assert len(t.touched(late, KEYS)) == 1
    after = t.upsert(late, KEYS, RULES)
    assert len(set(before.files) - set(after.files)) == 1 and len(set(after.files) & set(before.files)) == len(before.files) - 1
    want = {r[:3]: r for r in rows(t.read(before))}
    want[(2, date(2024, 2, 4), "EQ")] = bar(2, 4, 11.0, month=2, qty=7)
    assert rows(t.read()) == sorted(want.values(), key=repr)
    assert t.changed_months(before) == ["2024-02"]
    t.upsert(spark.createDataFrame([bar(2, 4, 12.0, month=2), bar(9, 30, month=4)], SCHEMA), KEYS, RULES)  # one known, one new key
    got = {r[:3]: r for r in rows(t.read())}
    assert got[(2, date(2024, 2, 4), "EQ")] == bar(2, 4, 12.0, month=2, qty=7) and len(got) == 121
    assert rows(t.read(before)) != rows(t.read()) and t.read(before).count() == 120  # earlier versions stay readable


def test_rows_of_one_key_take_effect_in_order(spark, tmp_path):
    t = table(spark, tmp_path)
    many = spark.createDataFrame([(*bar(1, 1, 10.0 + k, qty=3 if k == 1 else None), k) for k in range(4)], f"{SCHEMA}, seq int")
    rules = {**RULES, **dict.fromkeys(("open", "high", "low", "close", "volume"), "new")}
    t.upsert(many, KEYS, rules, order=("seq",), batch="a")
    t.upsert(many.withColumn("close", F.lit(19.0)), KEYS, rules, order=("seq",), batch="a")  # the batch has been taken
    assert rows(t.read()) == [bar(1, 1, 13.0, qty=3)]
    with pytest.raises(ValueError, match="repeats"):
        t.replace(spark.createDataFrame([bar(1, 1), bar(1, 1)], SCHEMA))
    assert rows(t.read()) == [bar(1, 1, 13.0, qty=3)]


@pytest.mark.parametrize("bad", [bar(1, 2, -1.0), bar(1, 2, 30.0), bar(None, 2), bar(1, 2, volume=-1), bar(1, 2, None)])
def test_a_refused_row_leaves_the_old_version(spark, tmp_path, bad):
    t = table(spark, tmp_path)
    t.replace(spark.createDataFrame([bar(1, 1)], SCHEMA))
    for write in (lambda df: t.replace(df), lambda df: t.append(df, "b"), lambda df: t.upsert(df, KEYS, RULES)):
        with pytest.raises(Exception, match="constraints broken"):
            write(spark.createDataFrame([bar(1, 3), bad], SCHEMA))
    assert rows(t.read()) == [bar(1, 1)] and t.version().number == 1 and t.fingerprint()[0] == 1


def test_broken_off_and_overtaken_writes(spark, tmp_path, monkeypatch):
    t = table(spark, tmp_path)
    t.replace(spark.createDataFrame([bar(1, 1)], SCHEMA))
    with monkeypatch.context() as m:  # the files are there, the version is not
        m.setattr(t, "_put", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            t.append(spark.createDataFrame([bar(1, 2)], SCHEMA), "b")
    assert rows(t.read()) == [bar(1, 1)]
    (tmp_path / "bars" / "versions" / "000000000009").write_text("")  # a version that was never finished
    assert t.version().number == 1
    base = t.version()
    t.append(spark.createDataFrame([bar(1, 3)], SCHEMA), "c")
    with monkeypatch.context() as m:
        m.setattr(t, "version", lambda number=None: base)
        with pytest.raises(Conflict):
            t.append(spark.createDataFrame([bar(1, 4)], SCHEMA), "d")
    assert rows(t.read()) == [bar(1, 1), bar(1, 3)]


def test_merge_forget_and_kept_digests(spark, tmp_path):
    t = table(spark, tmp_path)
    for k in range(6):
        t.append(spark.createDataFrame([bar(k, d, month=1 + k % 3) for d in (1, 2)], SCHEMA).coalesce(1), f"{k}")
    before, content = t.version(), rows(t.read())
    print_of = lambda: audit.fingerprint(t.read(), "bars", t.schema.names, "trade_date").first()

    def agrees():
        got, kept = print_of(), t.fingerprint()
        assert (got["n"], got["lo"], got["hi"], int(got["digest"])) == kept

    agrees()
    t.merge()
    assert rows(t.read()) == content and len(t.version().files) == 1 < len(before.files)
    t.append(spark.createDataFrame([bar(0, 1)], SCHEMA), "0")  # merged batches stay taken
    assert rows(t.read()) == content
    t.upsert(spark.createDataFrame([bar(0, 1, 15.0, month=1), bar(8, 9, month=7)], SCHEMA), KEYS, RULES)
    agrees()
    t.forget(1)
    assert t.read().count() == 13 and len(list((tmp_path / "bars" / "versions").glob("0*"))) == 1
    agrees()
    t.replace(spark.createDataFrame([], SCHEMA))
    assert t.fingerprint() == (0, None, None, 0) and t.read().count() == 0


def test_a_replayed_run_appends_nothing(spark, tmp_path):
    path = f"file://{tmp_path}/findings"
    found = spark.createDataFrame([("c", "error", "d", 1, date(2024, 1, 1))], "check_name string, severity string, detail string, symbol_id long, trade_date date")
    for _ in range(2):
        ingest.append_findings(found, 1, path, "bars")
    ingest.append_findings(found, 1, path, "factors")
    assert ingest.findings_table(spark, path).read().count() == 2
    with pytest.raises(Exception, match="constraints broken"):
        ingest.append_findings(found.withColumn("severity", F.lit("fatal")), 2, path)


def test_months_refuse_bad_rows(spark, tmp_path):
    path = f"file://{tmp_path}/months"
    write = lambda r: upsert.upsert_months(spark, path, spark.createDataFrame([], SCHEMA).schema, spark.createDataFrame(r, SCHEMA), KEYS, {c: r for c, r in RULES.items() if c in SCHEMA}, "trade_date", "bars")
    write([bar(1, 1), bar(1, 2)])
    with pytest.raises(Exception, match="constraints broken"):
        write([bar(1, 2, -1.0)])
    assert rows(spark.read.parquet(path).drop("trade_month")) == [bar(1, 1), bar(1, 2)]
