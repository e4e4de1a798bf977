"""Every registered query against its SQL twin on the smallest tables."""

import math

import duckdb
import pytest

from daybook.plans.queries import ORACLES, QUERIES

TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def sql(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    if v is None or isinstance(v, bool):
        return v
    if hasattr(v, "year"):
        return str(v)[:10]
    if isinstance(v, (int, float)) or hasattr(v, "as_tuple"):
        return None if math.isnan(float(v)) else float(v)
    return str(v)


def rows(names, found):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in found), key=repr)


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_its_sql(spark, sf_dir, sql, name):
    got = QUERIES[name](spark, sf_dir)
    cursor = sql.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(got.columns) == sorted(columns)
    assert rows(got.columns, got.collect()) == rows(columns, cursor.fetchall())


def test_footprint_counts_the_bytes_of_the_files(spark, sf_dir):
    import os

    got = QUERIES["footprint"](spark, sf_dir).first()
    size = os.path.getsize(f"{sf_dir}/lineitem.parquet")
    assert got["bytes"] == size and got["verdict"] == "ok" and set(QUERIES) - set(ORACLES) == {"footprint"}


def test_entry_has_rows(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
