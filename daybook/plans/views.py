"""Market tables derived from the given ones, in SQL that Spark and other engines read alike.

Each view names the tables it reads in braces. Faults are planted by remainders, so that every rule of
the quality operators has something to find. Numbers are whole cents divided by 100: exact in both.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession

VIEWS: dict[str, str] = {
    "snapshots": """
        SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS snapshot_date, o_custkey AS symbol_id,
               CASE WHEN (o_custkey + year(o_orderdate)) % 5 = 0 THEN 'BE' ELSE 'EQ' END AS series,
               CASE WHEN o_custkey % 2 = 0 THEN CAST('1990-01-01' AS DATE) END AS listing_date
        FROM {orders}""",
    "symbols": """
        SELECT c_custkey AS symbol_id, concat('INE', lpad(CAST(c_custkey AS VARCHAR(20)), 9, '0')) AS isin, concat('SYM', CAST(c_custkey % 1000 AS VARCHAR(20))) AS symbol,
               c_name AS name, CAST('2000-01-01' AS DATE) AS first_seen, CAST('2001-01-01' AS DATE) AS last_seen, CAST(c_nationkey AS DOUBLE) AS face_value
        FROM {customer}""",
    "bars": """
        SELECT symbol_id, trade_date, series, open, high, low, close, volume, deliv_qty,
               CASE WHEN deliv_qty IS NULL THEN NULL ELSE CAST(deliv_qty % 100 AS DOUBLE) END AS deliv_pct,
               CASE WHEN k % 211 = 0 THEN CAST('1999-12-31' AS DATE) ELSE trade_date END AS file_date
        FROM (SELECT symbol_id, trade_date, series, k,
                     CASE WHEN k % 97 = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(lo AS DOUBLE) / 100 END AS open,
                     CASE WHEN k % 89 = 0 THEN CAST(lo - 1 AS DOUBLE) / 100 ELSE CAST(hi + 5 AS DOUBLE) / 100 END AS high,
                     CAST(lo - 5 AS DOUBLE) / 100 AS low, CAST(hi AS DOUBLE) / 100 AS close,
                     CASE WHEN k % 83 = 0 THEN -1 ELSE qty END AS volume,
                     CASE WHEN day(trade_date) % 4 = 0 THEN NULL ELSE qty * 7 % 1000 END AS deliv_qty
              FROM (SELECT l_partkey % 50 AS symbol_id, CAST(l_shipdate AS DATE) AS trade_date,
                           CASE l_returnflag WHEN 'A' THEN 'EQ' WHEN 'N' THEN 'BE' ELSE 'BZ' END AS series,
                           CAST(min(floor(l_extendedprice / l_quantity * 100 + 0.5)) AS BIGINT) AS lo, CAST(max(floor(l_extendedprice / l_quantity * 100 + 0.5)) AS BIGINT) AS hi,
                           CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS qty, CAST(sum(l_orderkey) AS BIGINT) AS k
                    FROM {lineitem} GROUP BY 1, 2, 3) g) p""",
    "adjusted": """
        SELECT symbol_id, trade_date, max(close) AS close, max(volume) AS volume
        FROM (SELECT symbol_id, trade_date,
                     CASE WHEN symbol_id = 7 THEN CAST(0 AS DOUBLE) WHEN symbol_id = 11 THEN close / 5000 WHEN trade_date < CAST('1998-01-01' AS DATE) THEN close / 2 ELSE close END AS close,
                     CASE WHEN symbol_id % 10 = 3 THEN volume + 5 WHEN trade_date < CAST('1998-01-01' AS DATE) THEN volume * 2 ELSE volume END AS volume
              FROM ({bars}) b WHERE series = 'EQ') a GROUP BY symbol_id, trade_date""",
    "log_events": """
        SELECT 'daily' AS source, CAST(o_orderdate AS DATE) AS data_date, o_orderkey AS seq,
               CASE o_orderstatus WHEN 'F' THEN 'loaded' WHEN 'O' THEN 'failed' ELSE 'partial' END AS status, CAST(o_custkey AS INT) AS rows_loaded
        FROM {orders}""",
    "log": """
        SELECT source, data_date, status, rows_loaded
        FROM (SELECT *, row_number() OVER (PARTITION BY source, data_date ORDER BY seq DESC) AS n FROM ({log_events}) e) r WHERE n = 1""",
    "manifest": """
        SELECT DISTINCT CAST(o_orderdate AS DATE) AS trade_date, CASE WHEN day(o_orderdate) % 7 = 0 THEN NULL ELSE day(o_orderdate) % 3 <> 0 END AS published
        FROM {orders} WHERE day(o_orderdate) % 5 <> 0""",
    "dirty": """
        SELECT l_orderkey, l_linenumber, concat(' SYM', CAST(l_partkey AS VARCHAR(20)), ' ') AS symbol_text,
               CASE l_returnflag WHEN 'A' THEN ' EQ' WHEN 'N' THEN ' BE ' ELSE ' FUT' END AS series_text,
               CASE WHEN l_orderkey % 11 = 0 THEN ' - ' WHEN l_orderkey % 13 = 0 THEN 'N/A' WHEN l_orderkey % 17 = 0 THEN '12d'
                    ELSE concat(' ', CAST(CAST(floor(l_extendedprice / 1000) AS BIGINT) AS VARCHAR(20)), ',', lpad(CAST(CAST(floor(l_extendedprice) AS BIGINT) % 1000 AS VARCHAR(20)), 3, '0'), '.5') END AS price_text,
               concat(' ', CAST(CAST(l_quantity AS BIGINT) AS VARCHAR(20)), '.75') AS qty_text,
               concat(lpad(CAST(day(l_shipdate) AS VARCHAR(20)), 2, '0'), '-', CASE month(l_shipdate) WHEN 1 THEN 'JAN' WHEN 2 THEN 'Feb' WHEN 3 THEN 'MAR' WHEN 4 THEN 'APR' WHEN 5 THEN 'may' WHEN 6 THEN 'JUN'
                    WHEN 7 THEN 'JUL' WHEN 8 THEN 'Aug' WHEN 9 THEN 'SEP' WHEN 10 THEN 'OCT' WHEN 11 THEN 'NOV' ELSE 'DEC' END, '-', CAST(year(l_shipdate) AS VARCHAR(20))) AS date_text,
               floor(l_extendedprice) AS whole_price, l_quantity, CAST(l_shipdate AS DATE) AS ship_date, l_returnflag, l_partkey
        FROM {lineitem}""",
}


def _filled(sql: str, name) -> str:
    """sql with views put in place of their names; name gives what stands for a table."""
    out = sql
    while any("{" + view + "}" in out for view in VIEWS):
        for view, body in VIEWS.items():
            out = out.replace("{" + view + "}", body)
    for t in TABLES:
        out = out.replace("{" + t + "}", name(t))
    return out


TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def sql(text: str) -> str:
    """text as plain SQL over the given tables; {name} stands for a view (in parentheses) or a table."""
    return _filled(text, lambda t: t)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return query(spark, sf_dir, VIEWS[name])


def query(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    return spark.sql(_filled(text, lambda t: f"parquet.`{sf_dir}/{t}.parquet`"))


def views(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    return list(map(partial(view, spark, sf_dir), names))
