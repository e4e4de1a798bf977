"""Keyed, idempotent upserts whose conflict rules differ by column.

A rule says what a column becomes when a key exists: "new" (the update's value), "fill" (the update's
value unless null), "least", "greatest" or "old" (never touched). Keys that are new take the update's
values. The result is a DataFrame; `write_partitions` stores it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .quality import guarded

RULES = {
    "new": lambda new, old: new,
    "fill": lambda new, old: F.coalesce(new, old),
    "least": lambda new, old: F.least(new, old),
    "greatest": lambda new, old: F.greatest(new, old),
    "old": lambda new, old: old,
}

#: Keys and rules of the stored tables.
SYMBOLS = (("isin",), {"symbol": "new", "name": "fill", "face_value": "fill", "first_seen": "least", "last_seen": "greatest"})
RAW_BARS = (("symbol_id", "trade_date", "series"), {**dict.fromkeys(("open", "high", "low", "close", "prev_close", "last_price", "volume", "turnover", "trades", "source"), "new"), "deliv_qty": "fill", "deliv_pct": "fill"})
ADJUSTED_BARS = (("symbol_id", "trade_date"), dict.fromkeys(("open", "high", "low", "close", "volume", "source"), "new"))
ACTIONS = (("symbol_id", "ex_date", "purpose"), {"face_value": "fill", "source": "old"})
FACTORS = (("symbol_id", "trade_date"), {"factor": "new"})
LOG = (("source", "data_date"), {"status": "new", "rows_loaded": "new", "run_id": "new"})


def last_by_key(updates: DataFrame, keys: Sequence[str], *order: Column | str) -> DataFrame:
    """Of updates with one key the last in the given order."""
    w = W.partitionBy(*keys).orderBy(*(F.desc(c) if isinstance(c, str) else c.desc() for c in order))
    return updates.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def applied_in_order(updates: DataFrame, keys: Sequence[str], rules: Mapping[str, str], *order: str) -> DataFrame:
    """One update for each key that has the effect of all its updates one after the other."""
    at = F.struct(*order)
    merged = {
        "new": lambda c: F.max_by(F.col(c), at),
        "fill": lambda c: F.max_by(F.col(c), F.when(F.col(c).isNotNull(), at)),
        "least": F.min,
        "greatest": F.max,
        "old": lambda c: F.min_by(F.col(c), at),
    }
    return updates.groupBy(*keys).agg(*(merged[r](c).alias(c) for c, r in rules.items() if c in updates.columns))


def keyed_upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str], rules: Mapping[str, str]) -> DataFrame:
    """target after updates (one for each key). Null key values match each other. Columns without a rule keep the old value."""
    old, new = target.alias("o"), updates.alias("n")
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}"))
    marked_old, marked_new = target.withColumn("_old", F.lit(True)).alias("o"), updates.withColumn("_new", F.lit(True)).alias("n")
    both = marked_old.join(marked_new, same, "full_outer")
    is_old, is_new = F.col("_old").isNotNull(), F.col("_new").isNotNull()

    def value(c: str) -> Column:
        o = F.col(f"o.{c}")
        if c not in updates.columns:
            return o
        n = F.col(f"n.{c}")
        if c in keys:
            return F.when(is_old, o).otherwise(n)
        return F.when(is_old & is_new, RULES[rules.get(c, "old")](n, o)).when(is_old, o).otherwise(n)

    return both.select(*(value(c).cast(target.schema[c].dataType).alias(c) for c in target.columns))


def insert_missing(target: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key target lacks; existing rows stay as they are."""
    return target.unionByName(rows.join(target.select(*keys).distinct(), list(keys), "left_anti").select(target.columns))


def ticker_ids(symbols: DataFrame) -> DataFrame:
    """symbol, symbol_id: of symbols that share a ticker the one seen last, then the smaller ISIN."""
    w = W.partitionBy("symbol").orderBy(F.desc_nulls_last("last_seen"), "isin")
    return symbols.withColumn("_n", F.row_number().over(w)).filter("_n = 1").select("symbol", "symbol_id")


def ticker_collisions(symbols: DataFrame) -> DataFrame:
    return symbols.groupBy("symbol").agg(F.count("*").alias("n")).filter("n > 1")


def with_ids(rows: DataFrame, ids: DataFrame, on: str) -> tuple[DataFrame, DataFrame]:
    """(rows with their symbol_id, rows whose key nobody knows)."""
    return rows.join(ids, on), rows.join(ids.select(on), on, "left_anti")


def new_symbol_ids(symbols: DataFrame, rows: DataFrame, prefix: int = 6) -> DataFrame:
    """isin, symbol_id of ISINs that symbols lacks: numbered on from the largest id, by ISIN.

    ISINs are numbered within their first `prefix` characters; only the counts of those are summed in
    one window without a key.
    """
    new = rows.select("isin").filter("isin IS NOT NULL").distinct().join(symbols.select("isin"), "isin", "left_anti").withColumn("_p", F.substring("isin", 1, prefix))
    top = symbols.agg(F.coalesce(F.max("symbol_id"), F.lit(0)).alias("_top"))
    before = F.coalesce(F.sum("_k").over(W.orderBy("_p").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = new.groupBy("_p").agg(F.count("*").alias("_k")).select("_p", before.alias("_before"))
    numbered = new.withColumn("_n", F.row_number().over(W.partitionBy("_p").orderBy("isin"))).join(starts, "_p")
    return numbered.join(F.broadcast(top)).select("isin", (F.col("_top") + F.col("_before") + F.col("_n")).cast("long").alias("symbol_id"))


def seen_symbols(symbols: DataFrame, listed: DataFrame, today: Column) -> DataFrame:
    """symbols after a listing (isin, symbol, name, face_value, listing_date) of the day, with ids for new ISINs.

    A new ISIN was first seen on its listing date, or today if the listing has none. Of rows with one ISIN
    the one with the last symbol in the order of text counts.
    """
    rows = last_by_key(listed.filter("isin IS NOT NULL"), ("isin",), "symbol", "name", "face_value")
    updates = rows.select("isin", "symbol", F.nullif(F.trim("name"), F.lit("")).alias("name"), "face_value", F.coalesce("listing_date", today).alias("first_seen"), today.alias("last_seen"))
    ids = new_symbol_ids(symbols, updates).unionByName(symbols.select("isin", "symbol_id"))
    return keyed_upsert(symbols, updates.join(ids, "isin"), *SYMBOLS)


def symbols_by_ticker(symbols: DataFrame, limit: int = 0) -> DataFrame:
    """isin, symbol_id, symbol in the order of tickers; the first `limit`, or all for 0."""
    out = symbols.select("isin", "symbol_id", "symbol").orderBy("symbol", "isin")
    return out.limit(limit) if limit else out


def write_partitions(df: DataFrame, path: str, month_of: str, table: str | None = None) -> None:
    """Replaces the months that df has rows of; other months stay. df must hold those months whole.

    A row that breaks a constraint of `table` fails the write, which then replaces nothing. Rows meet by
    month before, so that a month is one file and not one of every task; Spark cuts months that are large.
    """
    months = guarded(df, table).withColumn("trade_month", F.date_format(month_of, "yyyy-MM")).hint("rebalance", "trade_month")
    months.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("trade_month").parquet(path)


def stored_months(spark: SparkSession, path: str, schema: StructType, months: Sequence[str] | None) -> DataFrame:
    """The rows of those months, or of all; none if nothing is stored yet."""
    stored = StructType([*schema.fields, StructField("trade_month", StringType())])
    try:
        rows = spark.read.schema(stored).parquet(path)
        return (rows if months is None else rows.filter(F.col("trade_month").isin(list(months)))).drop("trade_month")
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], schema)


def months_of(rows: DataFrame, month_of: str) -> list[str]:
    return [r["m"] for r in rows.select(F.date_format(month_of, "yyyy-MM").alias("m")).distinct().collect()]


def months_after(spark: SparkSession, path: str, schema: StructType, updates: DataFrame, keys: Sequence[str], rules: Mapping[str, str], month_of: str, months: Sequence[str] | None = None) -> DataFrame:
    """The rows that the months of updates (one for each key) hold after them. Only those months of the stored table are read. months: those of updates, where they are known; else updates are worked out once more for them."""
    old = stored_months(spark, path, schema, months_of(updates, month_of) if months is None else months)
    return keyed_upsert(old, updates, keys, rules)


def upsert_months(spark: SparkSession, path: str, schema: StructType, updates: DataFrame, keys: Sequence[str], rules: Mapping[str, str], month_of: str, table: str | None = None, months: Sequence[str] | None = None) -> None:
    """Upserts into a table that is stored by month: reads and replaces the months that updates touch, if the rows keep the constraints of `table`.

    Doing it again changes nothing, so a batch that is lost half-way is simply done again. Keys hold
    month_of, so that a key never moves to another month.
    """
    write_partitions(months_after(spark, path, schema, updates, keys, rules, month_of, months), path, month_of, table)
