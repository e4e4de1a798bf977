"""Data-quality rules. Findings: check_name, severity, detail, symbol_id, trade_date."""

from __future__ import annotations

from collections.abc import Collection, Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import MAX_PLAUSIBLE_FACTOR, SERIES, adjustment_factor, volume_consistent

FINDING = ("check_name", "severity", "detail", "symbol_id", "trade_date")
STATUSES, SEVERITIES, RUN_STATUSES = ("loaded", "partial", "no_data", "failed"), ("info", "warning", "error"), ("running", "succeeded", "halted", "failed")


def ohlc_rules() -> dict[str, Column]:
    """What is wrong with a bar, by name. Nulls break no rule."""
    c = F.col
    return {
        "high below low": c("high") < c("low"),
        "high below open or close": (c("high") < c("open")) | (c("high") < c("close")),
        "low above open or close": (c("low") > c("open")) | (c("low") > c("close")),
        "price not positive": (c("open") <= 0) | (c("close") <= 0),
        "negative volume": c("volume") < 0,
    }


def _findings(df: DataFrame, check: str, severity: str, detail: Column, symbol: Column | None = None) -> DataFrame:
    return df.select(F.lit(check).alias("check_name"), F.lit(severity).alias("severity"), detail.alias("detail"), (F.col("symbol_id") if symbol is None else symbol).cast("long").alias("symbol_id"), "trade_date")


def ohlc_findings(bars: DataFrame) -> DataFrame:
    """One error for each broken rule of each bar."""
    broken = F.array_compact(F.array(*(F.when(rule, F.lit(name)) for name, rule in ohlc_rules().items())))
    return _findings(bars.select("symbol_id", "trade_date", F.explode(broken).alias("rule")), "ohlc_insane", "error", F.col("rule"))


def duplicate_keys(bars: DataFrame) -> DataFrame:
    """symbol_id, trade_date, series, n of keys that occur more than once."""
    return bars.groupBy("symbol_id", "trade_date", "series").agg(F.count("*").alias("n")).filter("n > 1")


def _broken_rules(bars: DataFrame) -> Column:
    """array<struct<check_name, detail>>: what is wrong with a row of bars by itself."""
    found = [F.when(rule, F.struct(F.lit("ohlc_insane").alias("check_name"), F.lit(name).alias("detail"))) for name, rule in ohlc_rules().items()]
    other_day = F.col("file_date").isNotNull() & (F.col("file_date") != F.col("trade_date"))
    found.append(F.when(other_day, F.struct(F.lit("date_mismatch").alias("check_name"), F.concat(F.lit("bar dated "), F.col("file_date").cast("string")).alias("detail"))))
    return F.array_compact(F.array(*found))


def batch_findings(bars: DataFrame, expected: DataFrame | None = None) -> DataFrame:
    """All structural findings of all trade dates in one scan of bars; expected dates without bars give empty_batch (a second scan, of dates only).

    Every row counts once for its key; what is wrong with it is counted beside. The counts are summed
    before the exchange, so a key that many rows share costs no more than others.
    """
    key = F.struct(F.lit("duplicate_bar").alias("check_name"), F.concat_ws(" ", F.lit("series"), "series").alias("detail"))
    rows = bars.select("symbol_id", "trade_date", "series", F.explode(F.concat(F.array(key), _broken_rules(bars))).alias("f"))
    counted = rows.groupBy("symbol_id", "trade_date", "series", "f").agg(F.count("*").alias("n"))
    of_key = F.col("f.check_name") == "duplicate_bar"
    times = F.when(of_key, F.when(F.col("n") > 1, 1).otherwise(0)).otherwise(F.col("n")).cast("int")
    out = counted.select("symbol_id", "trade_date", "f", F.explode(F.array_repeat(F.lit(1), times)))
    out = out.select("f.check_name", F.lit("error").alias("severity"), "f.detail", F.col("symbol_id").cast("long").alias("symbol_id"), "trade_date")
    if expected is not None:
        empty = expected.join(bars.select("trade_date").distinct(), "trade_date", "left_anti")
        out = out.unionByName(_findings(empty, "empty_batch", "error", F.lit("no bars"), F.lit(None)))
    return out


def judged_dates(bars: DataFrame) -> DataFrame:
    """trade_date, n_bars, n_delivery and has_error (any structural finding) of every trade date, in one scan."""
    keys = bars.groupBy("symbol_id", "trade_date", "series").agg(F.count("*").alias("n"), F.count("deliv_pct").alias("d"), F.bool_or(F.size(_broken_rules(bars)) > 0).alias("broken"))
    return keys.groupBy("trade_date").agg(F.sum("n").alias("n_bars"), F.sum("d").alias("n_delivery"), F.bool_or(F.col("broken") | (F.col("n") > 1)).alias("has_error"))


def accepted(bars: DataFrame, findings: DataFrame) -> DataFrame:
    """Bars of trade dates without an error: a date with one is rejected whole."""
    bad = findings.filter("severity = 'error'").select("trade_date").distinct()
    return bars.join(bad, "trade_date", "left_anti")


def paired_closes(raw: DataFrame, adjusted: DataFrame) -> DataFrame:
    """symbol_id, trade_date, series and both closes and volumes, for all dates at once."""
    a = adjusted.select("symbol_id", "trade_date", F.col("close").alias("adj_close"), F.col("volume").alias("adj_volume"))
    r = raw.select("symbol_id", "trade_date", "series", F.col("close").alias("raw_close"), F.col("volume").alias("raw_volume"))
    return r.join(a, ["symbol_id", "trade_date"])


def judged_pairs(pairs: DataFrame) -> DataFrame:
    """Appends the factor and the first rule that a pair fails: uncomputable, implausible, then volume."""
    factor = adjustment_factor(F.col("raw_close"), F.col("adj_close"))
    implausible = (F.col("factor") > MAX_PLAUSIBLE_FACTOR) | (F.col("factor") < 1 / MAX_PLAUSIBLE_FACTOR)
    fits = volume_consistent(F.col("factor"), F.col("raw_volume"), F.col("adj_volume"))
    check = F.when(F.col("factor").isNull(), "factor_uncomputable").when(implausible, "implausible_factor").when(~fits, "volume_factor_mismatch")
    return pairs.withColumn("factor", factor).withColumn("check_name", check)


def cross_findings(pairs: DataFrame) -> DataFrame:
    severity = F.when(F.col("check_name") == "implausible_factor", "error").otherwise("warning")
    found = judged_pairs(pairs).filter("check_name IS NOT NULL")
    return found.select("check_name", severity.alias("severity"), F.concat_ws(" ", F.lit("series"), "series").alias("detail"), F.col("symbol_id").cast("long").alias("symbol_id"), "trade_date")


def adjustment_factors(pairs: DataFrame) -> DataFrame:
    """symbol_id, trade_date, factor (8 places). Of several series EQ, then BE, then BZ counts."""
    usable = judged_pairs(pairs).filter(F.col("check_name").isNull() | (F.col("check_name") == "volume_factor_mismatch"))
    rank = F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, SERIES)), F.col("series")), F.lit(0)), F.lit(len(SERIES) + 1))
    best = usable.groupBy("symbol_id", "trade_date").agg(F.min_by("factor", F.struct(rank, "series")).alias("factor"))
    return best.select("symbol_id", "trade_date", F.round("factor", 8).alias("factor"))


def severity_rollup(findings: DataFrame) -> DataFrame:
    """One row: how many findings of each severity, and whether there is an error."""
    counts = (F.count_if(F.col("severity") == s).alias(f"n_{s}") for s in SEVERITIES)
    return findings.agg(*counts).withColumn("has_errors", F.col("n_error") > 0)


def first_errors(findings: DataFrame, n: int = 20) -> DataFrame:
    return findings.filter("severity = 'error'").orderBy("trade_date", "symbol_id", "check_name", "detail").limit(n)


PRICES = ("open", "high", "low", "close")


def bar_constraints(columns: Collection[str] | None = None, keys: tuple[str, ...] = ("symbol_id", "trade_date", "series")) -> dict[str, Column]:
    """The rules of stored bars; of a table that lacks some of the columns what the others show."""
    c, has = F.col, lambda *names: columns is None or set(names) <= set(columns)
    either = lambda *rules: F.coalesce(reduce(or_, rules, F.lit(False)), F.lit(False))
    shape = [rule for names, rule in ((("high", "low"), c("high") < c("low")), (("high", "open"), c("high") < c("open")), (("high", "close"), c("high") < c("close")), (("low", "open"), c("low") > c("open")), (("low", "close"), c("low") > c("close"))) if has(*names)]
    return {
        "not_null": _any_null(*keys, *(n for n in PRICES if has(n))), "ohlc": either(*shape),
        "positive": either(*(c(n) <= 0 for n in ("open", "close") if has(n))), "volume": either(*(c(n) < 0 for n in ("volume",) if has(n))),
    }


def _any_null(*names: str) -> Column:
    out = F.lit(False)
    for name in names:
        out = out | F.col(name).isNull()
    return out


CONSTRAINTS = {
    "bars": bar_constraints,
    "adjusted": lambda columns=None: bar_constraints(columns, ("symbol_id", "trade_date")),
    "runs": lambda: {"not_null": _any_null("run_id", "event_time"), "status": ~F.coalesce(F.col("status").isin(*RUN_STATUSES), F.lit(False))},
    "membership": lambda: {"range": F.col("valid_to") < F.col("valid_from"), "not_null": _any_null("symbol_id", "series", "valid_from", "valid_to")},
    "log": lambda: {"status": ~F.coalesce(F.col("status").isin(*STATUSES), F.lit(False))},
    "findings": lambda: {"severity": ~F.coalesce(F.col("severity").isin(*SEVERITIES), F.lit(False))},
    "actions": lambda: {"not_null": F.col("symbol_id").isNull() | F.col("ex_date").isNull() | F.col("purpose").isNull() | F.col("source").isNull()},
    "symbols": lambda: {"not_null": F.col("isin").isNull() | F.col("symbol").isNull() | F.col("first_seen").isNull() | F.col("last_seen").isNull()},
    "factors": lambda: {"positive": ~F.coalesce(F.col("factor") > 0, F.lit(False))},
}


def violations(df: DataFrame, rules: Mapping[str, Column], unique: tuple[str, ...] = ()) -> DataFrame:
    """rule, n: how many rows break each rule (keys, for uniqueness); rules that hold are not listed. Keys with nulls never repeat."""
    broken = F.array_compact(F.array(*(F.when(F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items())))
    out = df.select(F.explode(broken).alias("rule")).groupBy("rule").agg(F.count("*").alias("n"))
    if unique:
        repeated = df.dropna(subset=list(unique)).groupBy(*unique).agg(F.count("*").alias("_n")).filter("_n > 1").agg(F.count("*").alias("n"))
        out = out.unionByName(repeated.filter("n > 0").select(F.lit("unique").alias("rule"), "n"))
    return out


def assert_constraints(df: DataFrame, rules: Mapping[str, Column], unique: tuple[str, ...] = ()) -> DataFrame:
    """df, if it breaks no rule; this runs a job."""
    broken = {r["rule"]: r["n"] for r in violations(df, rules, unique).collect()}  # a row a rule
    if broken:
        raise ValueError(f"constraints broken: {broken}")
    return df


#: The keys that each table's rows are unique by.
UNIQUE = {"bars": ("symbol_id", "trade_date", "series"), "membership": ("symbol_id", "series", "valid_from"), "log": ("source", "data_date"), "findings": (), "actions": ("symbol_id", "ex_date", "purpose"), "symbols": ("isin",), "factors": ("symbol_id", "trade_date"), "adjusted": ("symbol_id", "trade_date"), "runs": ()}


def guarded(df: DataFrame, table: str | None) -> DataFrame:
    """df, which fails when a row is computed that breaks a constraint of the table: the check is part of the write that it guards.

    Bars that lack a column are judged by the others. Uniqueness is not seen row by row.
    """
    for name, rule in rules_of(df, table).items():
        df = df.filter(F.when(F.coalesce(rule, F.lit(False)), F.raise_error(F.lit(f"constraints broken: {name} of {table}"))).otherwise(F.lit(True)))
    return df


def rules_of(df: DataFrame, table: str | None) -> dict[str, Column]:
    if table in ("bars", "adjusted"):
        return CONSTRAINTS[table](df.columns)
    return CONSTRAINTS[table]() if table else {}


def refused_rows(df: DataFrame, table: str) -> DataFrame:
    """Rows of df that the table would refuse, once for each rule they break."""
    broken = F.array_compact(F.array(*(F.when(F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules_of(df, table).items())))
    return df.withColumn("rule", F.explode(broken))


def storable(df: DataFrame, table: str) -> DataFrame:
    """df, if it keeps the constraints of the stored table; this runs a job."""
    return assert_constraints(df, CONSTRAINTS[table](), UNIQUE[table])


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Rows of child whose key is not in parent; null keys refer to nothing and are no orphans."""
    return child.filter(F.col(key).isNotNull()).join(parent.select(key).distinct(), key, "left_anti")
