"""Point-in-time membership: snapshots become intervals, and questions about them.

snapshots: snapshot_date, symbol_id, series, listing_date. intervals: symbol_id, series, valid_from,
valid_to (the last date observed, never null), listing_date.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

KEYS = ("symbol_id", "series")


def observations(snapshots: DataFrame) -> DataFrame:
    """snapshot_date, ordinal, previous: the dates that have a snapshot, numbered from 1.

    Its windows have no key, but run on distinct dates only: some thousands, whatever the rows.
    """
    order = W.orderBy("snapshot_date")
    dates = snapshots.select("snapshot_date").distinct()
    return dates.select("snapshot_date", F.row_number().over(order).alias("ordinal"), F.lag("snapshot_date").over(order).alias("previous"))


#: Observation dates are broadcast up to so many (some 180 years of days); beyond, the planner decides.
MOST_DATES = 1 << 16


def _small(dates: DataFrame) -> DataFrame:
    """dates, marked for broadcasting only within MOST_DATES; one count of distinct dates."""
    return F.broadcast(dates) if dates.limit(MOST_DATES + 1).count() <= MOST_DATES else dates


def build_intervals(snapshots: DataFrame) -> DataFrame:
    """One row for each unbroken run of observations of a (symbol, series)."""
    rows = snapshots.groupBy("snapshot_date", *KEYS).agg(F.min("listing_date").alias("listing_date"))
    numbered = rows.join(_small(observations(snapshots)), "snapshot_date")
    island = F.col("ordinal") - F.row_number().over(W.partitionBy(*KEYS).orderBy("snapshot_date"))
    return (
        numbered.withColumn("_island", island)
        .groupBy(*KEYS, "_island")
        .agg(F.min("snapshot_date").alias("valid_from"), F.max("snapshot_date").alias("valid_to"), F.min("listing_date").alias("listing_date"))
        .drop("_island")
    )


def on_date(intervals: DataFrame, day: Column) -> DataFrame:
    return intervals.filter((F.col("valid_from") <= day) & (F.col("valid_to") >= day))


def universe_on(intervals: DataFrame, symbols: DataFrame, day: Column) -> DataFrame:
    """symbol_id, symbol, series of what was listed on the day, by symbol."""
    return on_date(intervals, day).join(symbols.select("symbol_id", "symbol"), "symbol_id").select("symbol_id", "symbol", "series").orderBy("symbol", "series")


def expand(intervals: DataFrame, dates: DataFrame) -> DataFrame:
    """Intervals as one row for each observation date they cover: equality joins on ordinals, no range join."""
    ordinal = _small(dates.select("snapshot_date", "ordinal"))
    at = lambda c, name: ordinal.select(F.col("snapshot_date").alias(c), F.col("ordinal").alias(name))
    spans = intervals.join(at("valid_from", "_a"), "valid_from").join(at("valid_to", "_b"), "valid_to")
    return spans.withColumn("ordinal", F.explode(F.sequence("_a", "_b"))).join(ordinal, "ordinal").select("snapshot_date", *KEYS)


def size_by_date(intervals: DataFrame, dates: DataFrame) -> DataFrame:
    """snapshot_date, n_listed of the dates that any interval covers: a sweep over what begins and ends, two rows for each interval.

    Its window has no key, but runs on distinct observation dates.
    """
    ends = F.array(F.struct(F.col("valid_from").alias("snapshot_date"), F.lit(1).alias("opened"), F.lit(0).alias("closed")), F.struct(F.col("valid_to").alias("snapshot_date"), F.lit(0).alias("opened"), F.lit(1).alias("closed")))
    steps = intervals.select(F.inline(ends)).groupBy("snapshot_date").agg(F.sum("opened").alias("opened"), F.sum("closed").alias("closed"))
    order = W.orderBy("snapshot_date")
    swept = dates.select("snapshot_date").distinct().join(steps, "snapshot_date", "left").fillna(0, ["opened", "closed"])
    listed = F.sum("opened").over(order) - F.coalesce(F.sum("closed").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return swept.select("snapshot_date", listed.alias("n_listed")).filter("n_listed > 0")


#: A number for each date; sums of them tell sets of dates apart.
_MARK = "decimal(38,0)"


def unequal_keys(real: DataFrame, intervals: DataFrame) -> DataFrame:
    """The (symbol, series) whose intervals do not cover just the dates of their rows in real (snapshot_date and keys, distinct).

    The digest of a set of dates is its size and the sum of the dates' hashes; that of an interval is a
    difference of two prefix sums, so nothing is expanded.
    """
    mark = F.xxhash64("snapshot_date").cast(_MARK)
    order = W.orderBy("snapshot_date")
    dates = real.select("snapshot_date").distinct()
    sums = _small(dates.select("snapshot_date", F.sum(mark).over(order).alias("upto"), F.row_number().over(order).cast("long").alias("place"), mark.alias("own")))
    at = lambda name, *columns: sums.select(F.col("snapshot_date").alias(name), *columns)
    spans = intervals.join(at("valid_from", (F.col("upto") - F.col("own")).alias("_a"), F.col("place").alias("_p")), "valid_from", "left").join(at("valid_to", F.col("upto").alias("_b"), F.col("place").alias("_q")), "valid_to", "left")
    covered = spans.groupBy(*KEYS).agg(F.sum(F.col("_q") - F.col("_p") + 1).alias("n"), F.sum(F.col("_b") - F.col("_a")).alias("h"), F.bool_or(F.col("_p").isNull() | F.col("_q").isNull()).alias("odd"))
    seen = real.groupBy(*KEYS).agg(F.count("*").alias("m"), F.sum(mark).alias("g"))
    same = F.col("n").eqNullSafe(F.col("m")) & F.col("h").eqNullSafe(F.col("g")) & ~F.coalesce("odd", F.lit(False))
    return seen.join(covered, list(KEYS), "full_outer").filter(~same).select(*KEYS)


def equivalence(snapshots: DataFrame, intervals: DataFrame) -> DataFrame:
    """One row: snapshot rows that intervals lack, rows they have too much, both sizes, and the reduction in percent.

    Only the intervals of keys whose digests differ are expanded and compared row by row.
    """
    real = snapshots.select("snapshot_date", *KEYS).distinct()
    differ = unequal_keys(real, intervals)
    own = real.join(differ, list(KEYS), "left_semi").withColumn("_n", F.lit(1))
    again = expand(intervals.join(differ, list(KEYS), "left_semi"), observations(snapshots)).distinct().withColumn("_n", F.lit(-1))
    sides = own.unionByName(again).groupBy("snapshot_date", *KEYS).agg(F.sum("_n").alias("_n"))
    parts = [sides.agg(F.count_if(F.col("_n") > 0).alias("missing"), F.count_if(F.col("_n") < 0).alias("extra")), real.agg(F.count("*").alias("n_rows")), intervals.agg(F.count("*").alias("n_intervals"))]
    out = parts[0]
    for p in parts[1:]:  # single rows
        out = out.join(p)
    return out.withColumn("reduction_pct", F.when(F.col("n_rows") > 0, F.round(100.0 * (F.col("n_rows") - F.col("n_intervals")) / F.col("n_rows"), 1)))


def with_previous(intervals: DataFrame) -> DataFrame:
    """Appends `earlier`: the symbol's last interval that began strictly before. Of intervals that began together the later series counts."""
    before = W.partitionBy("symbol_id").orderBy(F.unix_date("valid_from")).rangeBetween(W.unboundedPreceding, -1)
    return intervals.withColumn("earlier", F.max(F.struct("valid_from", "series", "valid_to")).over(before))


def change_kind(previous_observation: Column) -> Column:
    """Why an interval began. SUSPECT_SPLIT: its run did not end, so the interval should have gone on."""
    return (
        F.when(F.col("earlier").isNull(), "new_symbol")
        .when(F.col("earlier.series") != F.col("series"), "series_change")
        .when(F.col("earlier.valid_to") == previous_observation, "SUSPECT_SPLIT")
        .otherwise("gap_relist")
    )


def changes(intervals: DataFrame, dates: DataFrame) -> DataFrame:
    """symbol_id, series, valid_from, kind of every interval that began after the first observation."""
    previous = _small(dates.select(F.col("snapshot_date").alias("valid_from"), "previous"))
    return with_previous(intervals).join(previous, "valid_from").filter(F.col("previous").isNotNull()).select(*KEYS, "valid_from", change_kind(F.col("previous")).alias("kind"))


def closed(intervals: DataFrame, dates: DataFrame) -> DataFrame:
    """Intervals that end before the last observation: closed_on is the next one; reappears: as another series of the symbol on that date."""
    following = _small(dates.select(F.col("previous").alias("valid_to"), F.col("snapshot_date").alias("closed_on")).filter("valid_to IS NOT NULL"))
    ended = intervals.join(following, "valid_to").select(*KEYS, "valid_from", "valid_to", "closed_on")
    begun = intervals.select("symbol_id", F.col("valid_from").alias("closed_on")).distinct().withColumn("reappears", F.lit(True))
    return ended.join(begun, ["symbol_id", "closed_on"], "left").withColumn("reappears", F.coalesce("reappears", F.lit(False)))


def latest_two(dates: DataFrame) -> DataFrame:
    return dates.select("snapshot_date").distinct().orderBy(F.desc("snapshot_date")).limit(2)


def report_verdict(changed: DataFrame) -> DataFrame:
    """One row: changes by kind, and whether the report fails."""
    kinds = ("new_symbol", "series_change", "gap_relist", "SUSPECT_SPLIT")
    return changed.agg(*(F.count_if(F.col("kind") == k).alias(k.lower()) for k in kinds)).withColumn("verdict", F.when(F.col("suspect_split") > 0, "fail").otherwise("ok"))


def opened_since(intervals: DataFrame, since: Column, previous: Column) -> DataFrame:
    """Intervals that began on `since` or later, with the interval before them and the kind of change."""
    return with_previous(intervals).filter(F.col("valid_from") >= since).withColumn("kind", change_kind(previous))


def closed_at(intervals: DataFrame, opened: DataFrame, previous: Column) -> DataFrame:
    """Intervals that end on `previous`; reappears: their symbol is among those opened."""
    again = opened.select("symbol_id").distinct().withColumn("reappears", F.lit(True))
    return intervals.filter(F.col("valid_to") == previous).join(again, "symbol_id", "left").withColumn("reappears", F.coalesce("reappears", F.lit(False)))


def change_report(intervals: DataFrame, latest: Column, previous: Column, since: Column | None = None) -> DataFrame:
    """The report of one observation: section, symbol_id, series, valid_from, valid_to, note, n.

    Sections: size (of the previous and the latest day), opened (since the latest day, or `since`; note: the
    kind), kind (how many of each), closed (at the previous day; note: whether the symbol opened anew), and
    verdict (FAIL if an interval was split that should have gone on; n: how many).
    """
    opened = opened_since(intervals, latest if since is None else since, previous)
    whole = ("symbol_id", "series", "valid_from", "valid_to")
    none = [F.lit(None).cast(intervals.schema[c].dataType).alias(c) for c in whole]
    row = lambda section, columns, note, n: (F.lit(section).alias("section"), *columns, note.alias("note"), n.cast("long").alias("n"))
    days = intervals.select(F.explode(F.filter(F.array(previous, latest), lambda d: d.isNotNull())).alias("day"), "valid_from", "valid_to").filter("valid_from <= day AND valid_to >= day")
    sizes = days.groupBy("day").agg(F.count("*").alias("n")).select(*row("size", none, F.col("day").cast("string"), F.col("n")))
    kinds = opened.groupBy("kind").agg(F.count("*").alias("n")).select(*row("kind", none, F.col("kind"), F.col("n")))
    note = F.when(F.col("reappears"), "reappears under another series").otherwise("absent from the latest list")
    split = opened.agg(F.count_if(F.col("kind") == "SUSPECT_SPLIT").alias("n"))
    parts = [
        sizes, kinds, opened.select(*row("opened", whole, F.col("kind"), F.lit(None))), closed_at(intervals, opened, previous).select(*row("closed", whole, note, F.lit(None))),
        split.select(*row("verdict", none, F.when(F.col("n") > 0, "FAIL").otherwise("OK"), F.col("n"))),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def record_snapshot(intervals: DataFrame, today: DataFrame, day: Column, previous: Column) -> DataFrame:
    """The intervals after one more snapshot: those that reach `previous` go on to `day`, other rows open a new one.

    previous comes from the table of observations and is null on the first day. An end never moves
    back, so a snapshot of an older day does not shorten an interval. An empty snapshot changes nothing.
    """
    seen = today.groupBy(*KEYS).agg(F.min("listing_date").alias("_new")).withColumn("_seen", F.lit(True))
    able = (F.col("valid_to") >= F.coalesce(previous, day)) & (F.col("valid_from") <= day)
    grown = intervals.filter(able).join(seen, list(KEYS), "full_outer")
    out = grown.select(
        *KEYS,
        F.coalesce("valid_from", day).alias("valid_from"),
        F.when(F.col("_seen").isNull(), F.col("valid_to")).otherwise(F.greatest(F.coalesce("valid_to", day), day)).alias("valid_to"),
        F.coalesce("listing_date", "_new").alias("listing_date"),
    )
    return out.unionByName(intervals.filter(~able).select(out.columns))


def record_snapshots(intervals: DataFrame, known: DataFrame, snapshots: DataFrame) -> DataFrame:
    """The intervals after any number of snapshots, of new, late or repeated days in any order, in one plan.

    known: snapshot_date of all observations that the intervals come from. A day that is new and falls inside
    an interval splits it, unless the day's snapshot has its symbol and series, and may join two that it lies
    between. New days that follow each other without a known one between are a block: an interval is cut at the
    blocks inside it, not day by day, and what the new snapshots hold closes the cuts. Rows of a day that is
    known add to it. Both parts of a split interval keep its listing date; joined ones take the earlier.
    """
    before = known.select("snapshot_date").distinct().withColumn("_known", F.lit(True))
    order = W.orderBy("snapshot_date")  # distinct dates, as in observations()
    dates = snapshots.select("snapshot_date").distinct().join(before, "snapshot_date", "full_outer").select("snapshot_date", F.col("_known").isNull().alias("new"))
    dates = dates.select("snapshot_date", "new", F.row_number().over(order).alias("ordinal"), (F.col("new") & ~F.coalesce(F.lag("new").over(order), F.lit(False))).cast("int").alias("_opens"))
    dates = _small(dates.select("snapshot_date", "new", "ordinal", F.sum("_opens").over(order).alias("block")))
    blocks = dates.filter("new").groupBy("block").agg(F.min("ordinal").alias("low"), F.max("ordinal").alias("high"))
    at = lambda name, *columns: dates.select(F.col("snapshot_date").alias(name), *columns)
    spans = intervals.join(at("valid_from", F.col("ordinal").alias("_a"), F.col("block").alias("_j")), "valid_from").join(at("valid_to", F.col("ordinal").alias("_b"), F.col("block").alias("_k")), "valid_to")
    # Blocks _j + 1 to _k lie inside; the part number p begins behind block p and ends before block p + 1.
    parts = spans.select(*KEYS, "listing_date", "_a", "_b", "_j", "_k", F.explode(F.sequence("_j", "_k")).alias("_p"))
    behind, ahead = blocks.select(F.col("block").alias("_p"), "high"), blocks.select((F.col("block") - 1).alias("_p"), "low")
    parts = parts.join(behind, "_p", "left").join(ahead, "_p", "left")
    held = parts.select(*KEYS, "listing_date", F.when(F.col("_p") == F.col("_j"), F.col("_a")).otherwise(F.col("high") + 1).alias("a"), F.when(F.col("_p") == F.col("_k"), F.col("_b")).otherwise(F.col("low") - 1).alias("b"))
    seen = snapshots.groupBy("snapshot_date", *KEYS).agg(F.min("listing_date").alias("listing_date")).join(at("snapshot_date", "ordinal"), "snapshot_date")
    whole = held.unionByName(seen.select(*KEYS, "listing_date", F.col("ordinal").alias("a"), F.col("ordinal").alias("b")))
    own = W.partitionBy(*KEYS).orderBy("a", "b")
    apart = F.col("a") > F.max("b").over(own.rowsBetween(W.unboundedPreceding, -1)) + 1
    merged = whole.withColumn("_new", F.coalesce(apart, F.lit(True)).cast("int")).withColumn("_n", F.sum("_new").over(own))
    merged = merged.groupBy(*KEYS, "_n").agg(F.min("a").alias("a"), F.max("b").alias("b"), F.min("listing_date").alias("listing_date"))
    day = lambda ordinal, name: dates.select(F.col("ordinal").alias(ordinal), F.col("snapshot_date").alias(name))
    return merged.join(day("a", "valid_from"), "a").join(day("b", "valid_to"), "b").select(*KEYS, "valid_from", "valid_to", "listing_date")
