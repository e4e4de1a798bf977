"""Hard negatives: rows of other labels whose scores lie in a window under the score of a positive.

The score of a row is its inner product with the anchor. An anchor's positives are its k best other rows
of its own label; each has a window of scores, from a share of its score up to a share of its score. The
windows of an anchor overlap, so they are not searched one by one: the different upper limits of its
windows cut the scores into disjoint slots, and the best rows of every slot are kept. A window begins at
the top of its slot and goes down, so what it holds first is the best of its slot, then of the next one
down, and so on: merges from the lowest slot upward give the answer of every window, and the window's
lower limit then cuts its tail.

The work is tiled like the exact search: rows are dealt into shards of bounded bytes by the hash of their
number, every anchor visits every shard, a task multiplies some anchors at a time by its shard and keeps
the best of each list, and the lists of an anchor (of a slot) are merged in rounds of `fan_in`. It does
so twice: first for the positives, then for the slots. Only anchors are copied, nothing is broadcast.

Vectors that are null or hold a null or non-finite component take no part, nor do rows with a null id or
label. Vectors are compared with vectors of the same length only. Rows are rows: one that repeats an id is
a row of its own, and an anchor leaves out its own row only. Ties go to the smaller id, then to the
earlier row. A window whose lower limit lies above its upper one (of a negative score, as a rule) is
empty. Anchors without positives, and positives without negatives, give no rows, nor do empty tables. Vectors of
any length are read whole; scores that could pass 64 bits fail. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from .common import give_back, table, written
from .topk import FAN_IN, LEAST_ROWS, SHARD_BYTES, whole_vectors

POSITIVES, NEGATIVES = 5, 5
#: The window under a positive's score: from and up to so many hundredths of it.
LOW, HIGH = 80, 100
#: Scores that a task holds at once.
_SCORES = 1 << 20

LISTS = "row long, slot int, found long, id long, score long, shard long"


def best(scores, at, k: int):
    """Of the positions `at` (ascending) those of the k highest scores, highest first; of equal ones the earlier."""
    import numpy as np

    if len(at) > k:
        edge = np.partition(scores[at], len(at) - k)[len(at) - k]
        at = at[scores[at] >= edge]
    return at[np.argsort(-scores[at], kind="stable")][:k]


def positives_of(scores, same, k: int, limits, floor) -> list:
    """(slot 0, positions) of the k best rows of the anchor's own label."""
    import numpy as np

    return [(0, best(scores, np.nonzero(same)[0], k))]


def slots_of(scores, same, k: int, limits, floor) -> list:
    """(slot, positions): the k best rows of other labels in each slot. limits: the slots' upper ends, descending; floor: the last one's lower end."""
    import numpy as np

    at = np.nonzero(~same & (scores <= limits[0]) & (scores >= floor))[0]
    slot = np.searchsorted(-limits, -scores[at], side="right") - 1
    return [(int(j), best(scores, at[slot == j], k)) for j in np.unique(slot)]


def _tiles(k: int, choose):
    """For rows sorted by shard, dim, asks and id: what `choose` takes for each anchor in its shard."""

    def columns(part: pa.RecordBatch, dim: int) -> tuple:
        import pyarrow.compute as pc

        whole = (part.column(n).to_numpy(zero_copy_only=False) for n in ("row", "id", "label"))
        return (*whole, pc.list_flatten(part.column("v")).to_numpy(zero_copy_only=False).reshape(part.num_rows, dim))

    def tile(asked: tuple, limits: list, floors, held: tuple, shard: int) -> Iterator[pa.RecordBatch]:
        import numpy as np

        (a_rows, _, a_labels, a), (rows, ids, labels, c) = asked, held
        top = float(np.abs(a).max(initial=0)) * float(np.abs(c).max(initial=0)) * max(1, a.shape[1])
        if top >= 2.0**63:
            raise OverflowError("inner products may pass 64 bits")
        kind = np.float64 if top < 2.0**53 else np.int64  # exact either way
        a, c = a.astype(kind), c.astype(kind)
        for lo in range(0, len(a), step := max(1, _SCORES // len(c))):
            found = []
            for r, line in enumerate((a[lo : lo + step] @ c.T).astype(np.int64), lo):
                other = rows != a_rows[r]
                own = [np.asarray(limits[r], np.int64), floors[r]] if limits else [None, None]
                for slot, at in choose(line[other], (labels == a_labels[r])[other], k, *own):
                    at = np.nonzero(other)[0][at]
                    found.append((np.full(len(at), a_rows[r]), np.full(len(at), slot), rows[at], ids[at], line[at]))
            if found:
                row, slot, at, id_, score = map(np.concatenate, zip(*found))
                yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(slot, pa.int32()), pa.array(at), pa.array(id_), pa.array(score), pa.array(np.full(len(row), shard))], names=["row", "slot", "found", "id", "score", "shard"])

    def per_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        at, held = None, []
        for batch in batches:
            kinds = np.stack([batch.column(n).to_numpy(zero_copy_only=False).astype(np.int64) for n in ("shard", "dim", "asks")], 1)
            cuts = np.r_[0, np.nonzero((kinds[1:] != kinds[:-1]).any(1))[0] + 1, len(kinds)]
            for lo, hi in zip(cuts, cuts[1:]):
                if lo == hi:
                    continue
                shard, dim, asks = kinds[lo].tolist()
                if (shard, dim) != at:
                    at, held = (shard, dim), []
                part = batch.slice(lo, hi - lo)
                if not asks:
                    held.append(columns(part, dim))
                elif held:
                    held = [tuple(np.concatenate(x) for x in zip(*held))]
                    limits = part.column("limits").to_pylist() if choose is slots_of else []
                    yield from tile(columns(part, dim), limits, part.column("floor").to_numpy(zero_copy_only=False), held[0], shard)
        give_back()

    return per_partition


def _searched(rows: DataFrame, anchors: DataFrame, shards: int, k: int, choose, fan_in: int) -> DataFrame:
    """row, slot, found, id, score: the k best of each anchor and slot over all shards."""
    own = ["dim", "row", "id", "label", "v"]
    none = [F.lit(None).cast("array<long>").alias("limits"), F.lit(0).cast("long").alias("floor")]
    held = rows.select(F.pmod(F.xxhash64("row"), F.lit(shards)).alias("shard"), F.lit(False).alias("asks"), *own, *none)
    asked = anchors.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"), F.lit(True).alias("asks"), *own, "limits", "floor")
    dealt = held.union(asked).repartitionById(shards, F.col("shard").cast("int")).sortWithinPartitions("shard", "dim", "asks", "id", "row")
    lists = dealt.mapInArrow(_tiles(k, choose), LISTS)
    while True:
        shards = -(-shards // fan_in)
        order = W.partitionBy("row", "slot", "shard").orderBy(F.desc("score"), "id", "found")
        lists = lists.withColumn("shard", F.floor(F.col("shard") / fan_in)).withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= k).drop("_n")
        if shards <= 1:
            return lists.drop("shard")


def mine(vectors: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, shard_bytes: int = SHARD_BYTES, least_rows: int = LEAST_ROWS, fan_in: int = FAN_IN) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score, by the windows [low, high] in hundredths of a positive's score.

    vectors: id long, v array<long> and label, none of them null. is_anchor tells the anchors.
    """
    rows = written(vectors.select("id", "v", F.col("label").cast("long").alias("label"), F.coalesce(is_anchor, F.lit(False)).alias("asks"), F.size("v").alias("dim"), F.monotonically_increasing_id().alias("row")), "vectors")
    size = rows.agg(F.count("*").alias("n"), F.coalesce(F.max("dim"), F.lit(0)).alias("dim")).first()
    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shards = max(1, -(-size["n"] * 8 * max(1, size["dim"]) // shard_bytes), min(parts, size["n"] // least_rows))
    anchors = rows.filter("asks").drop("asks")
    first = anchors.withColumns({"limits": F.lit(None).cast("array<long>"), "floor": F.lit(0).cast("long")})
    share = lambda hundredths, up: (F.lit(1) if up else F.lit(-1)) * F.expr(f"floor({'' if up else '-'}score * {hundredths}BD / 100)").cast("long")
    good = _searched(rows, first, shards, positives, positives_of, fan_in).select("row", F.col("found").alias("positive"), F.col("id").alias("positive_id"), "score")
    good = good.withColumns({"upper": share(high, True), "lower": share(low, False)}).filter("lower <= upper")
    good = written(good, "positives")
    limits = good.groupBy("row").agg(F.reverse(F.array_sort(F.collect_set("upper"))).alias("limits"), F.min("lower").alias("floor"))  # a few for each anchor
    held = written(_searched(rows, anchors.join(limits, "row"), shards, negatives, slots_of, fan_in), "slots")
    # Of an anchor at most `positives` slots with `negatives` rows each.
    one = F.struct("slot", (-F.col("score")).alias("order"), "id", "found", "score")
    of = held.groupBy("row").agg(F.array_sort(F.collect_list(one)).alias("best"))
    of = limits.join(of, "row").select("row", "limits", "best", F.reverse(F.sequence(F.lit(0), F.size("limits") - 1)).alias("upward"))
    kind = of.schema["best"].dataType.simpleString()

    def merged(lower_slots: Column, slot: Column) -> Column:
        """The lists of the windows that begin at `slot` and at those below it."""
        whole = F.concat(F.filter("best", lambda b: b["slot"] == slot), F.coalesce(F.get(lower_slots, F.lit(0)), F.array().cast(kind)))
        return F.concat(F.array(F.slice(whole, 1, negatives)), lower_slots)

    windows = of.select("row", "limits", F.aggregate("upward", F.array().cast(f"array<{kind}>"), merged).alias("windows"))
    own = good.join(windows, "row").select("row", "positive_id", "score", "lower", F.get("windows", (F.array_position("limits", F.col("upper")) - 1).cast("int")).alias("window"))
    inside = own.select("row", "positive_id", "score", F.posexplode(F.filter("window", lambda b: b["score"] >= F.col("lower"))).alias("pos", "b"))
    ids = anchors.select("row", F.col("id").alias("anchor_id"))
    return inside.join(ids, "row").select("anchor_id", "positive_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("b.id").alias("negative_id"), F.col("score").alias("positive_score"), F.col("b.score").alias("negative_score"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = whole_vectors(rows.filter("label IS NOT NULL").select("vec_id", "embedding", label.alias("label")), scale=256, also=("label",))
    return mine(vectors, F.col("id") % 100 == 0)


def oracle() -> str:
    return """
        WITH usable AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        v AS MATERIALIZED (SELECT vec_id, label, v, row_number() OVER () AS n FROM usable),
        scored AS MATERIALIZED (
            SELECT a.n, a.vec_id AS anchor_id, c.n AS other, c.vec_id, a.label = c.label AS same, CAST(coalesce(list_sum(list_transform(list_zip(a.v, c.v), lambda p: p[1] * p[2])), 0) AS BIGINT) AS score
            FROM v a JOIN v c ON a.n <> c.n AND len(a.v) = len(c.v)
            WHERE a.vec_id % 100 = 0),
        positives AS (SELECT n, other AS positive, vec_id AS positive_id, score AS positive_score FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id, other) <= 5),
        ranked AS (
            SELECT s.anchor_id, p.positive_id, CAST(row_number() OVER (PARTITION BY s.n, p.positive ORDER BY s.score DESC, s.vec_id, s.other) AS INTEGER) AS rank, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
            FROM positives p JOIN scored s ON s.n = p.n AND NOT s.same AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score)
        SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 5"""
