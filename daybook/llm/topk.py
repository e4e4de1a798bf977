"""Exact top-k search by inner product: tiled matrix products, partial selection, merged top lists.

Rows are numbered and dealt into shards by the hash of their number, so that ids or vectors that many
rows share are spread out. A shard is a matrix of bounded bytes; every query visits every shard once, in
batches behind the shard's rows. The task multiplies a few queries at a time by the shard and keeps the
k best rows of each; the shards' lists of a query are merged in rounds of `fan_in`, so that no task sees
more than fan_in lists of a query. Of the two sides only the queries are copied, once for each shard;
nothing is broadcast.

Vectors that are null or hold a null or non-finite component take no part, nor do rows with null ids.
Vectors are compared with vectors of the same length only (empty ones score 0). Rows are rows: one that
repeats an id, or an id and a vector, is a candidate of its own and, if asked for, a query of its own;
a query leaves out its own row only. Ties go to the smaller id. Products that could pass 2^53 are formed
in whole numbers; scores that could pass 64 bits fail. Empty tables give no rows. Columns other than key
and vector are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from .common import give_back, table, written

K = 20
#: Bytes of a shard's matrix, rows below which a shard is not cut for the sake of more tasks, lists merged at once.
SHARD_BYTES, LEAST_ROWS, FAN_IN = 32 << 20, 1024, 16
#: Scores that a task holds at once.
_SCORES = 1 << 21


def best_of_shard(asked: tuple, held: tuple, k: int) -> tuple:
    """row and id of the query, id and score of the candidate, for the k best of each query.

    Both sides: rows, ids and the matrix (numpy); the held ones stand in order of their ids.
    """
    import numpy as np

    (q_rows, q_ids, q), (c_rows, c_ids, c) = asked, held
    top = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * max(1, q.shape[1])
    if top >= 2.0**63:
        raise OverflowError("inner products may pass 64 bits")
    exact = top < 2.0**53
    q, c = (q.astype(np.float64), c.astype(np.float64)) if exact else (q, c)
    low = -np.inf if exact else np.iinfo(np.int64).min
    by_row = np.argsort(c_rows)
    place = np.minimum(np.searchsorted(c_rows, q_rows, sorter=by_row), len(c_rows) - 1)
    own = by_row[place]
    is_own = c_rows[own] == q_rows
    found: list[tuple] = []
    step = max(1, _SCORES // len(c_rows))
    for lo in range(0, len(q_rows), step):
        scores = q[lo : lo + step] @ c.T
        n = len(scores)
        mine = np.nonzero(is_own[lo : lo + n])[0]
        scores[mine, own[lo + mine]] = low
        take = min(k, len(c_rows))
        edge = np.partition(scores, len(c_rows) - take, axis=1)[:, len(c_rows) - take]
        for r in range(n):
            # Candidates stand in order of their ids: of equal scores the smaller id comes first.
            keep = np.nonzero(scores[r] >= edge[r])[0]
            if is_own[lo + r]:
                keep = keep[keep != own[lo + r]]
            keep = keep[np.argsort(-scores[r, keep], kind="stable")][:take]
            found.append((np.full(len(keep), q_rows[lo + r]), np.full(len(keep), q_ids[lo + r]), c_ids[keep], scores[r, keep].astype(np.int64)))
    return tuple(np.concatenate(x) for x in zip(*found))


def _searched(k: int):
    """For rows sorted by shard, length, asks and id: the k best of each query in its shard."""

    def per_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        import pyarrow.compute as pc

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
                own = (part.column("row").to_numpy(), part.column("id").to_numpy(), pc.list_flatten(part.column("v")).to_numpy(zero_copy_only=False).reshape(hi - lo, dim))
                if not asks:
                    held.append(own)
                elif held:
                    held = [tuple(np.concatenate(x) for x in zip(*held))]
                    out = best_of_shard(own, held[0], k)
                    yield pa.RecordBatch.from_arrays([*(pa.array(x, pa.int64()) for x in out), pa.array(np.full(len(out[0]), shard), pa.int32())], names=["row", "query_id", "vec_id", "score", "shard"])
        give_back()

    return per_partition


def exact_top_k(vectors: DataFrame, is_query: Column, k: int = K, shard_bytes: int = SHARD_BYTES, least_rows: int = LEAST_ROWS, fan_in: int = FAN_IN) -> DataFrame:
    """query_id, rank, vec_id, score. vectors: id long, v array<long>, as whole_vectors gives them; is_query tells its queries."""
    asks = F.coalesce(is_query, F.lit(False))
    rows = written(vectors.select("id", "v", asks.alias("asks"), F.size("v").alias("dim"), F.monotonically_increasing_id().alias("row")), "vectors")
    size = rows.agg(F.count("*").alias("n"), F.coalesce(F.max("dim"), F.lit(0)).alias("dim")).first()
    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shards = max(1, -(-size["n"] * 8 * max(1, size["dim"]) // shard_bytes), min(parts, size["n"] // least_rows))
    held = rows.select(F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int").alias("shard"), "dim", F.lit(False).alias("asks"), "row", "id", "v")
    asked = rows.filter("asks").select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), "dim", "asks", "row", "id", "v")
    dealt = held.union(asked).repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "dim", "asks", "id")  # a shard a task
    lists = dealt.mapInArrow(_searched(k), "row long, query_id long, vec_id long, score long, shard int")
    while True:
        shards = -(-shards // fan_in)
        order = W.partitionBy("row", "shard").orderBy(F.desc("score"), "vec_id")
        lists = lists.withColumn("shard", F.floor(F.col("shard") / fan_in).cast("int")).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        if shards <= 1:
            return lists.select("query_id", "rank", "vec_id", "score")


def whole_vectors(df: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: int = 64, also: tuple[str, ...] = ()) -> DataFrame:
    """id, v and the columns `also`: every usable vector with each component x as floor(scale * x)."""
    v = F.col(vector)
    usable = v.isNotNull() & F.col(key).isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return df.filter(F.coalesce(usable, F.lit(False))).select(F.col(key).cast("long").alias("id"), F.transform(v, lambda x: F.floor(x.cast("double") * scale)).alias("v"), *also)


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_top_k(whole_vectors(table(spark, sf_dir, "embeddings")), F.col("id") % 20 == 0)


def oracle() -> str:
    return """
        WITH usable AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        v AS MATERIALIZED (SELECT vec_id, v, row_number() OVER () AS n FROM usable),
        scored AS (
            SELECT q.n, q.vec_id AS query_id, c.vec_id AS vec_id, CAST(coalesce(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])), 0) AS BIGINT) AS score
            FROM v q JOIN v c ON q.n <> c.n AND len(q.v) = len(c.v)
            WHERE q.vec_id % 20 = 0)
        SELECT query_id, CAST(row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
        FROM scored QUALIFY row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id) <= 20"""
