"""Contiguous shards of nearly equal byte size.

Rows are put in one global order, by the hash of their text and then by id, with a range partitioning
on both, so that a text that a third of all rows share is spread over many partitions. Each partition
gives its running sums; their totals, one row a partition, turn these into global prefix sums. The
order is cut where the prefix sum passes equal targets. Equal texts are neighbours in this order: a
cut that would fall into a group of equal texts moves to the group's nearer end, unless the group is
larger than `whole_share` of a shard; such a group is split, as nothing else keeps shards near equal.

Null texts have no bytes and the size 1. Repeated rows are rows of their own. No rows: no shards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from .common import table, written

SHARDS = 8
#: A group of equal texts of up to this share of a shard's size stays in one shard.
WHOLE_SHARE = 0.05


def prefix_sums(rows: DataFrame, order: list[str], size: str) -> DataFrame:
    """Appends `before` (sum of size over all rows before this one) and `position` (how many those are)."""
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = written(rows.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()), "ordered")
    within = W.partitionBy("_part").orderBy(*order)
    local = placed.withColumns({"_sum": F.sum(size).over(within.rowsBetween(W.unboundedPreceding, 0)), "_row": F.row_number().over(within)})
    totals = placed.groupBy("_part").agg(F.sum(size).alias("_bytes"), F.count("*").alias("_rows"))
    # One row for each range partition: a bounded table, whatever the number of documents.
    earlier = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = totals.select("_part", *(F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(c) for c in ("_bytes", "_rows")))
    return (
        local.join(F.broadcast(starts), "_part")
        .withColumns({"before": F.col("_bytes") + F.col("_sum") - F.col(size), "position": F.col("_rows") + F.col("_row") - 1})
        .drop("_part", "_sum", "_row", "_bytes", "_rows")
    )


def shard_by_bytes(docs: DataFrame, shards: int = SHARDS, key: str = "doc_id", text: str = "text", whole_share: float = WHOLE_SHARE) -> DataFrame:
    """key, size, text_crc32, shard and slot (gapless from 0 in each shard) of every row of docs."""
    rows = docs.select(
        F.col(key).alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
        F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("_group"),
    )
    summed = written(prefix_sums(rows, ["_group", "doc_id"], "size"), "prefix")
    total = summed.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("n")).first()["n"]
    targets = [total * k / shards for k in range(1, shards)]
    cuts = [-(-total * k // shards) for k in range(1, shards)]
    if total:
        # The rows that targets fall into: at most one for each cut.
        at = summed.filter(" or ".join(f"(before < {t!r} and before + size > {t!r})" for t in targets)) if targets else summed.limit(0)
        groups = [r["_group"] for r in at.select("_group").distinct().collect()]
        spans = summed.filter(F.col("_group").isin(groups)).groupBy("_group").agg(F.min("before").alias("start"), F.max(F.col("before") + F.col("size")).alias("end")).collect() if groups else []
        for k, t in enumerate(targets):
            for s in spans:
                if s["start"] < t < s["end"] and s["end"] - s["start"] <= whole_share * total / shards:
                    cuts[k] = s["start"] if t - s["start"] <= s["end"] - t else s["end"]
    # Each row lies where its first byte lies.
    shard = sum((F.when(F.col("before") >= c, 1).otherwise(0) for c in cuts), F.lit(0)).cast("int")
    placed = summed.withColumn("shard", shard)
    counts = {r["shard"]: r["n"] for r in placed.groupBy("shard").agg(F.count("*").alias("n")).collect()}
    first = F.lit(0).cast("long")
    for k in range(shards):
        first = F.when(F.col("shard") == k, F.lit(sum(counts.get(j, 0) for j in range(k))).cast("long")).otherwise(first)
    return placed.select(F.col("doc_id").alias(key), "size", "text_crc32", "shard", (F.col("position") - first).cast("long").alias("slot"))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, key: str = "doc_id", text: str = "text") -> None:
    """Writes docs to path/shard=k, for unique keys."""
    of = shard_by_bytes(docs, shards, key, text).select(key, "shard", "slot")
    docs.join(of, key).write.partitionBy("shard").parquet(path)


def op6_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shard_by_bytes(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def oracle() -> str:
    """The same shards in SQL. The checksum is the bytewise one, over a table of the 256 bytes' remainders."""
    remainders = "list_transform(range(256), lambda b: list_reduce(range(8), lambda r, x: CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END, CAST(b AS BIGINT)))"
    return f"""
        WITH r AS (SELECT doc_id, coalesce(text, '') AS t, CAST(strlen(coalesce(text, '')) + 1 AS BIGINT) AS size, md5(coalesce(text, '')) AS g FROM documents),
        s AS (SELECT *, CAST(sum(size) OVER (ORDER BY g, doc_id ROWS UNBOUNDED PRECEDING) - size AS BIGINT) AS before FROM r),
        spans AS (SELECT g, min(before) AS a, max(before + size) AS b FROM s GROUP BY g),
        targets AS (SELECT k, n, n * k / CAST({SHARDS} AS DOUBLE) AS t FROM (SELECT sum(size) AS n FROM r) x, (SELECT unnest(range(1, {SHARDS})) AS k) y),
        cuts AS (
            SELECT k, coalesce(CASE WHEN t - a <= b - t THEN a ELSE b END, ceil(t)) AS c
            FROM targets LEFT JOIN spans ON a < t AND t < b AND b - a <= {WHOLE_SHARE} * n / {SHARDS}),
        placed AS (SELECT *, CAST((SELECT count(*) FROM cuts WHERE before >= c) AS INTEGER) AS shard FROM s),
        remainders AS (SELECT {remainders} AS m)
        SELECT doc_id, size,
               xor(list_reduce(list_transform(range(size - 1), lambda i: CAST(concat('0x', substr(h, 2 * i + 1, 2)) AS BIGINT)), lambda crc, b: xor(crc >> 8, m[1 + (xor(crc, b) & 255)]), 4294967295), 4294967295) AS text_crc32,
               'bytes' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY g, doc_id) - 1 AS slot, CAST(NULL AS INTEGER) AS grown_shard
        FROM (SELECT *, hex(encode(t)) AS h FROM placed) p, remainders"""
