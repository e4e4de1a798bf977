import numpy as np
import pytest
from pyspark.sql import functions as F

from daybook.llm import negatives


def plain(rows, anchors, k=5, n=5, low=80, high=100):
    """Every anchor against every row, window by window. rows: (id, label, vector)."""
    out = []
    for a, (aid, alabel, av) in enumerate(rows):
        if not anchors(aid):
            continue
        scored = sorted((-sum(x * y for x, y in zip(av, v)), i, r, label == alabel) for r, (i, label, v) in enumerate(rows) if r != a and len(v) == len(av))
        for s, pid, _, _ in [x for x in scored if x[3]][:k]:
            inside = [x for x in scored if not x[3] and low * -s <= 100 * -x[0] <= high * -s][:n]
            out += [(aid, pid, rank, nid, -s, -t) for rank, (t, nid, _, _) in enumerate(inside, 1)]
    return sorted(out)


def test_best_takes_the_earlier_of_ties():
    scores = np.array([3, 5, 5, 1, 5, 2])
    assert negatives.best(scores, np.array([0, 1, 2, 3, 4, 5]), 2).tolist() == [1, 2] and negatives.best(scores, np.array([0, 3]), 5).tolist() == [0, 3]


@pytest.mark.parametrize("shard_bytes, least_rows, fan_in, low, high", [(600, 1, 2, 80, 100), (1 << 20, 1000, 16, 80, 100), (900, 1, 3, 50, 120)])
def test_against_every_window(spark, shard_bytes, least_rows, fan_in, low, high):
    rng = np.random.default_rng(shard_bytes)
    rows = [(int(i), int(rng.integers(0, 3)), [int(x) for x in rng.integers(-4, 5, 6)]) for i in range(120)]  # few values: many ties
    rows += [(5, 1, [4, 4, 4, 4, 4, 4]), (5, 0, [4, 4, 4, 4, 4, 3]), (10, 2, [1, 2]), (11, 2, [2, 1]), (12, 1, [2, 1]), (20, 9, [1, 1, 1, 1, 1, 1]), (30, 1, []), (31, 1, []), (32, 2, [])]
    df = spark.createDataFrame([(i, v, label) for i, label, v in rows], "id long, v array<long>, label int").repartition(3)
    got = negatives.mine(df, F.col("id") % 5 == 0, low=low, high=high, shard_bytes=shard_bytes, least_rows=least_rows, fan_in=fan_in)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = plain(rows, lambda i: i % 5 == 0, low=low, high=high)
    assert sorted(map(tuple, got.collect())) == want and len(want) > 100


def test_query_on_odd_rows(spark, tmp_path):
    rng = np.random.default_rng(4)
    base = [(int(i), [float(x) for x in rng.normal(0, 0.3, 8)], int(i) % 4) for i in range(0, 400, 5)]
    odd = [(100, None, 1), (200, [1.0, None] + [0.5] * 6, 1), (300, [float("nan")] * 8, 1), (300, [float("inf")] + [0.0] * 7, 2), (None, [0.5] * 8, 1), (500, [0.5] * 8, None), (600, [0.0] * 8, 3)]
    spark.createDataFrame([*base, *odd], "vec_id long, embedding array<float>, label int").withColumn("slot", F.lit(1)).withColumn("score", F.lit(2)).write.parquet(f"{tmp_path}/embeddings.parquet")
    rows = [(i, (label + 1) % 10 if i % 7 == 0 else label, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, v, label in [*base, odd[-1]]]
    got = negatives.op13_hard_negatives(spark, str(tmp_path))
    assert sorted(map(tuple, got.collect())) == plain(rows, lambda i: i % 100 == 0)
    spark.createDataFrame([], "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/none/embeddings.parquet")
    assert negatives.op13_hard_negatives(spark, f"{tmp_path}/none").collect() == []


def test_scores_beyond_64_bits_fail(spark):
    df = spark.createDataFrame([(0, [1 << 40], 1), (1, [1 << 40], 1)], "id long, v array<long>, label int")
    with pytest.raises(Exception, match="64 bits"):
        negatives.mine(df, F.col("id") == 0).collect()
