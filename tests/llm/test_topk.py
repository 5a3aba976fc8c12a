"""Exact top-k search against scoring everything."""

import math
import random

import numpy as np
import pytest
from awkward import SF, duck
from pyspark.sql import functions as F

from orderlens.llm import topk


def brute(rows, is_query, k=10):
    """(query_id, rank, id, score) by scoring every pair, own rows left out."""
    out = []
    for a, (qid, q) in enumerate(rows):
        if is_query(qid):
            scored = [(-sum(x * y for x, y in zip(q, v)), i is None, i or 0, b, i) for b, (i, v) in enumerate(rows) if b != a]
            out += [(qid, r + 1, s[4], -s[0]) for r, s in enumerate(sorted(scored)[:k])]
    return out


def key(t):
    return tuple((x is None, x or 0) for x in t)


@pytest.mark.parametrize("low, high, dims", [(-3, 3, 4), (-1000, 1000, 8), (0, 5, 3), (-2**28, 2**28, 5), (-2**40, 2**40, 3)])
def test_lists_equal_scoring_everything(low, high, dims):
    rng = np.random.default_rng(high % 1000)
    x = rng.integers(low, high + 1, (300, dims))
    ids = rng.permutation(300)
    kind = topk._exact_kind(x, x)
    lists = topk.Lists(x.astype(kind))
    for j in range(40):
        q = x[j] if j else np.zeros(dims, np.int64)
        best, scores, read = lists.top(q.astype(kind), ids, 10, j)
        want = sorted((-sum(int(a) * int(b) for a, b in zip(q, v)), int(ids[p]), p) for p, v in enumerate(x) if p != j)[:10]
        assert [(-int(s), int(ids[p]), int(p)) for s, p in zip(scores, best)] == want and read <= 300


def test_reading_stops_early_where_the_bound_allows():
    x = np.random.default_rng(1).normal(0, 1, (4000, 2)) * 1000
    x = np.floor(x)
    reads = [topk.Lists(x).top(q, np.arange(4000), 10)[2] for q in x[:20]]
    assert max(reads) < 1000


def test_shards_blocks_ties_and_short_vectors(spark):
    rng = random.Random(2)
    rows = [(i if i % 17 else None, [rng.randint(-2, 2) for _ in range(rng.choice([4, 4, 4, 2, 0]))]) for i in range(400)]
    rows += rows[100:103] + [(200, [1, 2, 1, 0])] * 3 + [(2**60 + 20, [2, 2, 2, 2])]
    df = spark.createDataFrame(rows, "id long, v array<long>").withColumn("score", F.lit(1)).withColumn("row", F.lit("x"))
    got = topk.top_k(df.coalesce(1), F.col("id") % 20 == 0, 10, shard_rows=50, query_rows=7)
    want = brute(rows, lambda i: i is not None and i % 20 == 0)
    assert sorted((tuple(r[1:5]) for r in got.collect()), key=key) == sorted(want, key=key)
    few = topk.top_k(df.limit(4), F.col("id") == 1).collect()
    assert len(few) == 3
    assert topk.top_k(df.limit(0), F.col("id") == 1).count() == 0
    assert topk.top_k(df, F.lit(None).cast("boolean")).count() == 0


def test_query_with_unusable_vectors(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(5)], 0) for i in range(0, 300)]
    rows += [(400, None, 0), (500, [1.0, None, 0.0, 0.0, 0.0], 0), (600, [math.nan] * 5, 0), (700, [math.inf, 0.0, 0.0, 0.0, 0.0], 0),
             (100, rows[5][1], 0), (None, rows[7][1], 0), (800, [], 0)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").coalesce(1).write.parquet(f"{tmp_path}/embeddings.parquet")
    used = [(i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v, _ in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    got = [tuple(r) for r in topk.op12_topk(spark, str(tmp_path)).collect()]
    assert sorted(got, key=key) == sorted(brute(used, lambda i: i is not None and i % 100 == 0), key=key)


def test_query_equals_sql(spark):
    got = sorted(tuple(r) for r in topk.op12_topk(spark, SF).collect())
    assert got and got == sorted(duck({"embeddings": f"{SF}/embeddings.parquet"}).execute(topk.ORACLE).fetchall())
