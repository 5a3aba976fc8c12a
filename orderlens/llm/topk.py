"""Exact top-k by inner product: Fagin's threshold algorithm over sorted per-dimension lists.

The rows are dealt into shards of bounded size. A shard sorts its rows by every dimension once. A query reads these lists
from the end that its component favours, in steps that double; rows met for the first time are
scored in full. No row that is still unread can score above the threshold, the sum over the dimensions of
the query's component times the value at which its list has been read; reading stops when the threshold is below the
k-th best score (at equality it goes on: an unread row of a smaller id could win the tie). The shards' best
k rows of each query are ranked once more.

Queries come in blocks against all shards, so a task holds one block and one shard, whatever the table's size. Scores are exact:
doubles while no sum can leave 2**53, 64-bit integers while none can leave 2**63, Python's integers beyond.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.llm.common import read, with_row_key

K = 10
SCALE = 1024
#: rows of a shard, and of a block of queries
SHARD_ROWS, QUERY_ROWS = 4096, 1024
#: entries that are read first from every list; doubled at every step
FIRST_READ = 16
LONGEST = 2**63 - 1


def _matrix(vectors, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    for row, v in zip(out, vectors):
        row[:len(v)] = v
    return out


def _exact_kind(a: np.ndarray, b: np.ndarray):
    """A number type in which every inner product of rows of a and b is exact."""
    high = [max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) for x in (a, b)]
    bound = high[0] * high[1] * max(a.shape[1], 1)
    return np.float64 if bound < 2**53 else np.int64 if bound < 2**63 else object


class Lists:
    """The rows of one shard, sorted by every dimension."""

    def __init__(self, rows: np.ndarray):
        self.rows = rows
        self.order = np.argsort(rows, axis=0, kind="stable").T.copy()  # (dimension, rank from the smallest)
        self.values = np.take_along_axis(rows, self.order.T, axis=0).T

    def top(self, query: np.ndarray, ids: np.ndarray, k: int, own: int = -1) -> tuple[np.ndarray, np.ndarray, int]:
        """The places of the k rows that score highest (ties: smaller id, then smaller place), their scores, and how many
        entries were read from each list. ``own`` is a place that takes no part."""
        n = len(self.rows)
        up, down = np.flatnonzero(query > 0), np.flatnonzero(query < 0)
        seen, scored = np.zeros(n, bool), np.zeros(n, bool)
        if own >= 0:
            seen[own] = scored[own] = True
        best, scores = np.empty(0, np.int64), np.empty(0, query.dtype)
        read, to = 0, min(FIRST_READ, n) if len(up) + len(down) else n
        while True:
            if to == n:
                seen[:] = True
            else:
                seen[self.order[up, n - to:n - read]] = True
                seen[self.order[down, read:to]] = True
            fresh = np.flatnonzero(seen & ~scored)
            scored[fresh] = True
            best = np.concatenate([best, fresh])
            scores = np.concatenate([scores, self.rows[fresh] @ query])
            if len(best) > k:
                if scores.dtype != object:
                    keep = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
                    best, scores = best[keep], scores[keep]
                by = np.lexsort((best, ids[best], -scores))[:k]
                best, scores = best[by], scores[by]
            if to == n:
                return best, scores, to
            if len(best) == k:
                bound = (query[up] * self.values[up, n - to]).sum() + (query[down] * self.values[down, to - 1]).sum()
                if bound < scores[k - 1]:
                    return best, scores, to
            read, to = to, min(2 * to, n)


def best_of_shard(queries: pd.DataFrame, rows: pd.DataFrame, k: int) -> pd.DataFrame:
    """For every query the k best rows of one shard; frames of (row, id, v). Ids are decimal text or None: as numbers
    beside a NULL they would become floating point in pandas."""
    width = max(map(len, [*queries["v"], *rows["v"]]), default=0)
    q, x = _matrix(queries["v"], width), _matrix(rows["v"], width)
    kind = _exact_kind(q, x)
    q, lists = q.astype(kind), Lists(x.astype(kind))
    missing = rows["id"].isna().to_numpy()
    ids = np.array([0 if x is None else int(x) for x in rows["id"]], np.int64)
    ids = np.where(missing, len(ids), np.unique(ids, return_inverse=True)[1])  # their order; NULL comes last
    place = {r: p for p, r in enumerate(rows["row"].tolist())}
    out = []
    for j, row in enumerate(queries["row"].tolist()):
        best, scores, read = lists.top(q[j], ids, k, place.get(row, -1))
        out += [(row, p, max(-LONGEST, min(LONGEST, int(s))), read) for p, s in zip(best.tolist(), scores.tolist())]
    found = pd.DataFrame(out, columns=["query_row", "place", "score", "entries_read"])
    at = found.pop("place").to_numpy(np.int64)
    return found.assign(row=rows["row"].to_numpy()[at], id=rows["id"].to_numpy()[at])


def usable(vector: Column) -> Column:
    """No NULL vector, and none that holds NULL or a component that isn't finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True))


def digitised(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component; what a long can't hold becomes its nearest end."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))


def top_k(rows: DataFrame, is_query: Column, k: int = K, shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """The ``k`` highest inner products of every query row with all other rows.

    ``rows`` holds ``id`` (long) and ``v`` (array<long>); ``is_query`` is a condition on them. Returns query_row (a number of
    the query's row), query_id, rank from 1, id, score, entries_read (of each list in the winner's shard). Ties go to the smaller id,
    NULL last, then to the earlier row. A query's own row is left out; other rows with its id or its vector take part. Shorter vectors count as filled up
    with zeros. Fewer than k other rows: all of them. No rows or no queries: no rows. Scores beyond a long
    are told as its end. Other columns are not read.
    """
    stored, key = with_row_key(rows.select("id", "v"), "topk-rows")
    stored = stored.withColumnRenamed(key, "row")
    queries = stored.filter(F.coalesce(is_query, F.lit(False)))
    n, nq = stored.count(), queries.count()
    shards, blocks = max(1, -(-n // shard_rows)), max(1, -(-nq // query_rows))

    def dealt(parts: int, salt: int) -> Column:
        return F.pmod(F.xxhash64("row", F.lit(salt)), F.lit(parts)).cast("int")

    def all_of(parts: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))

    # every shard meets every block of queries: a task for each pair
    asked = queries.select(F.lit(True).alias("asks"), "row", "id", "v", dealt(blocks, 1).alias("block"), all_of(shards).alias("shard"))
    held = stored.select(F.lit(False).alias("asks"), "row", "id", "v", all_of(blocks).alias("block"), dealt(shards, 2).alias("shard"))
    pairs = asked.unionByName(held).withColumn("id", F.col("id").cast("string")).repartition(shards * blocks, "block", "shard")

    def run(both: pd.DataFrame) -> pd.DataFrame:
        return best_of_shard(both[both["asks"]], both[~both["asks"]], k)

    found = pairs.groupBy("block", "shard").applyInPandas(
        run, "query_row long, score long, entries_read long, row long, id string").withColumn("id", F.col("id").cast("long"))
    order = Window.partitionBy("query_row").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last(), "row")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    names = queries.select(F.col("row").alias("query_row"), F.col("id").alias("query_id"))
    return ranked.join(names, "query_row").select("query_row", "query_id", "rank", "id", "score", "entries_read")


def op12_topk(spark, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings").filter(usable(F.col("embedding")))
    rows = rows.select(F.col("vec_id").cast("long").alias("id"), digitised(F.col("embedding")).alias("v"))
    found = top_k(rows, F.col("id") % 100 == 0)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


ORACLE = f"""
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id, c.r AS cr, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.r <> c.r)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST, cr) AS rank FROM s)
WHERE rank <= {K}
"""
