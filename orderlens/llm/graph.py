"""Connected components of an undirected graph in DataFrame operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import cut


def _state(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()


def _linked_to_least(edges: DataFrame) -> DataFrame:
    """(v, m(u)) for every edge (u, v), m(u) the least ``b`` that ``a = u`` has: a join that Spark can
    split where one node has very many edges; the least is a partial aggregation."""
    least = edges.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "u")
    return edges.join(least, edges["a"] == least["u"])


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); root is the least node it is linked to.

    Alternates large-star and small-star steps until the edges are stars. Each step is two joins on
    a node; the edges are checkpointed after each. Loops and NULLs are ignored; no edges: no rows.
    """
    e = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    e = cut(e.filter(F.col("a") > F.col("b")).distinct())
    seen = _state(e)
    while seen[0]:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # large star: neighbours above u move to the least of u and its neighbours
        j = _linked_to_least(both)
        large = j.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.least("m", "u").alias("b")).distinct()
        # small star: neighbours below u, and u, move to the least neighbour
        j = _linked_to_least(large)
        small = j.select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
                                           F.struct(F.col("a").alias("a"), F.col("m").alias("b")))).alias("s"))
        e = cut(small.select("s.a", "s.b").filter(F.col("a") > F.col("b")).distinct())
        now = _state(e)
        if now == seen:
            break
        seen = now
    roots = e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
