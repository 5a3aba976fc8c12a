"""Percentiles of many groups against Spark's own, which keeps every value."""

import random

import pytest
from pyspark.sql import functions as F

from orderlens.operators import grouped

OUT = {"p50": ("v", 0.5), "p90": ("v", 0.9), "low": ("v", 0.0), "high": ("v", 1.0), "p90_odd": ("odd", 0.9)}


def values():
    return {"v": F.col("v"), "odd": F.when(F.col("k") % 2 == 1, F.col("v"))}


def expected(df):
    return {r["g"]: tuple(r)[1:] for r in df.groupBy("g").agg(
        *[F.percentile(values()[v], p).alias(n) for n, (v, p) in OUT.items()]).collect()}


def close(a, b):
    return (a is None and b is None) or (a is not None and b is not None and (a == b or str(a) == str(b) or abs(a - b) <= 1e-9 * max(1, abs(b))))


@pytest.mark.parametrize("cells, limit", [(4, 10**5), (1024, 0)])
def test_equal_to_sparks_percentile(spark, monkeypatch, cells, limit):
    monkeypatch.setattr(grouped, "CELLS", cells)
    monkeypatch.setattr(grouped, "BROADCAST_BRACKETS", limit)
    rng = random.Random(cells)
    rows = []
    for k in range(3000):
        g = "hot" if k % 3 == 0 else rng.choice(["a", "b", "tied", None, f"g{k % 40}"])
        v = 7.25 if g == "tied" else rng.choice([rng.gauss(0, 1), rng.gauss(0, 1), 2.0, None, rng.random() * 10 ** rng.randrange(-9, 9)])
        rows.append((g, k, v))
    rows += [("none", 0, None), ("one", 1, 3.5)]
    df = spark.createDataFrame(rows, "g string, k long, v double")
    got = {r["g"]: tuple(r)[1:] for r in grouped.grouped_percentiles(df, ["g"], values(), OUT).collect()}
    want = expected(df)
    assert got.keys() == want.keys() and got["none"] == (None,) * 5
    for g in want:
        assert all(close(a, b) for a, b in zip(got[g], want[g])), (g, got[g], want[g])


def test_ends_of_the_number_line_and_no_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [("i", 1, x) for x in (-inf, -inf, -1.7e308, 0.0, 1.7e308, inf, inf)] + [("n", 1, x) for x in (1.0, 2.0, nan, nan)]
    df = spark.createDataFrame(rows, "g string, k long, v double")
    got = {r["g"]: r for r in grouped.grouped_percentiles(df, ["g"], values(), OUT).collect()}
    assert (got["i"]["low"], got["i"]["p50"], got["i"]["high"], got["i"]["p90"]) == (-inf, 0.0, inf, inf)
    assert got["n"]["low"] == 1.0 and str(got["n"]["high"]) == "nan"
    assert grouped.grouped_percentiles(df.limit(0), ["g"], values(), OUT).count() == 0


def test_two_group_columns(spark):
    df = spark.range(500).select((F.col("id") % 3).alias("a"), F.when(F.col("id") % 2 == 0, "x").alias("b"), (F.col("id") * 37 % 101).alias("v"))
    got = {(r["a"], r["b"]): r["m"] for r in grouped.grouped_percentiles(df, ["a", "b"], {"v": F.col("v")}, {"m": ("v", 0.3)}).collect()}
    assert got == {(r["a"], r["b"]): r["m"] for r in df.groupBy("a", "b").agg(F.percentile("v", 0.3).alias("m")).collect()}
