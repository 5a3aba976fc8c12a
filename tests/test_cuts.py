"""Tiles by cut keys against the window function."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from orderlens.operators import cuts, rank
from orderlens.queries import layers
from test_plans import SF, plan


def window_ntiles(df, value, tie, k):
    w = Window.orderBy(F.col(value).asc_nulls_last(), F.col(tie).asc())
    return {r[tie]: r["t"] for r in df.select(tie, F.ntile(k).over(w).alias("t")).collect()}


def ids(n, rng):
    """Unique texts of many lengths that share long beginnings; some are filled up by zero bytes, some are not ASCII."""
    out = {"", "a", "a\x00", "a\x00\x00b", "é", "漢字", "customer", "customer\x00"}
    while len(out) < n:
        out.add(rng.choice(["customer-000000-", "customer-000001-", "x", "é漢-"]) + str(rng.randrange(10**6)))
    return sorted(out, key=lambda _: rng.random())


@pytest.mark.parametrize("bracket", [20, 10_000])
def test_tiles_equal_window_with_ties_and_nulls(spark, monkeypatch, bracket):
    monkeypatch.setattr(rank, "BRACKET_VALUES", bracket)
    rng = random.Random(bracket)
    rows = [(i, rng.choice([None, 7, 7, 7, rng.randrange(20)]), rng.choice([Decimal("1.10"), Decimal("123456789012345678.01"),
             Decimal("123456789012345678.02"), None]), rng.choice([0.0, -0.0, 1.5, float("nan"), rng.random()]), "same") for i in ids(300, rng)]
    df = spark.createDataFrame(rows, "id string, v long, m decimal(22,2), d double, s string").repartition(4).checkpoint()
    for k in (1, 5):
        got = cuts.ntiles(df, {"a": "v", "b": "m", "c": "d"}, "id", k, stage_input=False).collect()
        for name, value in (("a", "v"), ("b", "m"), ("c", "d")):
            assert {r["id"]: r[name] for r in got} == window_ntiles(df, value, "id", k), (k, value)


@pytest.mark.parametrize("n", [0, 1, 6, 23])
def test_few_rows_and_whole_number_ties(spark, n):
    df = spark.createDataFrame([(2**60 + i * 3 % 23, i % 2) for i in range(n)], "id long, v int")
    got = {r["id"]: r["t"] for r in cuts.ntiles(df, {"t": "v"}, "id", 5).collect()}
    assert got == window_ntiles(df, "v", "id", 5)


def test_one_value_everywhere_and_dates(spark, monkeypatch):
    monkeypatch.setattr(rank, "BRACKET_VALUES", 50)
    df = spark.range(20_000).select(F.format_string("c%09d", F.col("id")).alias("id"), F.lit(3).alias("v"),
                                    F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 9).cast("int")).alias("day")).checkpoint()
    got = cuts.ntiles(df, {"t": "v", "u": "day"}, "id", 5, stage_input=False).collect()
    assert {r["id"]: r["t"] for r in got} == window_ntiles(df, "v", "id", 5)
    assert {r["id"]: r["u"] for r in got} == window_ntiles(df, "day", "id", 5)
    with pytest.raises(TypeError):
        cuts.ntiles(df, {"t": "id"}, "id", 5)


def test_no_row_is_moved_and_few_jobs_run(spark, monkeypatch):
    monkeypatch.setattr(rank, "BRACKET_VALUES", 50)
    df = spark.range(30_000).select(F.col("id").cast("string").alias("id"), *[
        (F.col("id") * k % 1009).alias(f"v{k}") for k in (3, 5, 7)]).checkpoint()
    spark.sparkContext.setJobGroup("cuts", "")
    try:
        out = cuts.ntiles(df, {f"t{k}": f"v{k}" for k in (3, 5, 7)}, "id", 5, stage_input=False)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert "Exchange" not in plan(out, "simple")
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("cuts")) <= 40
    assert "rangepartitioning" not in plan(layers(spark, SF).customer_rfm, "simple")
