"""The distributed global-rank operators against single-partition window functions."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from orderlens.operators.rank import exact_quantiles, global_cumsum, global_ntile, global_row_number, ntile_of


def _df(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, v long")


def test_ntile_sizes_seven_rows(spark):
    df = _df(spark, [5, 5, 5, 5, 5, 5, 5])
    out = global_ntile(df, [F.col("v").asc(), F.col("id").asc()], 5, "t")
    sizes = sorted((r["t"], r["n"]) for r in out.groupBy("t").agg(F.count("*").alias("n")).collect())
    assert sizes == [(1, 2), (2, 2), (3, 1), (4, 1), (5, 1)]


def test_ntile_fewer_rows_than_tiles(spark):
    df = _df(spark, [3, 1, 2])
    out = {r["id"]: r["t"] for r in global_ntile(df, [F.col("v").asc(), F.col("id").asc()], 5, "t").collect()}
    assert out == {1: 1, 2: 2, 0: 3}


def test_ntile_of_matches_definition(spark):
    for n in (1, 2, 4, 5, 7, 11, 23):
        for k in (1, 3, 5):
            q, r = divmod(n, k)
            expect = []
            for t in range(1, k + 1):
                expect += [t] * (q + 1 if t <= r else q)
            rn = spark.range(1, n + 1).select(ntile_of(F.col("id"), n, k).alias("t")).orderBy("id")
            assert [x["t"] for x in rn.collect()] == expect, (n, k)


@settings(max_examples=6, deadline=None)
@given(st.lists(st.integers(min_value=0, max_value=4), min_size=1, max_size=60), st.integers(1, 6))
def test_ntile_equals_window(spark, values, parts):
    df = _df(spark, values)
    order = [F.col("v").asc(), F.col("id").asc()]
    mine = {r["id"]: r["t"] for r in global_ntile(df, order, 5, "t", num_partitions=parts).collect()}
    ref = {r["id"]: r["t"] for r in df.select("id", F.ntile(5).over(Window.orderBy(*order)).alias("t")).collect()}
    assert mine == ref


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(min_value=-3, max_value=3), min_size=0, max_size=50))
def test_row_number_is_a_permutation_in_order(spark, values):
    df = _df(spark, values)
    out, n = global_row_number(df, [F.col("v").desc(), F.col("id").asc()], "rn", num_partitions=4)
    rows = sorted(out.collect(), key=lambda r: r["rn"])
    assert n == len(values)
    assert [r["rn"] for r in rows] == list(range(1, n + 1))
    assert [(r["v"], r["id"]) for r in rows] == sorted(((v, i) for i, v in enumerate(values)),
                                                       key=lambda t: (-t[0], t[1]))


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(min_value=-100, max_value=100, allow_nan=False), min_size=1, max_size=80))
def test_exact_quantiles_equal_percentile(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, v double")
    probs = [0.0, 0.5, 0.9, 0.95, 1.0]
    mine = exact_quantiles(df, "v", probs).first()
    ref = df.agg(*[F.percentile("v", p).alias(f"p{i}") for i, p in enumerate(probs)]).first()
    for i, p in enumerate(probs):
        assert abs(mine[i] - ref[f"p{i}"]) <= 1e-9 * max(1.0, abs(ref[f"p{i}"])), p


def test_exact_quantiles_empty_and_nulls(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "id long, v double")
    assert exact_quantiles(df, "v", [0.9]).first()[0] is None


def test_order_statistics_narrow_brackets_and_ties(spark, monkeypatch):
    """With brackets of at most 20 rows every rank takes several rounds; a third of the values are one value."""
    from orderlens.operators import rank
    monkeypatch.setattr(rank, "BRACKET_VALUES", 20)
    random.seed(5)
    values = [7.0 if i % 3 == 0 else round(random.gauss(0, 50), 3) for i in range(30_000)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    ranks = [0, 1, 15_000, 27_000, 29_999]
    found = rank.order_statistics(df, "v", ranks, len(values))
    ordered = sorted(values)
    assert {r: found[r] for r in ranks} == {r: ordered[r] for r in ranks}


def test_order_statistics_at_the_border_of_heavy_values(spark, monkeypatch):
    """Equal-sized heavy values with a rank on either side of a border: each round must take something out."""
    from orderlens.operators import rank

    def few(df, value, ranks, rows):
        rounds = []

        class Counted:
            def agg(self, *a):
                rounds.append(1)
                assert len(rounds) < 40, "no end"
                return df.agg(*a)

            def filter(self, *a):
                return df.filter(*a)

        return rank.order_statistics(Counted(), value, ranks, rows)

    for n_values, probs in ((2, [0.5]), (10, [0.1, 0.5, 0.9])):
        df = spark.range(100_000).select((F.col("id") % n_values).cast("double").alias("v")).cache()
        ranks = sorted({int(p * 100_000) + d for p in probs for d in (-1, 0)} | {0, 99_999})
        assert few(df, "v", ranks, 100_000) == {r: float(r // (100_000 // n_values)) for r in ranks}
    df = spark.range(100_000).select((F.col("id") % 2).cast("double").alias("v"))
    assert exact_quantiles(df, "v", [0.5]).first()[0] == 0.5
    nan = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, float("nan")).when(F.col("id") % 3 == 1, 1.0).otherwise(-0.0).alias("v"))
    got = few(nan, "v", [19_999, 20_000, 39_999], 60_000)
    assert got == {19_999: 0.0, 20_000: 1.0, 39_999: 1.0} and str(few(nan, "v", [40_000], 60_000)[40_000]) == "nan"


def test_cumsum_equals_window(spark):
    random.seed(3)
    rows = [(i, random.randint(0, 5), random.randint(0, 3)) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, a long, b long")
    out = global_cumsum(df, [F.col("id").asc()], ["a", "b"], num_partitions=5)
    got = {r["id"]: (r["cum_a"], r["cum_b"]) for r in out.collect()}
    ca = cb = 0
    for i, a, b in rows:
        ca += a
        cb += b
        assert got[i] == (ca, cb)


def test_hot_value_is_spread_over_partitions(spark):
    """A third of the rows share one sort value: the unique tie-break still splits them evenly."""
    from orderlens.operators.rank import range_sorted
    n = 3000
    rows = [(i, 7 if i % 3 == 0 else i) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, v long")
    staged = range_sorted(df, [F.col("v").asc(), F.col("id").asc()], num_partitions=8)
    sizes = [r["c"] for r in staged.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("c")).collect()]
    assert sum(sizes) == n and max(sizes) < 2 * n / 8
    numbered, total = global_row_number(df, [F.col("v").asc(), F.col("id").asc()], "rn", num_partitions=8)
    got = [r["id"] for r in numbered.orderBy("rn").collect()]
    assert total == n and got == [i for _, i in sorted((v, i) for i, v in rows)]


def test_row_number_within_equals_window_with_a_hot_key(spark):
    from orderlens.operators.rank import row_number_within
    random.seed(7)
    rows = [("hot" if i % 3 == 0 else f"k{i % 17}", random.randint(0, 20), i) for i in range(600)]
    df = spark.createDataFrame(rows, "k string, v long, id long")
    mine = {r["id"]: r["n"] for r in row_number_within(df, "k", ["v", "id"], "n", num_partitions=6).collect()}
    w = Window.partitionBy("k").orderBy("v", "id")
    ref = {r["id"]: r["n"] for r in df.select("id", F.row_number().over(w).alias("n")).collect()}
    assert mine == ref
