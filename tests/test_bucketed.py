"""The score store laid out by order."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderlens.model.bucketed import BucketedScoreStore
from orderlens.model.score import ScoreStore, assemble_scores
from orderlens.plans import report
from orderlens.session import scratch_path


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scores(spark, rows, day):
    return assemble_scores(spark.createDataFrame(rows, "order_id string, risk_score double"), day, mode="fixed")


@pytest.fixture(scope="module")
def store(spark):
    out = BucketedScoreStore(spark, scratch_path(spark, "bucketed"), buckets=16)
    for d in range(1, 4):
        out.upsert(scores(spark, [(f"o{k}", (k * d % 97) / 97) for k in range(0, 2000, d)], f"2024-01-0{d}"))
    return out


def test_upsert_equals_the_plain_store(spark, store):
    plain, mine = ScoreStore(spark, scratch_path(spark, "plain")), BucketedScoreStore(spark, scratch_path(spark, "mine"), 4)
    batches = [scores(spark, [("1", 0.1), ("2", 0.2), (None, 0.5)], "2024-01-01"), scores(spark, [("1", 0.7)], "2024-01-01"),
               scores(spark, [("1", 0.7)], "2024-01-01"), scores(spark, [("2", 0.9), ("3", 0.3)], dt.date(2024, 1, 5)),
               scores(spark, [], "2024-01-07"), scores(spark, [("9", 0.9)], "2024-01-01").unionByName(scores(spark, [("2", 0.4)], "2024-01-05"))]
    for b in batches:
        plain.upsert(b) if b.count() else None
        mine.upsert(b)
        key = lambda r: (str(r["order_id"]), r["score_date"])
        cut = lambda s: sorted((r for r in s.read().drop("created_at").collect()), key=key)
        assert cut(plain) == cut(mine)
    latest = {r["order_id"]: r for r in mine.latest().collect() if r["order_id"]}
    assert latest["2"]["score_date"] == dt.date(2024, 1, 5) and latest["2"]["risk_score"] == Decimal("0.400000")
    with pytest.raises(ValueError):
        mine.upsert(batches[1].unionByName(batches[1]))


def test_rows_not_in_the_batch_keep_their_time(spark):
    mine = BucketedScoreStore(spark, scratch_path(spark, "times"), 4)
    mine.upsert(scores(spark, [("1", 0.1), ("2", 0.2)], "2024-01-01"))
    first = {r["order_id"]: r["created_at"] for r in mine.read().collect()}
    mine.upsert(scores(spark, [("1", 0.3)], "2024-01-01"))
    after = {r["order_id"]: r["created_at"] for r in mine.read().collect()}
    assert after["2"] == first["2"] and after["1"] > first["1"]


def test_the_store_is_not_exchanged(spark, store):
    assert "Exchange" not in plan(store.latest()) and "Bucketed: true" in plan(store.latest())
    orders = spark.createDataFrame([(f"o{k}", k) for k in range(3000)], "order_id string, n long")
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = store.scored(orders)
        assert plan(joined).count("Exchange hashpartitioning") == 1  # of the orders
        assert joined.count() == 3000 and joined.filter(F.col("risk_score").isNull()).count() == 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)


def test_latest_equals_the_aggregate_and_join(spark, store):
    assert sorted(store.latest().collect()) == sorted(report.latest_scores(store.read()).collect())


def test_another_session_finds_the_layout(spark, store):
    other = BucketedScoreStore(spark.newSession(), store.path)
    spark.sql(f"DROP TABLE {store.table}")  # external: the files stay
    again = BucketedScoreStore(spark, store.path, buckets=99)
    assert other.buckets == again.buckets == 16
    assert again.read().count() == 2000 + 1000 + 667 and "Exchange" not in plan(again.latest())


def test_upsert_writes_a_file_a_bucket(spark, store):
    """The merge keeps the buckets: a day has at most as many files as buckets after an upsert."""
    store.upsert(scores(spark, [(f"o{k}", 0.5) for k in range(0, 500)], "2024-01-01"))
    files = store.read().filter(F.col("score_date") == dt.date(2024, 1, 1)).select(F.input_file_name()).distinct().count()
    assert files <= 16
