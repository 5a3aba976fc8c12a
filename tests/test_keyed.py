"""Insert-if-absent, upsert merge and the score store."""

import datetime as dt
from decimal import Decimal

from helpers import customer, raw
from pyspark.sql import functions as F

from orderlens.model import score
from orderlens.model.score import ScoreStore, assemble_scores
from orderlens.operators.keyed import insert_if_absent, latest_per_key, upsert_merge
from orderlens.plans import report, warehouse
from orderlens.session import scratch_path


def test_dimension_same_key_twice_and_reload_keeps_existing(spark):
    r = raw(spark, customers=[customer("c1", "u1"), {**customer("c1", "u1"), "customer_city": "other"},
                              customer("c2", "u2")])
    first = warehouse.dim_customer(r.customers)
    rows = {x["customer_id"]: x for x in first.collect()}
    assert len(rows) == 2 and rows["c1"]["customer_city"] == "other"  # smallest row by the other columns
    r2 = raw(spark, customers=[{**customer("c1", "u9"), "customer_city": "zzz"}, customer("c3", "u3")])
    again = {x["customer_id"]: x for x in warehouse.dim_customer(r2.customers, existing=first).collect()}
    assert set(again) == {"c1", "c2", "c3"}
    assert again["c1"]["customer_unique_id"] == "u1" and again["c1"]["customer_city"] == "other"


def _scores(spark, rows):
    return spark.createDataFrame(rows, "order_id string, risk_score double")


def test_flags_at_exact_percentiles(spark):
    # 21 scores 0.00 .. 1.00: P90 = 0.90 and P95 = 0.95 fall on data points
    s = _scores(spark, [(str(i), i / 20) for i in range(21)] + [("null", None)])
    b = {r["order_id"]: r for r in assemble_scores(s, "2024-01-01").collect()}
    assert b["19"]["risk_flag"] == "red" and b["18"]["risk_flag"] == "amber" and b["17"]["risk_flag"] == "green"
    assert b["null"]["risk_flag"] == "green"
    assert b["0"]["threshold_green"] == Decimal("0.900000") and b["0"]["threshold_red"] == Decimal("0.950000")


def test_upsert_merge_later_wins(spark):
    old = spark.createDataFrame([("1", "a"), ("2", "b")], "k string, v string")
    new = spark.createDataFrame([("2", "B"), ("3", "C")], "k string, v string")
    assert sorted(tuple(r) for r in upsert_merge(old, new, "k").collect()) == [("1", "a"), ("2", "B"), ("3", "C")]
    kept = sorted(tuple(r) for r in insert_if_absent(old, new, "k").collect())
    assert kept == [("1", "a"), ("2", "b"), ("3", "C")]
    twice = upsert_merge(upsert_merge(old, new, "k"), new, "k")
    assert sorted(tuple(r) for r in twice.collect()) == [("1", "a"), ("2", "B"), ("3", "C")]


def test_score_store_upsert_idempotent_and_latest(spark):
    store = ScoreStore(spark, scratch_path(spark, "test-store"))
    day1 = assemble_scores(_scores(spark, [("1", 0.1), ("2", 0.2)]), "2024-01-01")
    store.upsert(day1)
    first = {r["order_id"]: r for r in store.read().collect()}
    day1b = assemble_scores(_scores(spark, [("1", 0.7)]), "2024-01-01")
    store.upsert(day1b)
    store.upsert(day1b)  # twice = once
    rows = store.read().collect()
    assert len(rows) == 2
    got = {r["order_id"]: r for r in rows}
    assert got["1"]["risk_score"] == Decimal("0.700000") and got["2"]["risk_score"] == Decimal("0.200000")
    assert got["1"]["created_at"] >= first["1"]["created_at"]
    assert got["2"]["created_at"] == first["2"]["created_at"]
    store.upsert(assemble_scores(_scores(spark, [("2", 0.9)]), dt.date(2024, 1, 5)))
    latest = {r["order_id"]: r for r in report.latest_scores(store.read()).collect()}
    assert latest["2"]["score_date"] == dt.date(2024, 1, 5) and latest["1"]["score_date"] == dt.date(2024, 1, 1)
    assert store.read().filter(F.col("score_date") == dt.date(2024, 1, 1)).count() == 2


def test_a_new_day_is_written_without_a_staged_copy(spark, monkeypatch):
    store = ScoreStore(spark, scratch_path(spark, "new-day"))
    staged = []
    monkeypatch.setattr(score, "scratch_path", lambda *a: staged.append(a) or scratch_path(*a))
    for day in ("2024-01-01", "2024-01-02"):
        store.upsert(assemble_scores(_scores(spark, [("1", 0.1), ("2", 0.2)]), day))
    assert not staged
    store.upsert(assemble_scores(_scores(spark, [("2", 0.9)]), "2024-01-02"))
    assert len(staged) == 1
    got = sorted((str(r["score_date"]), r["order_id"], float(r["risk_score"])) for r in store.read().collect())
    assert got == [("2024-01-01", "1", 0.1), ("2024-01-01", "2", 0.2), ("2024-01-02", "1", 0.1), ("2024-01-02", "2", 0.9)]


def test_latest_per_key_picks_greatest_date(spark):
    df = spark.createDataFrame([("1", dt.date(2024, 1, 1), "a"), ("1", dt.date(2024, 1, 3), "c"),
                                ("1", dt.date(2024, 1, 2), "b")], "order_id string, score_date date, v string")
    r = latest_per_key(df, "order_id", "score_date").collect()
    assert [(x["score_date"], x["v"]) for x in r] == [(dt.date(2024, 1, 3), "c")]


def test_week_without_scores(spark):
    from helpers import item, order
    from orderlens.plans import marts
    r = raw(spark, orders=[order("1", "2024-01-01 10:00:00", "2024-01-03 10:00:00", "2024-01-10 00:00:00")],
            order_items=[item("1", 1, 1, 1)])
    sla = marts.sla_orders(marts.order_facts(r.orders, r.order_items, r.order_payments))
    enr = marts.sla_order_enriched(sla, marts.delivery_review(
        warehouse.fact_order_items(r.order_items, r.orders), r.order_reviews))
    empty = ScoreStore(spark, scratch_path(spark, "none")).read()
    w = report.wbr_weekly(report.sla_order_scored(enr, empty)).collect()[0]
    assert w["scored_cnt"] == 0 and w["high_risk_share"] is None and w["late_rate"] == 0.0
    assert w["ontime_rate"] == 1.0


def test_approx_percentile_mode_close_to_exact(spark):
    s = _scores(spark, [(str(i), i / 1000) for i in range(1001)])
    exact = {r["order_id"]: r["risk_flag"] for r in assemble_scores(s, "2024-01-01").collect()}
    approx = {r["order_id"]: r["risk_flag"] for r in assemble_scores(s, "2024-01-01", mode="approx_percentile").collect()}
    assert sum(exact[k] != approx[k] for k in exact) <= 2
    fixed = {r["order_id"]: r for r in assemble_scores(s, "2024-01-01", mode="fixed").collect()}
    assert fixed["350"]["risk_flag"] == "red" and fixed["349"]["risk_flag"] == "amber"
    assert fixed["199"]["risk_flag"] == "green" and fixed["0"]["threshold_red"] == Decimal("0.350000")
