"""Hand-made rows for the order, SLA and review marts (the easy-to-get-wrong semantics)."""

from helpers import d, item, money, order, payment, raw, review

from orderlens.plans import marts, warehouse


def _layers(spark, orders, items=(), payments=(), reviews=()):
    r = raw(spark, orders=list(orders), order_items=list(items), order_payments=list(payments),
            order_reviews=list(reviews))
    of = marts.order_facts(r.orders, r.order_items, r.order_payments)
    sla = marts.sla_orders(of)
    fact = warehouse.fact_order_items(r.order_items, r.orders)
    dr = marts.delivery_review(fact, r.order_reviews)
    enr = marts.sla_order_enriched(sla, dr)
    return r, of, sla, fact, dr, enr


def by_id(df, key="order_id"):
    return {row[key]: row for row in df.collect()}


def test_same_day_late_hour_is_on_time(spark):
    _, of, sla, *_ = _layers(spark, [order("1", "2024-01-01 08:00:00", "2024-01-10 23:59:00", "2024-01-10 00:00:00")])
    assert by_id(of)["1"]["is_late"] is False
    assert by_id(sla)["1"]["is_late"] is False
    assert by_id(sla)["1"]["days_late"] == 0


def test_undelivered_late_flag_three_vs_two_valued(spark):
    o = order("1", "2024-01-01 08:00:00", None, "2024-01-10 00:00:00", status="shipped")
    _, of, sla, fact, *_ = _layers(spark, [o], items=[item("1", 1, 10, 2)])
    assert by_id(of)["1"]["is_late"] is None
    assert by_id(sla)["1"]["is_late"] is False
    assert by_id(sla)["1"]["is_delivered"] is False
    it = marts.item_facts(fact).collect()[0]
    assert it["is_late"] is None and it["delivery_days"] is None


def test_null_estimate_gives_null_delay_and_bucket_and_no_cohort(spark):
    o = order("1", "2024-01-01 08:00:00", "2024-01-05 10:00:00", None)
    _, _, sla, _, _, enr = _layers(spark, [o], items=[item("1", 1, 10, 2)], reviews=[review("1", "r1", 1)])
    row = by_id(enr)["1"]
    assert row["days_late"] is None and row["delay_bucket"] is None and row["delay_cap"] is None
    assert marts.model_cohort(enr).count() == 0


def test_early_delivery(spark):
    o = order("1", "2024-01-01 08:00:00", "2024-01-05 10:00:00", "2024-01-10 00:00:00")
    _, _, sla, _, _, enr = _layers(spark, [o], items=[item("1", 1, 10, 2)], reviews=[review("1", "r1", 5)])
    row = by_id(enr)["1"]
    assert row["days_late"] == -5 and row["delay_days"] == 0 and row["delay_cap"] == 0
    assert row["delay_bucket"] == "0" and row["is_ontime"] is True
    assert row["delivery_delay_days"] == 0


def test_bucket_edges_and_cap(spark):
    expect = {1: "1-3", 3: "1-3", 4: "4-7", 7: "4-7", 8: "8-14", 14: "8-14", 15: "15-30", 30: "15-30",
              31: "15-30", 90: "15-30"}
    orders, items, reviews = [], [], []
    for late in expect:
        delivered = f"2024-03-{1 + late:02d} 12:00:00" if late < 30 else None
        o = order(str(late), "2024-01-01 08:00:00", delivered, "2024-03-01 00:00:00")
        if late >= 30:
            import datetime as dt
            o["order_delivered_customer_date"] = dt.datetime(2024, 3, 1, 12) + dt.timedelta(days=late)
        orders.append(o)
        items.append(item(str(late), 1, 10, 1))
        reviews.append(review(str(late), f"r{late}", 1))
    _, _, _, _, _, enr = _layers(spark, orders, items=items, reviews=reviews)
    rows = by_id(enr)
    for late, bucket in expect.items():
        assert rows[str(late)]["days_late"] == late
        assert rows[str(late)]["delay_bucket"] == bucket, late
        assert rows[str(late)]["delay_cap"] == min(late, 30)
    cohort = by_id(marts.model_cohort(enr))
    assert cohort["90"]["delay_cap"] == 30 and cohort["90"]["delivery_delay_days"] == 90
    assert cohort["31"]["delay_bucket"] == "15-30"


def test_order_without_items_or_payments(spark):
    _, of, *_ = _layers(spark, [order("1", "2024-01-01 08:00:00", None, None, status="created")])
    r = by_id(of)["1"]
    assert r["items_cnt"] == 0 and r["items_revenue"] == 0 and r["gmv"] == 0
    assert r["payment_value_total"] == 0 and r["max_installments"] == 0
    assert r["primary_payment_type"] is None


def test_primary_payment_type_needs_sequential_one(spark):
    o = [order("1", "2024-01-01 08:00:00", None, None), order("2", "2024-01-01 08:00:00", None, None)]
    p = [payment("1", 2, "voucher", 5, 3), payment("1", 3, "boleto", 7, 1),
         payment("2", 1, "credit_card", 10, 6), payment("2", 2, "voucher", 1, 1)]
    _, of, *_ = _layers(spark, o, payments=p)
    rows = by_id(of)
    assert rows["1"]["primary_payment_type"] is None
    assert rows["1"]["payment_value_total"] == money(12) and rows["1"]["max_installments"] == 3
    assert rows["2"]["primary_payment_type"] == "credit_card"


def test_items_and_payments_do_not_multiply(spark):
    o = [order("1", "2024-01-01 08:00:00", None, None)]
    i = [item("1", 1, 10, 1), item("1", 2, 20, 2), item("1", 3, 30, 3)]
    p = [payment("1", 1, "voucher", 30, 1), payment("1", 2, "voucher", 36, 1)]
    _, of, *_ = _layers(spark, o, items=i, payments=p)
    r = by_id(of)["1"]
    assert r["items_cnt"] == 3 and r["items_revenue"] == money(60) and r["freight_total"] == money(6)
    assert r["gmv"] == money(66) and r["payment_value_total"] == money(66)


def test_two_reviews_take_max_and_null_score(spark):
    o = [order("1", "2024-01-01 08:00:00", "2024-01-05 00:00:00", "2024-01-10 00:00:00"),
         order("2", "2024-01-01 08:00:00", "2024-01-05 00:00:00", "2024-01-10 00:00:00")]
    i = [item("1", 1, 10, 1), item("2", 1, 10, 1)]
    rv = [review("1", "a", 1), review("1", "b", 4), review("2", "c", None)]
    _, _, _, _, dr, enr = _layers(spark, o, items=i, reviews=rv)
    rows = by_id(dr)
    assert rows["1"]["review_score"] == 4 and rows["1"]["is_low_review"] is False
    assert rows["2"]["review_score"] is None and rows["2"]["is_low_review"] is None
    assert {r["order_id"] for r in marts.model_cohort(enr).collect()} == {"1"}


def test_delivery_review_needs_items_and_review(spark):
    o = [order("1", "2024-01-01 08:00:00", "2024-01-05 00:00:00", "2024-01-10 00:00:00"),
         order("2", "2024-01-01 08:00:00", "2024-01-05 00:00:00", "2024-01-10 00:00:00")]
    _, _, _, _, dr, _ = _layers(spark, o, items=[item("1", 1, 10, 1)], reviews=[review("2", "x", 1)])
    assert dr.count() == 0


def test_day_without_delivery_has_null_late_rate(spark):
    o = [order("1", "2024-01-01 08:00:00", None, "2024-01-10 00:00:00", status="shipped")]
    _, _, sla, *_ = _layers(spark, o)
    day = marts.sla_daily(sla).collect()[0]
    assert day["orders_cnt"] == 1 and day["delivered_cnt"] == 0 and day["backlog_cnt"] == 1
    assert day["late_rate"] is None and day["avg_delivery_days"] is None


def test_delivered_day_without_late_order_has_null_p90(spark):
    o = [order("1", "2024-01-01 08:00:00", "2024-01-05 00:00:00", "2024-01-10 00:00:00"),
         order("2", "2024-01-02 08:00:00", "2024-01-05 00:00:00", "2024-01-10 00:00:00")]
    _, _, sla, *_ = _layers(spark, o)
    day = marts.sla_delivered_daily(sla).collect()[0]
    assert day["delivered_cnt"] == 2 and day["late_cnt"] == 0 and day["late_rate"] == 0.0
    assert day["p90_days_late"] is None
    assert abs(day["p90_delivery_days"] - 3.9) < 1e-9  # days 4 and 3: 3 + 0.9 * 1


def test_p90_of_late_subset(spark):
    o = [order(str(k), "2024-01-01 08:00:00", f"2024-01-{10 + k:02d} 00:00:00", "2024-01-10 00:00:00")
         for k in range(0, 6)]
    _, _, sla, *_ = _layers(spark, o)
    day_rows = {r["delivered_date"]: r for r in marts.sla_delivered_daily(sla).collect()}
    assert day_rows[d("2024-01-15")]["p90_days_late"] == 5.0
    assert day_rows[d("2024-01-10")]["p90_days_late"] is None


def test_sunday_week_start_and_dow(spark):
    o = [order("1", "2024-01-07 10:00:00", "2024-01-07 12:00:00", "2024-01-10 00:00:00")]
    r, _, _, _, _, enr = _layers(spark, o)
    row = by_id(enr)["1"]
    assert row["delivered_week_start"] == d("2024-01-01")
    assert row["delivered_month_start"] == d("2024-01-01")
    dates = {x["date_key"]: x for x in warehouse.dim_date(r.orders).collect()}
    assert dates[d("2024-01-07")]["day_of_week"] == 0
    assert dates[d("2024-01-10")]["day_of_week"] == 3


def test_fractional_delivery_days(spark):
    o = [order("1", "2024-01-01 00:00:00", "2024-01-02 12:00:00", "2024-01-10 00:00:00")]
    _, of, sla, *_ = _layers(spark, o)
    assert by_id(of)["1"]["delivery_days"] == 1.5
    assert by_id(sla)["1"]["delivery_days"] == 1


def test_pre_aggregated_order_totals_equal_fact_aggregation(spark):
    o = [order("1", "2024-01-01 08:00:00", "2024-01-05 00:00:00", "2024-01-10 00:00:00"),
         order("1", "2024-01-02 08:00:00", "2024-01-06 00:00:00", "2024-01-09 00:00:00"),  # duplicate order row
         order("2", "2024-01-01 08:00:00", None, "2024-01-10 00:00:00", status="shipped"),
         order("3", "2024-01-01 08:00:00", None, None)]
    i = [item("1", 1, 10, 1), item("1", 2, 5, 2), item("2", 1, 7, 3), {**item("2", 2, 1, 1), "price": None},
         item("4", 1, 3, 3)]
    r = raw(spark, orders=o, order_items=i)
    fact = warehouse.fact_order_items(r.order_items, r.orders)
    a = sorted(tuple(x) for x in marts.order_item_agg(fact).collect())
    b = sorted(tuple(x) for x in marts.order_item_agg_raw(r.order_items, r.orders).collect())
    assert a == b
    assert marts.order_item_agg_raw(r.order_items, r.orders).schema == marts.order_item_agg(fact).schema
