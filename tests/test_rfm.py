"""RFM mart on hand-made orders."""

from helpers import customer, order, payment, raw

from orderlens.plans import marts, rfm


def _rfm(spark, orders, customers, payments):
    r = raw(spark, orders=orders, customers=customers, order_payments=payments)
    of = marts.order_facts(r.orders, r.order_items, r.order_payments)
    return {x["customer_id"]: x for x in rfm.customer_rfm(of, r.customers).collect()}


def test_as_of_from_any_order_and_person_merges_ids(spark):
    orders = [order("1", "2024-01-01 10:00:00", "2024-01-05 10:00:00", "2024-01-10 00:00:00", customer="c1"),
              order("2", "2024-01-03 10:00:00", "2024-01-06 10:00:00", "2024-01-10 00:00:00", customer="c2"),
              order("3", "2024-02-01 10:00:00", None, "2024-02-10 00:00:00", status="shipped", customer="c3")]
    customers = [customer("c1", "u1"), customer("c2", "u1"), customer("c3", "u2")]
    payments = [payment("1", 1, "boleto", 10), payment("2", 1, "boleto", 5), payment("3", 1, "boleto", 99)]
    out = _rfm(spark, orders, customers, payments)
    assert set(out) == {"u1"}  # u2 has no delivered order
    u1 = out["u1"]
    assert str(u1["as_of_date"]) == "2024-02-01"  # newest order is not delivered but sets the date
    assert u1["frequency"] == 2 and float(u1["monetary_value"]) == 15.0
    assert u1["recency_days"] == 29 and str(u1["last_purchase_date"]) == "2024-01-03"
    assert u1["r_score"] == 5 and u1["f_score"] == 1 and u1["rfm_score"] == "511"


def test_segments_first_match(spark):
    orders, customers, payments = [], [], []
    for i in range(10):
        for j in range(i % 3 + 1):
            oid = f"{i}-{j}"
            orders.append(order(oid, f"2024-01-{1 + i:02d} 10:00:00", "2024-01-20 10:00:00",
                                "2024-01-25 00:00:00", customer=f"c{oid}"))
            customers.append(customer(f"c{oid}", f"u{i}"))
            payments.append(payment(oid, 1, "boleto", 10 * (i + 1)))
    out = _rfm(spark, orders, customers, payments)
    assert len(out) == 10
    from collections import Counter
    assert Counter(r["r_score"] for r in out.values()) == Counter({5: 2, 4: 2, 3: 2, 2: 2, 1: 2})
    for r in out.values():
        R, Fq, M, n = r["r_score"], r["f_score"], r["m_score"], r["frequency"]
        if R >= 4 and Fq >= 4 and M >= 4:
            expect = "champions"
        elif R >= 4 and Fq >= 3:
            expect = "loyal_customers"
        elif n == 1 and R >= 4 and M >= 4:
            expect = "new_high_value"
        elif n == 1 and R >= 4:
            expect = "new_customers"
        elif R <= 2 and Fq >= 4:
            expect = "at_risk_loyal"
        elif R <= 2 and M >= 4:
            expect = "big_spenders_at_risk"
        elif R == 1:
            expect = "lost"
        else:
            expect = "others"
        assert r["rfm_segment"] == expect
