"""Hand-made raw rows for unit tests."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from orderlens.schema import RAW_SCHEMAS
from orderlens.sources.adapter import RawTables


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def d(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def money(x) -> Decimal:
    return Decimal(str(x)).quantize(Decimal("0.01"))


def frame(spark, table: str, rows: list[dict]):
    schema = RAW_SCHEMAS[table]
    data = [tuple(r.get(f.name) for f in schema.fields) for r in rows]
    return spark.createDataFrame(data, schema)


def raw(spark, **tables: list[dict]) -> RawTables:
    frames = {name: frame(spark, name, tables.get(name, [])) for name in RAW_SCHEMAS}
    return RawTables(spark, lambda name: frames[name])


def order(oid: str, purchase: str, delivered: str | None, estimated: str | None, status: str = "delivered",
          customer: str | None = None, approved: str | None = None, carrier: str | None = None) -> dict:
    return {
        "order_id": oid, "customer_id": customer or f"c{oid}", "order_status": status,
        "order_purchase_timestamp": ts(purchase) if purchase else None,
        "order_approved_at": ts(approved) if approved else None,
        "order_delivered_carrier_date": ts(carrier) if carrier else None,
        "order_delivered_customer_date": ts(delivered) if delivered else None,
        "order_estimated_delivery_date": ts(estimated) if estimated else None,
    }


def item(oid: str, n: int, price, freight, product: str = "p1", seller: str = "s1") -> dict:
    return {"order_id": oid, "order_item_id": n, "product_id": product, "seller_id": seller,
            "shipping_limit_date": None, "price": money(price), "freight_value": money(freight)}


def payment(oid: str, seq: int, ptype: str, value, inst: int = 1) -> dict:
    return {"order_id": oid, "payment_sequential": seq, "payment_type": ptype,
            "payment_installments": inst, "payment_value": money(value)}


def review(oid: str, rid: str, score: int | None) -> dict:
    return {"review_id": rid, "order_id": oid, "review_score": score}


def customer(cid: str, uid: str) -> dict:
    return {"customer_id": cid, "customer_unique_id": uid, "customer_zip_code_prefix": "00001",
            "customer_city": "x", "customer_state": "y"}
