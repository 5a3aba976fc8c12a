"""Customer RFM mart: recency, frequency, monetary value per person, quintile scores and segment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.functions import rules as R
from orderlens.operators.cuts import ntiles
from orderlens.schema import ORDER_STATUS_DELIVERED, RFM_TILES


def rfm_params(order_facts: DataFrame) -> DataFrame:
    """One row: as-of date = the latest purchase date over all orders (delivered or not)."""
    return (order_facts.filter(F.col("purchase_ts").isNotNull())
            .agg(F.to_date(F.max("purchase_ts")).alias("as_of_date")))


def rfm_raw(order_facts: DataFrame, customers: DataFrame) -> DataFrame:
    """Per person (customer_unique_id, renamed customer_id): last delivered purchase date, order
    count and payment total. count/sum/max are partial aggregates, so a person with a large share
    of the orders is pre-aggregated map-side."""
    f = order_facts.filter(F.col("purchase_ts").isNotNull() & F.col("customer_id").isNotNull()
                           & (F.col("order_status") == ORDER_STATUS_DELIVERED))
    c = customers.select("customer_id", "customer_unique_id")
    base = f.join(c, "customer_id", "inner").select(
        F.col("customer_unique_id").alias("customer_id"), "order_id",
        F.to_date("purchase_ts").alias("purchase_date"), "payment_value_total")
    return base.groupBy("customer_id").agg(
        F.max("purchase_date").alias("last_purchase_date"),
        F.count("order_id").alias("frequency"),
        F.sum("payment_value_total").alias("monetary_value"),
    )


def customer_rfm(order_facts: DataFrame, customers: DataFrame, tiles: int = RFM_TILES) -> DataFrame:
    """RFM scores: R = (tiles+1) - NTILE by recency ascending, F and M = NTILE ascending.

    Ties inside a score column are broken by customer_id, so the result is deterministic. The persons are stored once; the
    cut keys of all three NTILEs are found together (see :mod:`orderlens.operators.cuts`) and one projection
    scores every person, so no row is sorted or moved for a rank.
    """
    # the one-row parameter table is a scalar subquery: computed once, no join
    as_of = rfm_params(order_facts).scalar()
    raw = rfm_raw(order_facts, customers)
    rfm = raw.select(
        "customer_id", as_of.alias("as_of_date"),
        F.datediff(as_of, F.col("last_purchase_date")).alias("recency_days"),
        "last_purchase_date", "frequency", "monetary_value")
    scored = ntiles(rfm, {"_r": "recency_days", "f_score": "frequency", "m_score": "monetary_value"}, "customer_id", tiles)
    r = (F.lit(tiles + 1) - F.col("_r")).cast("int")
    out = scored.select("*", r.alias("r_score"))
    return out.select(
        "customer_id", "as_of_date", "last_purchase_date", "recency_days", "frequency", "monetary_value",
        "r_score", "f_score", "m_score",
        F.concat(F.col("r_score").cast("string"), F.col("f_score").cast("string"),
                 F.col("m_score").cast("string")).alias("rfm_score"),
        R.rfm_segment("r_score", "f_score", "m_score", "frequency").alias("rfm_segment"),
    )
