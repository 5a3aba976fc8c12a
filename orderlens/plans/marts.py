"""Order-, item- and day-level marts, the enriched order view and the model cohort.

Every function takes DataFrames and returns a lazy DataFrame; nothing is collected. ``order_id`` is
the grouping and join key throughout: raw rows are aggregated per order before their only exchange, and
the aggregates are joined in the partitioning that it gave them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.functions import dates as D
from orderlens.functions import rules as R
from orderlens.operators.grouped import grouped_percentiles


def order_facts(orders: DataFrame, items: DataFrame, payments: DataFrame) -> DataFrame:
    """One row per order: timestamps, delivery metrics, item and payment totals.

    Items and payments are aggregated per order before the join, so an order's items never
    multiply its payments.
    """
    o = orders.select(
        "order_id", "customer_id", "order_status",
        F.col("order_purchase_timestamp").alias("purchase_ts"),
        F.col("order_approved_at").alias("approved_ts"),
        F.col("order_delivered_carrier_date").alias("delivered_carrier_ts"),
        F.col("order_delivered_customer_date").alias("delivered_customer_ts"),
        D.as_date("order_estimated_delivery_date").alias("estimated_delivery_date"),
    )
    i = items.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("items_cnt"),
        F.sum("price").alias("items_revenue"),
        F.sum("freight_value").alias("freight_total"),
        F.sum(F.col("price") + F.col("freight_value")).alias("gmv"),
    )
    p = payments.groupBy("order_id").agg(
        F.sum("payment_value").alias("payment_value_total"),
        F.max("payment_installments").alias("max_installments"),
        F.max(F.when(F.col("payment_sequential") == 1, F.col("payment_type"))).alias("primary_payment_type"),
    )
    j = o.join(i, "order_id", "left").join(p, "order_id", "left")
    zero = F.lit(0)
    return j.select(
        "order_id", "customer_id", "order_status", "purchase_ts", "approved_ts",
        "delivered_carrier_ts", "delivered_customer_ts", "estimated_delivery_date",
        D.fractional_days("purchase_ts", "delivered_customer_ts").alias("delivery_days"),
        R.late_flag_nullable("delivered_customer_ts", "estimated_delivery_date").alias("is_late"),
        F.coalesce("items_cnt", zero.cast("bigint")).alias("items_cnt"),
        F.coalesce("items_revenue", zero.cast("decimal(22,2)")).alias("items_revenue"),
        F.coalesce("freight_total", zero.cast("decimal(22,2)")).alias("freight_total"),
        F.coalesce("gmv", zero.cast("decimal(23,2)")).alias("gmv"),
        F.coalesce("payment_value_total", zero.cast("decimal(22,2)")).alias("payment_value_total"),
        F.coalesce("max_installments", zero).alias("max_installments"),
        "primary_payment_type",
    )


def sla_orders(order_facts_df: DataFrame) -> DataFrame:
    """Order-level SLA: grouping dates, two-valued late flag, whole-day lead times (days_late may be < 0)."""
    of = order_facts_df
    return of.select(
        "order_id", "customer_id", "order_status", "purchase_ts", "approved_ts",
        "delivered_carrier_ts", "delivered_customer_ts", "estimated_delivery_date",
        D.as_date("purchase_ts").alias("purchase_date"),
        D.as_date("delivered_customer_ts").alias("delivered_date"),
        F.col("delivered_customer_ts").isNotNull().alias("is_delivered"),
        R.late_flag("delivered_customer_ts", "estimated_delivery_date").alias("is_late"),
        D.day_diff("delivered_customer_ts", "purchase_ts").alias("delivery_days"),
        D.day_diff("approved_ts", "purchase_ts").alias("approval_days"),
        D.day_diff("delivered_carrier_ts", "approved_ts").alias("ship_days"),
        D.day_diff("delivered_customer_ts", "estimated_delivery_date").alias("days_late"),
    )


def sla_daily(sla: DataFrame) -> DataFrame:
    """Per purchase date: orders, delivered, late, backlog, conditional averages, late rate."""
    delivered = F.sum(F.col("is_delivered").cast("int"))
    late = F.sum(F.col("is_late").cast("int"))
    return sla.groupBy("purchase_date").agg(
        F.count(F.lit(1)).alias("orders_cnt"),
        delivered.alias("delivered_cnt"),
        late.alias("late_cnt"),
        (F.count(F.lit(1)) - delivered).alias("backlog_cnt"),
        F.avg(F.when(F.col("is_delivered"), F.col("delivery_days"))).alias("avg_delivery_days"),
        F.avg(F.when(F.col("is_late"), F.col("days_late"))).alias("avg_days_late"),
        R.safe_ratio(late, delivered).alias("late_rate"),
    )


def sla_delivered_daily(sla: DataFrame) -> DataFrame:
    """Per delivered date: counts, averages, exact p90 of lead time and of days late among late orders.

    The late-only p90 is a filtered aggregate in the same pass (no second scan and join). Exact
    percentiles keep a value->count map per group; the values are whole days, so the map stays small
    even for a date holding a large share of the rows.
    """
    base = sla.filter(F.col("is_delivered"))
    late_days = F.when(F.col("is_late") & F.col("days_late").isNotNull(), F.col("days_late"))
    a = base.groupBy("delivered_date").agg(
        F.count(F.lit(1)).alias("delivered_cnt"),
        F.sum(F.col("is_late").cast("int")).alias("late_cnt"),
        F.avg("delivery_days").alias("avg_delivery_days"),
        F.percentile("delivery_days", 0.9).alias("p90_delivery_days"),
        F.avg(F.when(F.col("is_late"), F.col("days_late"))).alias("avg_days_late"),
        F.percentile(late_days, 0.9).alias("p90_days_late"),
    )
    return a.select(
        "delivered_date", "delivered_cnt", "late_cnt",
        R.safe_ratio("late_cnt", "delivered_cnt").alias("late_rate"),
        "avg_delivery_days", "p90_delivery_days", "avg_days_late", "p90_days_late",
    )


def item_facts(fact_items: DataFrame) -> DataFrame:
    """Item grain: fact columns, item total, dates, three-valued late flag, whole-day lead time."""
    f = fact_items
    return f.select(
        "order_id", "order_item_id", "customer_id", "seller_id", "product_id", "order_status",
        "purchase_ts", "approved_ts", "delivered_carrier_ts", "delivered_customer_ts",
        "estimated_delivery_date", "shipping_limit_ts", "price", "freight_value",
        (F.col("price") + F.col("freight_value")).alias("item_total"),
        D.as_date("purchase_ts").alias("purchase_date"),
        D.as_date("delivered_customer_ts").alias("delivered_date"),
        F.col("delivered_customer_ts").isNotNull().alias("is_delivered"),
        R.late_flag_nullable("delivered_customer_ts", "estimated_delivery_date").alias("is_late"),
        D.day_diff("delivered_customer_ts", "purchase_ts").alias("delivery_days"),
    )


def order_item_agg(fact_items: DataFrame) -> DataFrame:
    """Per order, from the stored item fact: order dates and basket totals (a scan, so the
    aggregation is partial map-side and a hot order is collapsed before the shuffle)."""
    return fact_items.groupBy("order_id").agg(
        F.min("purchase_ts").alias("purchase_ts"),
        F.max("delivered_customer_ts").alias("delivered_customer_ts"),
        F.max("estimated_delivery_date").alias("estimated_delivery_date"),
        F.count(F.lit(1)).alias("items_count"),
        F.sum("price").alias("price"),
        F.sum("freight_value").alias("freight_value"),
    )


def order_item_agg_raw(items: DataFrame, orders: DataFrame) -> DataFrame:
    """The same as :func:`order_item_agg` over ``fact_order_items(items, orders)``, without building the
    item-grain join: items and orders are each reduced to one row per order first, then joined.

    Aggregating after the join would put all items of a hot order into one task (the join output is
    already partitioned by order_id, so no map-side reduction happens). Exactness: an order_id that
    occurs m times among the orders multiplies its items m times in the join, so counts and sums are
    scaled by m; min/max are unchanged.
    """
    i = items.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("price").alias("_price"), F.sum("freight_value").alias("_freight"))
    o = orders.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("_m"),
        F.min("order_purchase_timestamp").alias("purchase_ts"),
        F.max("order_delivered_customer_date").alias("delivered_customer_ts"),
        F.max(D.as_date("order_estimated_delivery_date")).alias("estimated_delivery_date"))
    j = i.join(o, "order_id", "inner")
    m = F.col("_m")
    return j.select(
        "order_id", "purchase_ts", "delivered_customer_ts", "estimated_delivery_date",
        (F.col("_n") * m).alias("items_count"),
        (F.col("_price") * m).cast("decimal(22,2)").alias("price"),
        (F.col("_freight") * m).cast("decimal(22,2)").alias("freight_value"),
    )


def delivery_review(fact_items: DataFrame, reviews: DataFrame, order_agg: DataFrame | None = None) -> DataFrame:
    """One row per order that has items and a review: best review score, clamped delay, basket totals.

    ``order_agg`` (from :func:`order_item_agg_raw`) replaces the aggregation of ``fact_items``."""
    a = order_agg if order_agg is not None else order_item_agg(fact_items)
    r = reviews.groupBy("order_id").agg(F.max("review_score").alias("review_score"))
    j = a.join(r, "order_id", "inner")
    return j.select(
        "order_id", "review_score",
        R.low_review("review_score").alias("is_low_review"),
        R.clamp_days(D.day_diff("delivered_customer_ts", "estimated_delivery_date")).alias("delivery_delay_days"),
        "price", "freight_value", "items_count",
        F.month("purchase_ts").alias("month"),
    )


REVIEW_FEATURES = ("review_score", "is_low_review", "delivery_delay_days", "price", "freight_value",
                   "items_count", "month")


def sla_order_enriched(sla: DataFrame, review: DataFrame | None) -> DataFrame:
    """Flat order view for BI and scoring: SLA columns, clamped and capped delay, week/month starts,
    delay bucket, on-time flag, and the review features (left join; ``review=None`` leaves them out,
    for readers that need none of them and read the review mart from storage, where Catalyst cannot
    prove it unique per order and so cannot drop the join itself)."""
    days_late = F.col("days_late").cast("int")
    delay_cap = R.clamp_days(days_late, cap=30)
    base = sla.select(
        "order_id", "customer_id", "order_status", "purchase_ts", "approved_ts",
        "delivered_carrier_ts", "delivered_customer_ts", "estimated_delivery_date",
        "purchase_date", "delivered_date", "is_delivered", "is_late",
        "delivery_days", "approval_days", "ship_days",
        days_late.alias("days_late"),
        R.clamp_days(days_late).alias("delay_days"),
        delay_cap.alias("delay_cap"),
        D.week_start("delivered_date").alias("delivered_week_start"),
        D.week_start("purchase_date").alias("purchase_week_start"),
        D.month_start("delivered_date").alias("delivered_month_start"),
    )
    bucketed = base.select(
        "*",
        R.delay_bucket("delay_cap").alias("delay_bucket"),
        R.ontime_flag("is_delivered", "is_late").alias("is_ontime"),
    )
    if review is None:
        return bucketed
    return bucketed.join(review.select("order_id", *REVIEW_FEATURES), "order_id", "left")


def model_cohort(enriched: DataFrame) -> DataFrame:
    """Complete cases of delivered, reviewed orders with label and model features.

    The filter on review columns turns the enriched view's left join into an inner join.
    """
    ddd = F.col("delivery_delay_days")
    capped = R.capped_delay(ddd)
    e = enriched.filter(
        F.col("is_delivered")
        & F.col("is_low_review").isNotNull() & ddd.isNotNull() & F.col("price").isNotNull()
        & F.col("freight_value").isNotNull() & F.col("items_count").isNotNull()
        & F.col("month").isNotNull())
    return e.select(
        "order_id",
        R.as_label("is_low_review").alias("is_low_review"),
        "delivery_delay_days",
        capped.alias("delay_cap"),
        R.delay_bucket(capped, null_as_null=False).alias("delay_bucket"),
        "price", "freight_value", "items_count", "month",
        F.log1p(F.col("price").cast("double")).alias("log_price"),
        F.log1p(F.col("freight_value").cast("double")).alias("log_freight_value"),
    )


def delivery_days_daily(order_facts: DataFrame) -> DataFrame:
    """Per delivered date: p50, p90 and p99 of the days from purchase to delivery, as fractions of a day, and p90 of the late
    orders'. The values are nearly all distinct, so the days are searched together (see :mod:`orderlens.operators.grouped`)."""
    days = order_facts.filter(F.col("delivered_customer_ts").isNotNull() & F.col("delivery_days").isNotNull()).select(
        F.to_date("delivered_customer_ts").alias("delivered_date"), "delivery_days", "is_late")
    late = F.when(F.col("is_late"), F.col("delivery_days"))
    return grouped_percentiles(days, ["delivered_date"], {"all": F.col("delivery_days"), "late": late}, {
        "p50_delivery_days": ("all", 0.5), "p90_delivery_days": ("all", 0.9), "p99_delivery_days": ("all", 0.99),
        "p90_late_delivery_days": ("late", 0.9)})


def low_review_by_bucket(cohort: DataFrame) -> DataFrame:
    """Observed low-review rate per delay bucket (the "8-day cliff")."""
    return cohort.groupBy("delay_bucket").agg(
        F.count(F.lit(1)).alias("orders_cnt"),
        F.sum("is_low_review").alias("low_review_cnt"),
        F.avg("is_low_review").alias("low_review_rate"),
    )
