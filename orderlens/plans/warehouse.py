"""Star schema: four dimensions loaded insert-if-absent, and the item fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.functions import dates as D
from orderlens.operators.keyed import insert_if_absent, one_per_key
from orderlens.schema import DW_KEYS, DW_SCHEMAS


def _conform(df: DataFrame, table: str) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in DW_SCHEMAS[table].fields])


def _load(existing: DataFrame | None, incoming: DataFrame, table: str) -> DataFrame:
    """Insert-if-absent into ``existing`` (or into an empty table). Duplicate incoming keys collapse to
    one row by the key aggregation, which also removes exact duplicates (no separate DISTINCT pass)."""
    keys = list(DW_KEYS[table])
    inc = _conform(incoming, table)
    if existing is None:
        return one_per_key(inc.dropna(subset=keys), keys)
    return insert_if_absent(_conform(existing, table), inc, keys)


def dim_customer_rows(customers: DataFrame) -> DataFrame:
    return customers.select("customer_id", "customer_unique_id", "customer_city", "customer_state",
                            "customer_zip_code_prefix").filter(F.col("customer_id").isNotNull())


def dim_customer(customers: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    return _load(existing, dim_customer_rows(customers), "dim_customer")


def dim_sellers(sellers: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    rows = (sellers.select("seller_id", "seller_zip_code_prefix", "seller_city", "seller_state")
            .filter(F.col("seller_id").isNotNull()))
    return _load(existing, rows, "dim_sellers")


def dim_products(products: DataFrame, translation: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Products with the English category name; the translation is a small lookup (Spark broadcasts
    it when its size estimate is under the broadcast threshold)."""
    p = products.filter(F.col("product_id").isNotNull())
    t = translation.select("product_category_name", "product_category_name_english")
    rows = p.join(t, "product_category_name", "left").select(
        "product_id", "product_category_name", "product_category_name_english", "product_weight_g",
        "product_length_cm", "product_height_cm", "product_width_cm")
    return _load(existing, rows, "dim_products")


ORDER_TIMESTAMPS = ("order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
                    "order_delivered_customer_date", "order_estimated_delivery_date")


def dim_date(orders: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Calendar of every day that occurs in any of the five order timestamps.

    One scan: the five dates of a row are exploded and made distinct
    (a hash aggregation, partial map-side, so the shuffle carries at most one row per day per task).
    """
    days = orders.select(F.explode(F.array(*[D.as_date(c) for c in ORDER_TIMESTAMPS])).alias("d"))
    # the other columns follow from the day, so distinct days are all there is to aggregate
    days = days.filter(F.col("d").isNotNull()).distinct()
    rows = _conform(days.select(
        F.col("d").alias("date_key"),
        F.year("d").alias("year"),
        F.month("d").alias("month"),
        F.dayofmonth("d").alias("day"),
        D.pg_day_of_week("d").alias("day_of_week"),
    ), "dim_date")
    if existing is None:
        return rows
    have = _conform(existing, "dim_date")
    return have.unionByName(rows.join(have.select("date_key"), "date_key", "left_anti"))


def fact_order_items(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Items joined with their order (inner): one row per (order_id, order_item_id)."""
    i = items.alias("i")
    o = orders.alias("o")
    j = i.join(o, F.col("i.order_id") == F.col("o.order_id"), "inner")
    return _conform(j.select(
        F.col("i.order_id").alias("order_id"),
        F.col("i.order_item_id").alias("order_item_id"),
        F.col("o.customer_id").alias("customer_id"),
        F.col("i.seller_id").alias("seller_id"),
        F.col("i.product_id").alias("product_id"),
        F.col("o.order_status").alias("order_status"),
        F.col("o.order_purchase_timestamp").alias("purchase_ts"),
        F.col("o.order_approved_at").alias("approved_ts"),
        F.col("o.order_delivered_carrier_date").alias("delivered_carrier_ts"),
        F.col("o.order_delivered_customer_date").alias("delivered_customer_ts"),
        D.as_date("o.order_estimated_delivery_date").alias("estimated_delivery_date"),
        F.col("i.shipping_limit_date").alias("shipping_limit_ts"),
        F.col("i.price").alias("price"),
        F.col("i.freight_value").alias("freight_value"),
    ), "fact_order_items")
