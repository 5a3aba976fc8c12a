"""Declared schemas of the raw and warehouse layers, and the fixed values the marts depend on."""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()
I = T.IntegerType()
D = T.DoubleType()
TS = T.TimestampNTZType()
MONEY = T.DecimalType(12, 2)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# --- raw layer: one StructType per source file, columns bound by position ---
RAW_SCHEMAS: dict[str, T.StructType] = {
    "customers": _struct(
        ("customer_id", S), ("customer_unique_id", S), ("customer_zip_code_prefix", S),
        ("customer_city", S), ("customer_state", S)),
    "geolocation": _struct(
        ("geolocation_zip_code_prefix", S), ("geolocation_lat", D), ("geolocation_lng", D),
        ("geolocation_city", S), ("geolocation_state", S)),
    "orders": _struct(
        ("order_id", S), ("customer_id", S), ("order_status", S),
        ("order_purchase_timestamp", TS), ("order_approved_at", TS),
        ("order_delivered_carrier_date", TS), ("order_delivered_customer_date", TS),
        ("order_estimated_delivery_date", TS)),
    "order_items": _struct(
        ("order_id", S), ("order_item_id", I), ("product_id", S), ("seller_id", S),
        ("shipping_limit_date", TS), ("price", MONEY), ("freight_value", MONEY)),
    "order_payments": _struct(
        ("order_id", S), ("payment_sequential", I), ("payment_type", S),
        ("payment_installments", I), ("payment_value", MONEY)),
    "order_reviews": _struct(
        ("review_id", S), ("order_id", S), ("review_score", I), ("review_comment_title", S),
        ("review_comment_message", S), ("review_creation_date", TS), ("review_answer_timestamp", TS)),
    "products": _struct(
        ("product_id", S), ("product_category_name", S), ("product_name_lenght", I),
        ("product_description_lenght", I), ("product_photos_qty", I), ("product_weight_g", I),
        ("product_length_cm", I), ("product_height_cm", I), ("product_width_cm", I)),
    "sellers": _struct(
        ("seller_id", S), ("seller_zip_code_prefix", S), ("seller_city", S), ("seller_state", S)),
    "category_translation": _struct(
        ("product_category_name", S), ("product_category_name_english", S)),
}

RAW_TABLES = tuple(RAW_SCHEMAS)

# --- warehouse layer (dimension keys are unique, fact key is (order_id, order_item_id)) ---
DW_SCHEMAS: dict[str, T.StructType] = {
    "dim_customer": _struct(
        ("customer_id", S), ("customer_unique_id", S), ("customer_city", S),
        ("customer_state", S), ("customer_zip_code_prefix", S)),
    "dim_sellers": _struct(
        ("seller_id", S), ("seller_zip_code_prefix", S), ("seller_city", S), ("seller_state", S)),
    "dim_products": _struct(
        ("product_id", S), ("product_category_name", S), ("product_category_name_english", S),
        ("product_weight_g", I), ("product_length_cm", I), ("product_height_cm", I),
        ("product_width_cm", I)),
    "dim_date": _struct(
        ("date_key", T.DateType()), ("year", I), ("month", I), ("day", I), ("day_of_week", I)),
    "fact_order_items": _struct(
        ("order_id", S), ("order_item_id", I), ("customer_id", S), ("seller_id", S),
        ("product_id", S), ("order_status", S), ("purchase_ts", TS), ("approved_ts", TS),
        ("delivered_carrier_ts", TS), ("delivered_customer_ts", TS),
        ("estimated_delivery_date", T.DateType()), ("shipping_limit_ts", TS),
        ("price", MONEY), ("freight_value", MONEY)),
}

DW_KEYS: dict[str, tuple[str, ...]] = {
    "dim_customer": ("customer_id",),
    "dim_sellers": ("seller_id",),
    "dim_products": ("product_id",),
    "dim_date": ("date_key",),
    "fact_order_items": ("order_id", "order_item_id"),
}

# Score store; partitioned by score_date on disk.
SCORE_SCHEMA = T.StructType([
    T.StructField("order_id", S, False),
    T.StructField("score_date", T.DateType(), False),
    T.StructField("risk_score", T.DecimalType(10, 6), False),
    T.StructField("risk_flag", S, False),
    T.StructField("threshold_green", T.DecimalType(10, 6), False),
    T.StructField("threshold_red", T.DecimalType(10, 6), False),
    T.StructField("model_version", S, False),
    T.StructField("created_at", T.TimestampType(), False),
])

# --- fixed values: these must equal the reference's for equal results ---
ORDER_STATUS_DELIVERED = "delivered"
DELAY_CAP_DAYS = 30
LOW_REVIEW_MAX_SCORE = 2
# delay bucket labels and their inclusive day ranges, in level order (first = baseline)
DELAY_BUCKETS = (("0", 0, 0), ("1-3", 1, 3), ("4-7", 4, 7), ("8-14", 8, 14), ("15-30", 15, 30))
DELAY_BUCKET_LEVELS = tuple(b[0] for b in DELAY_BUCKETS)
MONTH_LEVELS = tuple(range(1, 13))
RFM_TILES = 5
# RFM segments, first match wins, in this order
RFM_SEGMENTS = (
    "champions", "loyal_customers", "new_high_value", "new_customers",
    "at_risk_loyal", "big_spenders_at_risk", "lost", "others",
)
# score-store column defaults
DEFAULT_THRESHOLD_GREEN = "0.20"
DEFAULT_THRESHOLD_RED = "0.35"
MODEL_VERSION = "late_review_logit_v1"
# batch percentiles for the risk flag: red at or above P95, amber at or above P90
RED_PERCENTILE = 0.95
AMBER_PERCENTILE = 0.90
RISK_FLAGS = ("green", "amber", "red")
# model features in design-matrix order (treatment contrasts, first level dropped)
NUMERIC_FEATURES = ("log_price", "log_freight_value", "items_count")
SPLIT_SEED = 42
TRAIN_FRACTION = 0.8
CV_FOLDS = 5
