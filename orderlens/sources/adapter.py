"""Maps the driver's TPC-H-like test tables onto the nine raw order tables.

The mapping uses only arithmetic on the order key, so every engine derives the same rows. It is a
fixture for tests and benches; production input comes through :mod:`orderlens.sources.csv` or
:func:`orderlens.sources.tables.read_raw`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderlens.schema import MONEY, RAW_SCHEMAS

# fixed values of the fixture mapping
PAYMENT_TYPES = ("boleto", "credit_card", "voucher", "debit_card")  # by (k + seq) % 4


def _tpch(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _by_order(df: DataFrame, key: str) -> DataFrame:
    """Adds ``order_id``, the key as text. Rows stay where they are: per-order aggregations reduce them
    before the one shuffle, and AQE can split a join on a hot order."""
    return df.withColumn("order_id", F.col(key).cast("string"))


def _add(ts: Column, unit: str, n: Column) -> Column:
    return F.timestamp_add(unit, n, ts)


def _days_off(k: Column) -> Column:
    """Delivery offset in days relative to the promised date."""
    m = (k * 31) % 100
    return (F.when(m < 80, -(k % 15))
            .when(m < 86, 1 + k % 3)
            .when(m < 91, 4 + k % 4)
            .when(m < 96, 8 + k % 7)
            .otherwise(15 + k % 40))


def _zip(nationkey: Column) -> Column:
    return F.lpad(nationkey.cast("string"), 5, "0")


def _conform(df: DataFrame, table: str) -> DataFrame:
    """Project to the declared raw schema; columns the mapping does not fill are typed NULLs."""
    cols = []
    for f in RAW_SCHEMAS[table].fields:
        c = df[f.name] if f.name in df.columns else F.lit(None)
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)


def _orders_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _tpch(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                              "o_totalprice", "o_orderdate")
    return _by_order(o, "o_orderkey")


def _order_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _orders_keyed(spark, sf_dir)
    k = F.col("o_orderkey")
    p = _add(F.col("o_orderdate"), "SECOND", k * 37 % 86400)
    promised_days = 20 + k % 10
    is_open = F.col("o_orderstatus") == "O"
    return o.select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "order_id",
        F.concat(F.lit("c"), k.cast("string")).alias("customer_id"),
        F.when(is_open, "shipped").otherwise("delivered").alias("order_status"),
        p.alias("order_purchase_timestamp"),
        F.when(k % 50 == 0, None).otherwise(
            _add(_add(p, "DAY", k % 3), "HOUR", k % 7)).alias("order_approved_at"),
        F.when(is_open & (k % 2 == 0), None).otherwise(
            _add(p, "DAY", 1 + k % 6)).alias("order_delivered_carrier_date"),
        F.when(is_open, None).otherwise(
            _add(p, "DAY", promised_days + _days_off(k))).alias("order_delivered_customer_date"),
        _add(p, "DAY", promised_days).alias("order_estimated_delivery_date"),
    )


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _conform(_order_base(spark, sf_dir), "orders")


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _tpch(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = _tpch(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = _tpch(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = _tpch(spark, sf_dir, "region").select("r_regionkey", "r_name")
    k = F.col("o_orderkey")
    df = (o.join(c, o.o_custkey == c.c_custkey)
          .join(n, F.col("c_nationkey") == n.n_nationkey)
          .join(r, F.col("n_regionkey") == r.r_regionkey))
    return _conform(df.select(
        F.concat(F.lit("c"), k.cast("string")).alias("customer_id"),
        F.when(k % 3 == 0, F.concat(F.lit("u"), F.col("o_custkey").cast("string")))
         .otherwise(F.concat(F.lit("o"), k.cast("string"))).alias("customer_unique_id"),
        _zip(F.col("c_nationkey")).alias("customer_zip_code_prefix"),
        F.col("n_name").alias("customer_city"),
        F.col("r_name").alias("customer_state"),
    ), "customers")


LINE_ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate",
              "l_discount", "l_tax", "l_returnflag", "l_linestatus")


def raw_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _by_order(_tpch(spark, sf_dir, "lineitem"), "l_orderkey")
    # l_linenumber alone is not unique per order: number the lines by their full content. Only readers of
    # order_item_id pay for it; for all others Catalyst drops the window
    numbered = li.select("*", F.row_number().over(Window.partitionBy("order_id").orderBy(*LINE_ORDER))
                         .alias("order_item_id"))
    return _conform(numbered.select(
        "order_id", "order_item_id",
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_suppkey").cast("string").alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        F.col("l_extendedprice").cast(MONEY).alias("price"),
        F.col("l_quantity").cast(MONEY).alias("freight_value"),
    ), "order_items")


def raw_order_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _orders_keyed(spark, sf_dir)
    k = F.col("o_orderkey")
    seq = F.col("seq")
    pick = (k + seq) % 4
    ptype = F.element_at(F.array(*[F.lit(t) for t in PAYMENT_TYPES]), (pick + 1).cast("int"))
    df = (o.withColumn("seq", F.explode(F.array(F.lit(1), F.lit(2))))
          .filter((k % 97 != 0) & ((seq == 1) | (k % 5 == 0))))
    return _conform(df.select(
        "order_id",
        seq.alias("payment_sequential"),
        ptype.alias("payment_type"),
        (1 + k % 12).alias("payment_installments"),
        F.col("o_totalprice").cast(MONEY).alias("payment_value"),
    ), "order_payments")


def raw_order_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _order_base(spark, sf_dir)
    k = F.col("o_orderkey")
    seq = F.col("seq")
    dl = F.coalesce(F.datediff(F.to_date("order_delivered_customer_date"),
                               F.to_date("order_estimated_delivery_date")), F.lit(0))
    d = F.when(dl >= 8, 3).when(dl >= 4, 2).when(dl >= 1, 1).otherwise(0)
    m = k * 17 % 97
    n = F.when(m < 12, 3).when(m < 40, 1).otherwise(0)
    raw = 5 - d - n + (seq - 1)
    score = F.when(k % 101 == 0, None).otherwise(F.least(F.greatest(raw, F.lit(1)), F.lit(5)))
    df = (o.withColumn("seq", F.explode(F.array(F.lit(1), F.lit(2))))
          .filter((k % 11 != 0) & ((seq == 1) | (k % 13 == 0))))
    return _conform(df.select(
        F.concat(F.lit("r"), k.cast("string"), F.lit("-"), seq.cast("string")).alias("review_id"),
        "order_id",
        score.alias("review_score"),
    ), "order_reviews")


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _tpch(spark, sf_dir, "part")
    size = F.col("p_size")
    return _conform(p.select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.lower("p_type").alias("product_category_name"),
        (size * 100).alias("product_weight_g"),
        (size + 10).alias("product_length_cm"),
        (size + 5).alias("product_height_cm"),
        (size + 7).alias("product_width_cm"),
    ), "products")


def raw_category_translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    cat = F.lower("p_type")
    p = _tpch(spark, sf_dir, "part").select(cat.alias("product_category_name")).distinct()
    return _conform(p.filter(F.col("product_category_name") != "promo").select(
        "product_category_name",
        F.concat(F.lit("cat_"), F.col("product_category_name")).alias("product_category_name_english"),
    ), "category_translation")


def raw_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _tpch(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    n = _tpch(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = _tpch(spark, sf_dir, "region").select("r_regionkey", "r_name")
    df = s.join(n, s.s_nationkey == n.n_nationkey).join(r, F.col("n_regionkey") == r.r_regionkey)
    return _conform(df.select(
        F.col("s_suppkey").cast("string").alias("seller_id"),
        _zip(F.col("s_nationkey")).alias("seller_zip_code_prefix"),
        F.col("n_name").alias("seller_city"),
        F.col("r_name").alias("seller_state"),
    ), "sellers")


def raw_geolocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = _tpch(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = _tpch(spark, sf_dir, "region").select("r_regionkey", "r_name")
    df = n.join(r, n.n_regionkey == r.r_regionkey)
    return _conform(df.select(
        _zip(F.col("n_nationkey")).alias("geolocation_zip_code_prefix"),
        F.lit(0.0).alias("geolocation_lat"),
        F.lit(0.0).alias("geolocation_lng"),
        F.col("n_name").alias("geolocation_city"),
        F.col("r_name").alias("geolocation_state"),
    ), "geolocation")


BUILDERS = {
    "customers": raw_customers,
    "geolocation": raw_geolocation,
    "orders": raw_orders,
    "order_items": raw_order_items,
    "order_payments": raw_order_payments,
    "order_reviews": raw_order_reviews,
    "products": raw_products,
    "sellers": raw_sellers,
    "category_translation": raw_category_translation,
}


class RawTables:
    """Lazy access to the nine raw tables; each is built on first use and kept as a plan."""

    def __init__(self, spark: SparkSession, loader):
        self.spark = spark
        self._loader = loader
        self._cache: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = self._loader(name)
        return self._cache[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in BUILDERS:
            raise AttributeError(name)
        return self[name]


def from_testdata(spark: SparkSession, sf_dir: str) -> RawTables:
    """Raw tables mapped from the driver's test tables at ``sf_dir``."""
    return RawTables(spark, lambda name: BUILDERS[name](spark, sf_dir))
