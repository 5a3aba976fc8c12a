"""Data-quality jobs over every layer. Each returns a small DataFrame; ``gate`` fails a run on them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.operators.keyed import duplicate_keys


def fact_metrics() -> list[Column]:
    return [
        F.min("purchase_ts").alias("min_purchase_ts"),
        F.max("purchase_ts").alias("max_purchase_ts"),
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(F.col("purchase_ts").isNull()).alias("null_purchase_ts"),
        F.count_if(F.col("delivered_customer_ts").isNull()).alias("delivered_customer_ts_nulls"),
    ]


def fact_profile(fact: DataFrame) -> DataFrame:
    """Purchase time range, row count and NULL counts of the key timestamps."""
    return fact.agg(*fact_metrics())


def key_profile(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows vs distinct key per table: ``{name: (df, key)}`` -> (t, total_records, distinct_pk)."""
    parts = [df.agg(F.lit(name).alias("t"), F.count(F.lit(1)).alias("total_records"),
                    F.count_distinct(key).alias("distinct_pk"))
             for name, (df, key) in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def duplicate_key_counts(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Number of keys occurring more than once, per table (0 = unique)."""
    parts = [duplicate_keys(df, list(keys)).agg(F.lit(name).alias("t"),
                                                F.count(F.lit(1)).alias("duplicate_keys"))
             for name, (df, keys) in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def key_checks(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Rows, distinct keys and keys occurring more than once, per table: :func:`key_profile` and
    :func:`duplicate_key_counts` from one scan of the key columns and one shuffle of partial counts.
    A key with a NULL is no distinct key, but repeats like any other."""
    parts = []
    for name, (df, keys) in tables.items():
        known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
        per = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).select("_n", known.alias("_known"))
        parts.append(per.agg(F.lit(name).alias("t"), F.coalesce(F.sum("_n"), F.lit(0)).alias("total_records"),
                             F.count_if("_known").alias("distinct_pk"), F.count_if(F.col("_n") > 1).alias("duplicate_keys")))
    return reduce(DataFrame.unionByName, parts)


def null_metrics(columns: Sequence[str]) -> list[Column]:
    return [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns]


def nulls_of(name: str, row: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The rows of :func:`null_counts` from a one-row frame of :func:`null_metrics`."""
    stack = ", ".join(f"'{c}', `null_{c}`" for c in columns)
    return row.select(F.lit(name).alias("t"), F.expr(f"stack({len(columns)}, {stack}) AS (column_name, null_cnt)"))


def null_counts(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """NULL count of each declared NOT NULL column: (t, column_name, null_cnt)."""
    parts = []
    for name, (df, cols) in tables.items():
        row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
        stack = ", ".join(f"'{c}', `{c}`" for c in cols)
        parts.append(row.select(F.lit(name).alias("t"),
                                F.expr(f"stack({len(cols)}, {stack}) AS (column_name, null_cnt)")))
    return reduce(DataFrame.unionByName, parts)


def rfm_metrics() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("customer_id").isNull()).alias("null_customer_id"),
        F.count_if(F.col("recency_days") < 0).alias("negative_recency"),
        F.min("frequency").alias("min_freq"),
        F.max("frequency").alias("max_freq"),
        F.min("monetary_value").alias("min_m"),
        F.max("monetary_value").alias("max_m"),
    ]


def rfm_profile(rfm: DataFrame) -> DataFrame:
    """Row count, NULL ids, negative recency, frequency and monetary ranges."""
    return rfm.agg(*rfm_metrics())


def segment_distribution(rfm: DataFrame) -> DataFrame:
    return rfm.groupBy("rfm_segment").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "rfm_segment")


def top_customers(rfm: DataFrame, by: str, n: int = 10) -> DataFrame:
    """Spot check: the top ``n`` persons by ``by`` (ties by customer_id); a TakeOrderedAndProject."""
    return rfm.orderBy(F.col(by).desc_nulls_last(), F.col("customer_id").asc()).limit(n)


def late_percentiles(sla: DataFrame) -> DataFrame:
    """Exact p50/p90/p99 and max of days late among late orders. Whole days: the exact percentile's
    value->count map holds one entry per distinct day count."""
    late = sla.filter(F.col("is_late") & F.col("days_late").isNotNull())
    return late.agg(
        F.percentile("days_late", 0.5).alias("p50"),
        F.percentile("days_late", 0.9).alias("p90"),
        F.percentile("days_late", 0.99).alias("p99"),
        F.max("days_late").alias("max_days_late"),
    )


def very_late(sla: DataFrame) -> DataFrame:
    late = sla.filter(F.col("is_late") & F.col("days_late").isNotNull())
    return late.agg(
        F.count_if(F.col("days_late") > 90).alias("late_gt_90"),
        F.count_if(F.col("days_late") > 120).alias("late_gt_120"),
        F.count(F.lit(1)).alias("total_late"),
    )


def recent_delivered_days(sla: DataFrame, n: int = 10) -> DataFrame:
    """Late rate of the latest ``n`` delivered days."""
    d = sla.filter(F.col("is_delivered")).groupBy("delivered_date").agg(
        F.count(F.lit(1)).alias("delivered_cnt"),
        F.sum(F.col("is_late").cast("int")).alias("late_cnt"))
    return (d.select("*", (F.col("late_cnt") / F.nullif(F.col("delivered_cnt"), F.lit(0))).alias("late_rate"))
            .orderBy(F.col("delivered_date").desc()).limit(n))


#: NOT NULL columns of the score table, beside ``created_at``
SCORE_NOT_NULL = ("order_id", "score_date", "risk_score", "risk_flag", "threshold_green", "threshold_red", "model_version")


def score_checks(store: DataFrame) -> dict[str, DataFrame]:
    """Primary key and NOT NULL columns of the score table."""
    columns = [*SCORE_NOT_NULL, *(["created_at"] if "created_at" in store.columns else [])]
    return {"score_duplicate_keys": duplicate_key_counts({"sla_risk_scoring": (store, ["order_id", "score_date"])}),
            "score_not_null": null_counts({"sla_risk_scoring": (store, columns)})}


def gate(checks: Mapping[str, DataFrame]) -> None:
    """Fail when any check frame has a row with a non-zero ``duplicate_keys`` / ``null_cnt`` /
    ``negative_recency`` / ``null_customer_id`` value, or with other numbers of records and of keys. Each
    frame is small (one row per table or column)."""
    bad = []
    for name, df in checks.items():
        conds = [F.col(c) > 0 for c in ("duplicate_keys", "null_cnt", "negative_recency", "null_customer_id") if c in df.columns]
        if "distinct_pk" in df.columns:
            conds.append(F.col("total_records") != F.col("distinct_pk"))
        if conds:
            bad.extend(f"{name}: {r.asDict()}" for r in df.filter(reduce(lambda a, b: a | b, conds)).collect())
    if bad:
        raise ValueError("data-quality gate failed:\n" + "\n".join(bad))
