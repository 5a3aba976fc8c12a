"""BI products over the score store: latest score per order, the scored order view, the weekly
business review, the follow-up list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.functions.rules import round_ratio
from orderlens.operators.keyed import latest_per_key

LATEST_COLUMNS = ("score_date", "risk_score", "risk_flag", "model_version")
FOLLOW_UP_BUCKETS = ("4-7", "8-14")


def latest_scores(store: DataFrame) -> DataFrame:
    """Latest score per order (greatest score_date)."""
    return latest_per_key(store, "order_id", "score_date", LATEST_COLUMNS)


def sla_order_scored(enriched: DataFrame, store: DataFrame) -> DataFrame:
    """Enriched order view with the latest score (left join: unscored orders keep NULLs).

    The latest-score side is an aggregate grouped by order_id, so a query that reads no score
    column lets Catalyst drop the join altogether."""
    return enriched.join(latest_scores(store), "order_id", "left")


def wbr_weekly(scored: DataFrame) -> DataFrame:
    """Per delivered week (Monday start): delivered, late, rates, and risk-flag shares among scored."""
    d = F.col("is_delivered")
    late = d & F.col("is_late")
    flag = F.col("risk_flag")
    delivered_cnt = F.count_if(d)
    late_cnt = F.count_if(late)
    ontime_cnt = F.count_if(d & ~F.col("is_late"))
    scored_cnt = F.count_if(flag.isNotNull())
    high_cnt = F.count_if(flag.isin("amber", "red"))
    agg = scored.filter(F.col("delivered_week_start").isNotNull()).groupBy(
        F.col("delivered_week_start").alias("week_start")).agg(
        delivered_cnt.alias("delivered_cnt"), late_cnt.alias("late_cnt"), ontime_cnt.alias("_ontime"),
        scored_cnt.alias("scored_cnt"), F.count_if(flag == "amber").alias("amber_cnt"),
        F.count_if(flag == "red").alias("red_cnt"), high_cnt.alias("_high"))
    return agg.select(
        "week_start", "delivered_cnt", "late_cnt",
        round_ratio("late_cnt", "delivered_cnt").alias("late_rate"),
        round_ratio("_ontime", "delivered_cnt").alias("ontime_rate"),
        "scored_cnt", "amber_cnt", "red_cnt",
        round_ratio("_high", "scored_cnt").alias("high_risk_share"),
    )


def follow_up_list(scored: DataFrame) -> DataFrame:
    """Red orders whose delay falls in the 4-7 or 8-14 day buckets: the daily outreach list."""
    return scored.filter((F.col("risk_flag") == "red") & F.col("delay_bucket").isin(*FOLLOW_UP_BUCKETS)).select(
        "order_id", "customer_id", "delivered_date", "days_late", "delay_bucket", "score_date",
        "risk_score", "risk_flag", "review_score")


def delay_summary(cohort: DataFrame, col: str = "delay_cap") -> DataFrame:
    """Five-number summary and mean of a whole-day column (exact percentiles of few distinct values)."""
    c = F.col(col)
    return cohort.agg(
        F.min(c).cast("double").alias("min"),
        F.percentile(c, 0.25).alias("q1"),
        F.percentile(c, 0.5).alias("median"),
        F.avg(c).alias("mean"),
        F.percentile(c, 0.75).alias("q3"),
        F.max(c).cast("double").alias("max"),
    )
