"""Business rules as column expressions: late flags, delay buckets, review label, RFM segment, risk flag."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderlens.functions.dates import as_date, col
from orderlens.schema import DELAY_BUCKETS, DELAY_CAP_DAYS, LOW_REVIEW_MAX_SCORE


def late_flag_nullable(delivered: Column | str, due_date: Column | str) -> Column:
    """Three-valued: NULL if not delivered or no due date, else delivered date strictly after due date."""
    d, e = col(delivered), col(due_date)
    return F.when(d.isNull() | e.isNull(), F.lit(None).cast("boolean")).otherwise(as_date(d) > e)


def late_flag(delivered: Column | str, due_date: Column | str) -> Column:
    """Two-valued: FALSE when not delivered or no due date."""
    d, e = col(delivered), col(due_date)
    return d.isNotNull() & e.isNotNull() & F.coalesce(as_date(d) > e, F.lit(False))


def ontime_flag(is_delivered: Column | str, is_late: Column | str) -> Column:
    """NOT is_late for delivered orders, NULL otherwise."""
    return F.when(col(is_delivered).eqNullSafe(True), ~col(is_late))


def clamp_days(days: Column | str, cap: int | None = None) -> Column:
    """max(days, 0), optionally min(…, cap); NULL stays NULL."""
    d = col(days)
    out = F.greatest(d, F.lit(0))
    if cap is not None:
        out = F.least(out, F.lit(cap))
    return F.when(d.isNull(), F.lit(None).cast("int")).otherwise(out.cast("int"))


def delay_bucket(capped_days: Column | str, null_as_null: bool = True) -> Column:
    """Bucket label for a delay already clamped to [0, cap]; values past the last edge fall in the last bucket."""
    d = col(capped_days)
    expr = None
    for label, lo, hi in DELAY_BUCKETS[:-1]:
        cond = (d == lo) if lo == hi else d.between(lo, hi)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    expr = expr.otherwise(DELAY_BUCKETS[-1][0])
    if null_as_null:
        return F.when(d.isNull(), F.lit(None).cast("string")).otherwise(expr)
    return expr


def capped_delay(delay_days: Column | str) -> Column:
    return F.least(col(delay_days), F.lit(DELAY_CAP_DAYS)).cast("int")


def low_review(score: Column | str) -> Column:
    """score <= 2; NULL score gives NULL."""
    return col(score) <= LOW_REVIEW_MAX_SCORE


def as_label(flag: Column | str) -> Column:
    """TRUE -> 1, FALSE or NULL -> 0."""
    return F.when(col(flag).eqNullSafe(True), 1).otherwise(0)


def rfm_segment(r: Column | str, f: Column | str, m: Column | str, frequency: Column | str) -> Column:
    """First matching rule wins."""
    r, f, m, n = col(r), col(f), col(m), col(frequency)
    return (F.when((r >= 4) & (f >= 4) & (m >= 4), "champions")
            .when((r >= 4) & (f >= 3), "loyal_customers")
            .when((n == 1) & (r >= 4) & (m >= 4), "new_high_value")
            .when((n == 1) & (r >= 4), "new_customers")
            .when((r <= 2) & (f >= 4), "at_risk_loyal")
            .when((r <= 2) & (m >= 4), "big_spenders_at_risk")
            .when(r == 1, "lost")
            .otherwise("others"))


def risk_flag(score: Column | str, amber_cut: Column | float, red_cut: Column | float) -> Column:
    """red if score >= red cut, amber if >= amber cut, else green (NULL score -> green)."""
    s = col(score)
    red = red_cut if isinstance(red_cut, Column) else F.lit(red_cut)
    amber = amber_cut if isinstance(amber_cut, Column) else F.lit(amber_cut)
    return F.when(s >= red, "red").when(s >= amber, "amber").otherwise("green")


def safe_ratio(num: Column | str, den: Column | str) -> Column:
    """num / den as double, NULL when den is 0 or NULL."""
    n, d = col(num), col(den)
    return F.when(d == 0, F.lit(None).cast("double")).otherwise(n.cast("double") / d.cast("double"))


def round_half_up(value: Column | str, places: int = 6) -> Column:
    """Decimal half-up rounding of a double (via a 15-place decimal, so a value that is a tie in
    decimal rounds up whatever its binary error). Values of 1e20 or more, inf and NaN give NULL."""
    v = col(value)
    return F.round(F.when(F.abs(v) < 1e20, v).cast("decimal(38,15)"), places)


def round_ratio(num: Column | str, den: Column | str, places: int = 6) -> Column:
    """round(num / den, places) with exact decimal half-up rounding, as double; NULL when den is 0."""
    n, d = col(num), col(den)
    q = n.cast("decimal(20,0)") / F.nullif(d, F.lit(0)).cast("decimal(20,0)")
    return F.round(q, places).cast("double")
