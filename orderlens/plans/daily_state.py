"""Daily marts that are kept up by mergeable states instead of being rebuilt.

All figures of the two daily SLA marts (counts, averages, rates, exact percentiles of whole days) follow from how many orders a
day has of each kind: delivered or not, late or not, with so many days. That count per day and kind is the
state: states of disjoint sets of orders add up, and an order's old version is taken out by a negative count. A
correction therefore needs the corrected orders in their old and new version and the state of the days they touch, nothing else.

The state is Parquet partitioned by month (a day's state is a few rows; a file for each would be too small); the partitions of
the changed days are read, merged, staged and replaced, as in the score store. Kinds whose count has come to zero stay in a
replaced partition (and are left out when it is read), so a month that loses its last order is replaced as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.functions import rules as R
from orderlens.session import delete_path, scratch_path
from orderlens.sources.tables import path_exists

KIND = ("is_delivered", "is_late", "delivery_days", "days_late")
SCHEMA = "is_delivered boolean, is_late boolean, delivery_days int, days_late int, n long, day date, month string"


def kinds(sla: DataFrame, day: str) -> DataFrame:
    """The state of a set of orders: rows per ``day`` (NULL is a day, too) and kind. Partial sums before the shuffle."""
    return sla.groupBy(*KIND, F.col(day).alias("day")).agg(F.count(F.lit(1)).alias("n")).select(*KIND, "n", "day")


def merged(*states: DataFrame) -> DataFrame:
    """The sum of states."""
    out = states[0]
    for s in states[1:]:
        out = out.unionByName(s)
    return out.groupBy(*KIND, "day").agg(F.sum("n").alias("n")).select(*KIND, "n", "day")


def taken_out(state: DataFrame) -> DataFrame:
    return state.withColumn("n", -F.col("n"))


def _month(day: Column | str) -> Column:
    """The partition of a day; orders without one have a partition of their own."""
    return F.coalesce(F.date_format(day, "yyyy-MM"), F.lit("none"))


def _mean(value: str, where=None):
    """The mean of a whole-day column over the orders of the kinds, NULLs left out."""
    n = F.when(F.col(value).isNotNull() if where is None else where & F.col(value).isNotNull(), F.col("n"))
    return F.sum(n * F.col(value)).cast("double") / F.nullif(F.sum(n), F.lit(0)).cast("double")


def sla_daily(state: DataFrame) -> DataFrame:
    """The mart by purchase date, from the state by purchase date (columns as of ``marts.sla_daily``)."""
    delivered, late = F.sum(F.when(F.col("is_delivered"), F.col("n")).otherwise(0)), F.sum(F.when(F.col("is_late"), F.col("n")).otherwise(0))
    return state.groupBy(F.col("day").alias("purchase_date")).agg(
        F.sum("n").alias("orders_cnt"), delivered.alias("delivered_cnt"), late.alias("late_cnt"),
        (F.sum("n") - delivered).alias("backlog_cnt"), _mean("delivery_days", F.col("is_delivered")).alias("avg_delivery_days"),
        _mean("days_late", F.col("is_late")).alias("avg_days_late"), R.safe_ratio(late, delivered).alias("late_rate"))


def sla_delivered_daily(state: DataFrame) -> DataFrame:
    """The mart by delivered date, from the state by delivered date (columns as of ``marts.sla_delivered_daily``)."""
    late_days = F.when(F.col("is_late"), F.col("days_late"))
    a = state.filter(F.col("is_delivered")).groupBy(F.col("day").alias("delivered_date")).agg(
        F.sum("n").alias("delivered_cnt"), F.sum(F.when(F.col("is_late"), F.col("n")).otherwise(0)).alias("late_cnt"),
        _mean("delivery_days").alias("avg_delivery_days"), F.percentile("delivery_days", 0.9, F.col("n")).alias("p90_delivery_days"),
        _mean("days_late", F.col("is_late")).alias("avg_days_late"), F.percentile(late_days, 0.9, F.col("n")).alias("p90_days_late"))
    return a.select("delivered_date", "delivered_cnt", "late_cnt", R.safe_ratio("late_cnt", "delivered_cnt").alias("late_rate"),
                    "avg_delivery_days", "p90_delivery_days", "avg_days_late", "p90_days_late")


class DailyState:
    """The stored state of a mart whose days are the values of ``day`` (a column of the SLA orders). One writer at a time."""

    def __init__(self, spark: SparkSession, path: str, day: str):
        self.spark, self.path, self.day = spark, path.rstrip("/"), day

    def _stored(self) -> DataFrame:
        return self.spark.read.schema(SCHEMA).parquet(self.path)

    def _write(self, state: DataFrame, mode: str) -> None:
        # one file a month: the rows are kinds and days, not orders
        (state.withColumn("month", _month("day")).repartition("month").write.mode("overwrite")
         .option("partitionOverwriteMode", mode).partitionBy("month").parquet(self.path))

    def read(self) -> DataFrame:
        """The state; empty before the first write."""
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], SCHEMA).drop("month")
        return self._stored().filter(F.col("n") != 0).drop("month")

    def rebuild(self, sla: DataFrame) -> None:
        """The state of all of ``sla``, in place of any before."""
        self._write(kinds(sla, self.day), "static")

    def touched(self, days: list) -> DataFrame:
        """The stored state of the months of some days: only their partitions are read."""
        months = {"none" if d is None else f"{d:%Y-%m}" for d in days}
        return self._stored().filter(F.col("month").isin(sorted(months))).drop("month")

    def correct(self, old: DataFrame, new: DataFrame) -> list:
        """Replace the orders ``old`` (as they are in the state) by ``new``; returns the changed days. Orders that are only in
        ``new`` are added, those only in ``old`` removed. Raises, and changes nothing, if ``old`` was not in the state."""
        delta = merged(kinds(new, self.day), taken_out(kinds(old, self.day))).filter(F.col("n") != 0)
        stage = scratch_path(self.spark, "daily-delta")
        delta.write.parquet(stage)
        delta = self.spark.read.parquet(stage)
        days = [r[0] for r in delta.select("day").distinct().collect()]  # the days of one correction
        if days:
            result = scratch_path(self.spark, "daily-state")
            merged(self.touched(days), delta).write.parquet(result)
            after = self.spark.read.parquet(result)
            if after.filter(F.col("n") < 0).limit(1).count():
                raise ValueError("a correction takes out orders that the state does not hold")
            self._write(after, "dynamic")
            delete_path(self.spark, result)
        delete_path(self.spark, stage)
        return days
