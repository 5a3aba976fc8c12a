"""The score store laid out by order: partitions by ``score_date``, and in each the same number of buckets by ``order_id``.

Bucket k of every day holds the same orders, so what goes by order (the latest score, an upsert, the join to the
orders) reads each bucket in a task of its own and exchanges no row of the store; only the other side is shuffled to the buckets.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.model.score import SCORE_KEY, with_defaults
from orderlens.operators.keyed import duplicate_keys
from orderlens.plans.report import LATEST_COLUMNS
from orderlens.schema import SCORE_SCHEMA
from orderlens.session import delete_path, scratch_path
from orderlens.sources.tables import path_exists


class BucketedScoreStore:
    """Parquet below ``path``; one row per (order_id, score_date).

    The number of buckets is fixed when the store is made (``buckets``, default: the session's shuffle partitions) and
    kept in a file beside the days, so any session can read the layout: it declares an external table over the folder in its
    catalog. For 100 TB of scores some thousand buckets are in order; a bucket of a day is a file.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        self.spark = spark
        self.path = path.rstrip("/")
        self.buckets = self._kept() or buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.table = "score_store_" + hashlib.sha256(self.path.encode()).hexdigest()[:16]
        self._declare()

    def _kept(self) -> int | None:
        place = f"{self.path}/_buckets"
        if not path_exists(self.spark, place):
            return None
        p = self.spark._jvm.org.apache.hadoop.fs.Path(place)  # Spark's readers pass over names with an underscore
        stream = p.getFileSystem(self.spark._jsc.hadoopConfiguration()).open(p)
        text = bytes(stream.readAllBytes()).decode()
        stream.close()
        return int(text)

    def _declare(self) -> None:
        if self._kept() is None:
            place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/_buckets")
            out = place.getFileSystem(self.spark._jsc.hadoopConfiguration()).create(place)
            out.write(bytearray(str(self.buckets).encode()))
            out.close()
        if self.spark.catalog.tableExists(self.table):
            return
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in SCORE_SCHEMA.fields)
        self.spark.sql(f"CREATE TABLE {self.table} ({columns}) USING parquet PARTITIONED BY (score_date) "
                       f"CLUSTERED BY (order_id) INTO {self.buckets} BUCKETS LOCATION '{self.path}'")
        self.spark.sql(f"MSCK REPAIR TABLE {self.table}")  # the days that are there

    def read(self) -> DataFrame:
        return self.spark.table(self.table).select(*SCORE_SCHEMA.fieldNames())

    def latest(self, columns=LATEST_COLUMNS) -> DataFrame:
        """The row of the greatest ``score_date`` per order, out of one scan: every bucket is sorted and
        aggregated where it is read."""
        best = self.read().groupBy("order_id").agg(F.max_by(F.struct(*columns), "score_date").alias("_row"))
        return best.select("order_id", *[F.col(f"_row.{c}").alias(c) for c in columns])

    def scored(self, enriched: DataFrame) -> DataFrame:
        """The enriched orders with their latest scores (orders without one keep NULLs)."""
        return enriched.join(self.latest(), "order_id", "left")

    def upsert(self, batch: DataFrame) -> None:
        """Insert or replace the batch's rows; defaults and ``created_at`` as in :class:`~orderlens.model.score.ScoreStore`.

        The days of the batch are read bucket by bucket and merged with the batch, which alone is shuffled. The merge is staged
        (a table isn't overwritten by a plan that reads it), a file for each bucket, and goes from there to the buckets of its
        days. Spark puts the new files of these days in place when all tasks have ended; a job that fails leaves the store as it was.
        """
        batch = with_defaults(batch).drop("created_at")
        if duplicate_keys(batch, SCORE_KEY).limit(1).count():
            raise ValueError("score batch has more than one row for an (order_id, score_date)")
        days = [r[0] for r in batch.select("score_date").distinct().collect()]  # days in one batch
        if not days:
            return
        names = SCORE_SCHEMA.fieldNames()
        new = batch.select(*[F.col(c).alias(f"_{c}") for c in names if c != "created_at"],
                           F.current_timestamp().alias("_created_at"), F.lit(True).alias("_new"))
        old = self.read().filter(F.col("score_date").isin(days))
        # the days are compared by their difference: as a key they would have the buckets shuffled
        same = (F.col("order_id") == F.col("_order_id")) & (F.datediff("score_date", "_score_date") == 0)
        merged = old.join(new, same, "full").select(
            *[F.when(F.col("_new"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) for c in names])
        stage = scratch_path(self.spark, "bucketed-upsert")
        merged.write.parquet(stage)
        # insertInto takes the mode from its session only: one of its own, so that the caller's stays as it is
        own = self.spark.newSession()
        own.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        staged = own.read.schema(SCORE_SCHEMA).parquet(stage)
        staged.select(*self.spark.table(self.table).columns).write.insertInto(self.table, overwrite=True)
        self.spark.catalog.refreshTable(self.table)
        delete_path(self.spark, stage)
