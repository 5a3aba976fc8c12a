"""Daily batch scoring: probabilities from the saved model, batch-percentile risk flags, run summary,
and the score store with idempotent upserts by (order_id, score_date)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.functions.rules import risk_flag, round_half_up
from orderlens.model.features import FEATURE_TERMS, align_columns, design_matrix, term_column
from orderlens.model.ridge import RidgeModel
from orderlens.operators.keyed import duplicate_keys, upsert_merge
from orderlens.operators.rank import exact_quantiles
from orderlens.schema import (AMBER_PERCENTILE, DEFAULT_THRESHOLD_GREEN, DEFAULT_THRESHOLD_RED, MODEL_VERSION,
                              RED_PERCENTILE, SCORE_SCHEMA)
from orderlens.session import delete_path, scratch_path
from orderlens.sources.tables import plain_columns

SCORE_KEY = ("order_id", "score_date")
DEC6 = "decimal(10,6)"


def predict(model: RidgeModel, cohort: DataFrame, id_col: str = "order_id") -> DataFrame:
    """``order_id, risk_score``: probability of a low review from the model's chosen lambda.
    The design matrix is aligned to the model's own term list first."""
    design = align_columns(design_matrix(cohort, FEATURE_TERMS, keep=(id_col,)), model.terms, keep=(id_col,))
    out = model.model.transform(design)
    return out.select(id_col, vector_to_array("probability")[1].alias("risk_score"))


def predict_linear(intercept: float, betas: dict[str, float], cohort: DataFrame, id_col: str = "order_id") -> DataFrame:
    """``order_id, risk_score`` from a plain table of coefficients (term -> beta), as column expressions;
    terms that the model lacks count as zero."""
    design = align_columns(design_matrix(cohort, FEATURE_TERMS, keep=(id_col,)), FEATURE_TERMS, keep=(id_col,))
    margin = F.lit(float(intercept))
    for term in FEATURE_TERMS:
        margin = margin + F.lit(float(betas.get(term, 0.0))) * F.col(term_column(term))
    return design.select(id_col, (1 / (1 + F.exp(-margin))).alias("risk_score"))


def flag_cuts(scored: DataFrame, score_col: str = "risk_score", stage_input: bool = True) -> DataFrame:
    """One row: ``amber_cut`` (P90) and ``red_cut`` (P95) of the batch, exact, type-7 interpolation."""
    return exact_quantiles(scored, score_col, [AMBER_PERCENTILE, RED_PERCENTILE],
                           names=["amber_cut", "red_cut"], stage_input=stage_input)


def assemble_scores(scored: DataFrame, score_date: dt.date | str, model_version: str = MODEL_VERSION,
                    mode: str = "percentile", score_col: str = "risk_score", id_col: str = "order_id",
                    approx_accuracy: int = 100_000, cuts: tuple[float, float] | None = None) -> DataFrame:
    """Score-store rows for one batch.

    ``mode='percentile'``: red at or above the batch P95, amber at or above P90, green otherwise (the
    flag uses the unrounded score); the percentiles are exact (see ``order_statistics``).
    ``mode='approx_percentile'``: the same rule with ``percentile_approx`` (one pass, bounded memory,
    rank error at most n / ``approx_accuracy``). ``mode='fixed'``: the stored default cut-offs 0.20 /
    0.35. The cut-offs actually used are stored in ``threshold_green`` (upper end of green) and
    ``threshold_red``.
    """
    if cuts is not None:  # (amber, red), computed before for the same batch
        amber, red = F.lit(cuts[0]).cast("double"), F.lit(cuts[1]).cast("double")
    elif mode == "approx_percentile":
        q = F.percentile_approx(F.col(score_col), [AMBER_PERCENTILE, RED_PERCENTILE], approx_accuracy)
        both = scored.agg(q.alias("_q"))
        amber = both.select(F.col("_q")[0]).scalar()
        red = both.select(F.col("_q")[1]).scalar()
    elif mode == "percentile":
        # the batch feeds both the percentile job and the rows written: store (id, score) once
        scored = scored.select(id_col, score_col).checkpoint(eager=True)
        amber, red = (F.lit(x).cast("double") for x in flag_cuts(scored, score_col, stage_input=False).first())
    elif mode == "fixed":
        amber, red = F.lit(float(DEFAULT_THRESHOLD_GREEN)), F.lit(float(DEFAULT_THRESHOLD_RED))
    else:
        raise ValueError(f"unknown flag mode {mode!r}")
    day = F.lit(score_date if isinstance(score_date, dt.date) else dt.date.fromisoformat(str(score_date)))
    return scored.select(
        F.col(id_col).alias("order_id"),
        day.alias("score_date"),
        round_half_up(score_col, 6).cast(DEC6).alias("risk_score"),
        risk_flag(score_col, amber, red).alias("risk_flag"),
        round_half_up(amber, 6).cast(DEC6).alias("threshold_green"),
        round_half_up(red, 6).cast(DEC6).alias("threshold_red"),
        F.lit(model_version).alias("model_version"),
    )


def run_summary(batch: DataFrame) -> DataFrame:
    """Rows scored, score date and the cut-offs (P90, P95) of a batch."""
    return batch.groupBy("score_date").agg(
        F.count(F.lit(1)).alias("scored_rows"),
        F.max("threshold_green").alias("p90"),
        F.max("threshold_red").alias("p95"),
    )


class ScoreStore:
    """Parquet table partitioned by ``score_date``; one row per (order_id, score_date).

    ``upsert`` rewrites only the score dates present in the batch (dynamic partition overwrite): the
    affected partitions' existing rows minus the batch keys, plus the batch with a fresh
    ``created_at``. The merge is staged to the checkpoint folder first, so the table is never read
    and overwritten by the same lazy plan, and a failed job leaves the table as it was. A batch of dates that the
    table has no row of is merged with nothing: it is written at once.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def exists(self) -> bool:
        jvm = self.spark._jvm
        conf = self.spark._jsc.hadoopConfiguration()
        p = jvm.org.apache.hadoop.fs.Path(self.path)
        return p.getFileSystem(conf).exists(p)

    def read(self) -> DataFrame:
        if not self.exists():
            return self.spark.createDataFrame([], SCORE_SCHEMA)
        df = self.spark.read.schema(SCORE_SCHEMA).parquet(self.path)
        return df.select(*SCORE_SCHEMA.fieldNames())

    def upsert(self, batch: DataFrame) -> None:
        """Insert or replace the batch's rows; columns that it lacks, or has NULL, take their defaults, and
        ``created_at`` is the time of this write."""
        batch = with_defaults(batch).drop("created_at")
        if duplicate_keys(batch, SCORE_KEY).limit(1).count():
            raise ValueError("score batch has more than one row for an (order_id, score_date)")
        dates = [r[0] for r in batch.select("score_date").distinct().collect()]  # days in one batch
        incoming = batch.withColumn("created_at", F.current_timestamp())
        incoming = incoming.select(*SCORE_SCHEMA.fieldNames())
        existing = self.read().filter(F.col("score_date").isin(dates))
        if not existing.limit(1).count():
            self._replace(incoming)
            return
        merged = upsert_merge(existing, incoming, list(SCORE_KEY))
        stage = scratch_path(self.spark, "score-upsert")
        merged.write.mode("overwrite").parquet(stage)
        self._replace(self.spark.read.schema(SCORE_SCHEMA).parquet(stage))
        delete_path(self.spark, stage)  # the overwrite has committed; the staged copy is spent

    def _replace(self, rows: DataFrame) -> None:
        # no repartition by date: a daily batch is one date, and one task must not write it all
        (rows.write.mode("overwrite").options(**plain_columns(rows.schema))
         .option("partitionOverwriteMode", "dynamic").partitionBy("score_date").parquet(self.path))


def with_defaults(df: DataFrame) -> DataFrame:
    """Fill the store's column defaults for rows that lack them (thresholds, version, created_at)."""
    fill = {
        "threshold_green": F.lit(Decimal(DEFAULT_THRESHOLD_GREEN)).cast(DEC6),
        "threshold_red": F.lit(Decimal(DEFAULT_THRESHOLD_RED)).cast(DEC6),
        "model_version": F.lit(MODEL_VERSION),
        "created_at": F.current_timestamp(),
    }
    out = df
    for c, v in fill.items():
        out = out.withColumn(c, F.coalesce(F.col(c), v) if c in df.columns else v)
    return out.select(*SCORE_SCHEMA.fieldNames())
