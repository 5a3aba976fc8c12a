"""The whole run, in order: warehouse, marts, quality gate, model, daily scores, weekly report.

Materialised layers (fact, marts, weekly report) are written as Parquet and read back, so each stage
starts from stored tables (lineage is cut at every layer, as the warehouse's tables do). They go into a folder of the run's
own; a manifest that is written last switches readers to all of them at once (:class:`orderlens.sources.tables.Versions`). The
views (enriched orders, model cohort, scored orders) stay lazy plans over the published marts.
"""

from __future__ import annotations

import datetime as dt
import logging
import os
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.model import features, ridge
from orderlens.model.score import ScoreStore, assemble_scores, predict, run_summary
from orderlens.operators.keyed import insert_if_absent_rows
from orderlens.plans import marts, quality, report, rfm, warehouse
from orderlens.schema import DW_KEYS
from orderlens.session import checkpoint_dir, delete_path
from orderlens.sources.adapter import RawTables
from orderlens.sources.tables import Layer, Versions

log = logging.getLogger("orderlens")


@dataclass
class RunResult:
    tables: dict[str, str] = field(default_factory=dict)
    checks: dict[str, DataFrame] = field(default_factory=dict)
    summary: dict = field(default_factory=dict)


def build_warehouse(raw: RawTables, dw: Layer, result: RunResult) -> None:
    """Dimensions: insert-if-absent against the stored dimension (kept rows never change)."""
    builders = {
        "dim_customer": lambda: warehouse.dim_customer(raw.customers),
        "dim_sellers": lambda: warehouse.dim_sellers(raw.sellers),
        "dim_products": lambda: warehouse.dim_products(raw.products, raw.category_translation),
        "dim_date": lambda: warehouse.dim_date(raw.orders),
    }
    for name, build in builders.items():
        fresh = build()
        if dw.exists(name):
            rows = insert_if_absent_rows(dw.read(name), fresh, list(DW_KEYS[name]))
            dw.append(name, rows)
        else:
            dw.overwrite(name, fresh)
        result.tables[name] = dw.path(name)


FACT_KEY = ("order_id", "order_item_id")


def build_marts(raw: RawTables, mart: Layer) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """The item fact and the marts, written to ``mart`` (the run's own folder: the gate comes before publishing),
    and what was observed of the fact and of the customers while they were written."""
    out, seen = {}, {}
    out["fact_order_items"], seen["fact_order_items"] = mart.overwrite_observed(
        "fact_order_items", warehouse.fact_order_items(raw.order_items, raw.orders), observed_of_fact())
    fact = out["fact_order_items"]
    out["order_facts"] = mart.overwrite("order_facts", marts.order_facts(raw.orders, raw.order_items, raw.order_payments))
    out["customer_rfm"], seen["customer_rfm"] = mart.overwrite_observed(
        "customer_rfm", rfm.customer_rfm(out["order_facts"], raw.customers), quality.rfm_metrics())
    out["sla_orders"] = mart.overwrite("sla_orders", marts.sla_orders(out["order_facts"]))
    out["sla_daily"] = mart.overwrite("sla_daily", marts.sla_daily(out["sla_orders"]))
    out["sla_delivered_daily"] = mart.overwrite("sla_delivered_daily", marts.sla_delivered_daily(out["sla_orders"]))
    out["item_facts"] = mart.overwrite("item_facts", marts.item_facts(fact))
    out["delivery_review"] = mart.overwrite("delivery_review", marts.delivery_review(fact, raw.order_reviews))
    return out, seen


def observed_of_fact() -> list:
    """The fact's profile and its NULL keys (``null_purchase_ts`` is in the profile)."""
    return [*quality.fact_metrics(), *quality.null_metrics(FACT_KEY)]


def quality_checks(dw: Layer, m: dict[str, DataFrame], seen: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Ranges and NULLs were observed while the tables were written; for the gate each stored table is read once at
    most, its key columns alone. The rest are reports."""
    fact = seen["fact_order_items"]
    nulls = [f"null_{c}" for c in FACT_KEY]
    return {
        "fact_profile": fact.drop(*nulls),
        "dim_keys": quality.key_checks({n: (dw.read(n), list(DW_KEYS[n])) for n in
                                        ("dim_customer", "dim_sellers", "dim_products", "dim_date")}),
        "duplicate_keys": quality.key_checks({
            "fact_order_items": (m["fact_order_items"], list(FACT_KEY)),
            "order_facts": (m["order_facts"], ["order_id"]),
            "item_facts": (m["item_facts"], list(FACT_KEY)),
            "delivery_review": (m["delivery_review"], ["order_id"]),
        }).select("t", "duplicate_keys"),
        "not_null": quality.nulls_of("fact_order_items", fact, FACT_KEY),
        "rfm_profile": seen["customer_rfm"],
        "segments": quality.segment_distribution(m["customer_rfm"]),
        "late_percentiles": quality.late_percentiles(m["sla_orders"]),
        "very_late": quality.very_late(m["sla_orders"]),
        "recent_days": quality.recent_delivered_days(m["sla_orders"]),
    }


def run(spark: SparkSession, raw: RawTables, out_dir: str, score_date: dt.date | str | None = None,
        model_path: str | None = None, retrain: bool = False, gate: bool = True,
        flag_mode: str = "percentile") -> RunResult:
    """Run every stage. ``score_date`` defaults to today; the model is trained when ``retrain`` or
    when no model is stored at ``model_path`` (default ``<out_dir>/model``)."""
    result = RunResult()
    dw, mart = Layer(spark, os.path.join(out_dir, "dw")), Layer(spark, os.path.join(out_dir, "mart"))
    build_warehouse(raw, dw, result)
    versions = Versions(spark, out_dir)
    own = Layer(spark, versions.new())
    m, seen = build_marts(raw, own)
    # every check is evaluated and stored; bad data stops here, with the published tables as they were
    qa = Layer(spark, os.path.join(out_dir, "qa"))
    result.checks = {name: qa.overwrite(name, df) for name, df in quality_checks(dw, m, seen).items()}
    if gate:
        try:
            quality.gate(result.checks)
        except Exception:
            delete_path(spark, own.root)
            raise
    result.tables.update({name: own.path(name) for name in m})

    enriched = marts.sla_order_enriched(m["sla_orders"], m["delivery_review"])
    checkpoint_dir(spark)
    cohort = marts.model_cohort(enriched).checkpoint(eager=True)  # read by the level check, the split and the scores
    model_path = model_path or os.path.join(out_dir, "model")
    features.check_levels(cohort)  # an unknown month or bucket is a data error, not an all-zero row
    if retrain or not Layer(spark, model_path).exists("orderlens_meta"):
        split = features.train_test_split(cohort)
        train = split.filter(F.col("split") == "train")
        model, _ = ridge.train_ridge(features.design_matrix(train, keep=("order_id", "is_low_review")))
        model.save(model_path)
        result.summary["lambda_1se"] = model.lambda_1se
        result.summary["lambda_min"] = model.lambda_min
    model = ridge.RidgeModel.load(spark, model_path)

    day = score_date or dt.date.today()
    batch = assemble_scores(predict(model, cohort), day, model.version, mode=flag_mode)
    store = ScoreStore(spark, mart.path("sla_risk_scoring"))
    store.upsert(batch)
    stored = quality.score_checks(store.read())
    result.checks.update({name: qa.overwrite(name, df) for name, df in stored.items()})
    if gate:
        quality.gate({name: result.checks[name] for name in stored})
    result.tables["sla_risk_scoring"] = store.path
    s = run_summary(store.read().filter(F.col("score_date") == F.lit(day))).first()
    if s is not None:
        result.summary.update({"scored_rows": s["scored_rows"], "score_date": str(s["score_date"]),
                               "p90": float(s["p90"]), "p95": float(s["p95"])})
        log.info("scored rows: %s | score_date: %s | P90: %s | P95: %s", s["scored_rows"], s["score_date"],
                 s["p90"], s["p95"])

    # the weekly report reads no review column: its view leaves the review mart out
    scored = report.sla_order_scored(marts.sla_order_enriched(m["sla_orders"], None), store.read())
    own.overwrite("sla_wbr_weekly", report.wbr_weekly(scored))
    result.tables["sla_wbr_weekly"] = own.path("sla_wbr_weekly")
    versions.publish(result.tables)
    return result


def views(spark: SparkSession, out_dir: str) -> dict[str, DataFrame]:
    """The lazy views over the published run: enriched orders, model cohort, scored orders, follow-up list.
    Also registered as temp views under the same names."""
    tables = Versions(spark, out_dir).current()
    enriched = marts.sla_order_enriched(spark.read.parquet(tables["sla_orders"]), spark.read.parquet(tables["delivery_review"]))
    store = ScoreStore(spark, tables["sla_risk_scoring"])
    scored = report.sla_order_scored(enriched, store.read())
    out = {
        "v_sla_order_enriched": enriched,
        "v_sla_model_cohort": marts.model_cohort(enriched),
        "v_sla_order_scored": scored,
        "follow_up_list": report.follow_up_list(scored),
        # stored order is not a promise: the weekly report is ordered when read
        "sla_wbr_weekly": spark.read.parquet(tables["sla_wbr_weekly"]).orderBy("week_start"),
    }
    for name, df in out.items():
        df.createOrReplaceTempView(name)
    return out
