"""Named products over the driver's test tables: one callable ``(spark, sf_dir) -> DataFrame`` each.

Every product reads the whole mapped tables. Double columns are rounded to 6 places in the
returned frame (the engines sum in different orders); the products themselves are not rounded.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.functions.rules import round_half_up
from orderlens.plans import marts, quality, rfm, warehouse
from orderlens.sources.adapter import RawTables, from_testdata

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Round every double column (top level) to ``places``, half-up in decimal (as the oracle does)."""
    def r(name):
        c = F.col(name)
        return F.when(F.abs(c) < 1e20, round_half_up(c, places).cast("double")).otherwise(c).alias(name)

    cols = [r(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name) for f in df.schema.fields]
    return df.select(*cols)


class Layers:
    """The lazily built layers over one raw source, shared by the products below."""

    def __init__(self, raw: RawTables):
        self.raw = raw

    @property
    def order_facts(self) -> DataFrame:
        r = self.raw
        return marts.order_facts(r.orders, r.order_items, r.order_payments)

    @property
    def sla_orders(self) -> DataFrame:
        return marts.sla_orders(self.order_facts)

    @property
    def fact_order_items(self) -> DataFrame:
        return warehouse.fact_order_items(self.raw.order_items, self.raw.orders)

    @property
    def delivery_review(self) -> DataFrame:
        r = self.raw
        return marts.delivery_review(None, r.order_reviews, marts.order_item_agg_raw(r.order_items, r.orders))

    @property
    def enriched(self) -> DataFrame:
        return marts.sla_order_enriched(self.sla_orders, self.delivery_review)

    @property
    def cohort(self) -> DataFrame:
        return marts.model_cohort(self.enriched)

    @property
    def customer_rfm(self) -> DataFrame:
        return rfm.customer_rfm(self.order_facts, self.raw.customers)


def layers(spark: SparkSession, sf_dir: str) -> Layers:
    return Layers(from_testdata(spark, sf_dir))


# --- warehouse ---
@register
def dim_customer(spark, sf_dir):
    return warehouse.dim_customer(layers(spark, sf_dir).raw.customers)


@register
def dim_sellers(spark, sf_dir):
    return warehouse.dim_sellers(layers(spark, sf_dir).raw.sellers)


@register
def dim_products(spark, sf_dir):
    r = layers(spark, sf_dir).raw
    return warehouse.dim_products(r.products, r.category_translation)


@register
def dim_date(spark, sf_dir):
    return warehouse.dim_date(layers(spark, sf_dir).raw.orders)


@register
def fact_order_items(spark, sf_dir):
    return layers(spark, sf_dir).fact_order_items


#: texts that CSV has to quote, by review: "{}" is the order's number
REVIEW_TITLES = ('plain {}', 'with, comma {}', 'says "{}"', '', None)
REVIEW_MESSAGES = ('line one\nline two of {}', 'ends in a newline {}\n', '"{}"', '\n\n', '', None, 'quote " and\nnewline, comma {}')


def awkward_reviews(reviews: DataFrame) -> DataFrame:
    """The reviews with titles and messages full of quotes, commas and newlines, NULLs and empty texts."""
    k = F.col("order_id").cast("long")

    def pick(texts):
        out = F.lit(None).cast("string")
        for i, t in enumerate(texts):
            if t is not None:
                out = F.when(k % len(texts) == i, F.replace(F.lit(t), F.lit("{}"), F.col("order_id"))).otherwise(out)
        return out

    return reviews.withColumns({"review_comment_title": pick(REVIEW_TITLES), "review_comment_message": pick(REVIEW_MESSAGES)})


@register
def csv_reviews(spark, sf_dir):
    """Reviews with awkward texts, written as CSV and read back by many tasks a file."""
    from orderlens.session import delete_path, scratch_path
    from orderlens.sources.csv import read_csv
    path = scratch_path(spark, "csv-reviews")
    (awkward_reviews(layers(spark, sf_dir).raw.order_reviews).write.option("header", True).option("quote", '"')
     .option("escape", '"').option("nullValue", "").option("emptyValue", '""').option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(path))
    found = read_csv(spark, path, "order_reviews").checkpoint(eager=True)
    delete_path(spark, path)
    return found


# --- marts ---
@register
def order_facts(spark, sf_dir):
    return rounded(layers(spark, sf_dir).order_facts)


@register
def sla_orders(spark, sf_dir):
    return layers(spark, sf_dir).sla_orders


@register
def sla_daily(spark, sf_dir):
    return rounded(marts.sla_daily(layers(spark, sf_dir).sla_orders))


@register
def sla_delivered_daily(spark, sf_dir):
    return rounded(marts.sla_delivered_daily(layers(spark, sf_dir).sla_orders))


def earlier_orders(sla: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """An earlier version of the SLA orders, without some orders and with others not delivered yet; and of the orders that have
    changed since, the old and the new version."""
    k = F.col("order_id").cast("long")
    missing, waiting = k % 11 == 0, (k % 7 == 0) & F.col("is_delivered")
    open_ = sla.filter(~missing & waiting).withColumns({
        "is_delivered": F.lit(False), "is_late": F.lit(False),
        **{c: F.lit(None).cast(sla.schema[c].dataType) for c in ("delivered_customer_ts", "delivered_date", "delivery_days", "ship_days", "days_late")}})
    earlier = sla.filter(~missing & ~waiting).unionByName(open_)
    return earlier, open_, sla.filter(missing | waiting)


def _kept_up(spark, sf_dir, day: str):
    """A day's state, built from the earlier orders and corrected to the present ones."""
    from orderlens.plans.daily_state import DailyState
    from orderlens.session import scratch_path
    earlier, old, new = earlier_orders(layers(spark, sf_dir).sla_orders.checkpoint(eager=True))
    state = DailyState(spark, scratch_path(spark, f"kept-{day}"), day)
    state.rebuild(earlier)
    state.correct(old, new)
    return state.read().checkpoint(eager=True), state.path


@register
def sla_daily_kept_up(spark, sf_dir):
    """The mart by purchase date from a state that late corrections have changed."""
    from orderlens.plans import daily_state
    from orderlens.session import delete_path
    state, path = _kept_up(spark, sf_dir, "purchase_date")
    delete_path(spark, path)
    return rounded(daily_state.sla_daily(state))


@register
def sla_delivered_daily_kept_up(spark, sf_dir):
    from orderlens.plans import daily_state
    from orderlens.session import delete_path
    state, path = _kept_up(spark, sf_dir, "delivered_date")
    delete_path(spark, path)
    return rounded(daily_state.sla_delivered_daily(state))


@register
def delivery_days_daily(spark, sf_dir):
    return rounded(marts.delivery_days_daily(layers(spark, sf_dir).order_facts))


@register
def item_facts(spark, sf_dir):
    return marts.item_facts(layers(spark, sf_dir).fact_order_items)


@register
def delivery_review(spark, sf_dir):
    return layers(spark, sf_dir).delivery_review


@register
def sla_order_enriched(spark, sf_dir):
    return layers(spark, sf_dir).enriched


@register
def model_cohort(spark, sf_dir):
    return rounded(layers(spark, sf_dir).cohort)


@register
def low_review_by_bucket(spark, sf_dir):
    return rounded(marts.low_review_by_bucket(layers(spark, sf_dir).cohort))


@register
def customer_rfm(spark, sf_dir):
    return layers(spark, sf_dir).customer_rfm


# --- data-quality jobs ---
@register
def qa_fact(spark, sf_dir):
    return quality.fact_profile(layers(spark, sf_dir).fact_order_items)


@register
def qa_dim_keys(spark, sf_dir):
    r = layers(spark, sf_dir).raw
    return quality.key_profile({
        "dim_customer": (warehouse.dim_customer(r.customers), "customer_id"),
        "dim_sellers": (warehouse.dim_sellers(r.sellers), "seller_id"),
        "dim_products": (warehouse.dim_products(r.products, r.category_translation), "product_id"),
        "dim_date": (warehouse.dim_date(r.orders), "date_key"),
    })


@register
def qa_duplicate_keys(spark, sf_dir):
    L = layers(spark, sf_dir)
    return quality.duplicate_key_counts({
        "dim_customer": (warehouse.dim_customer(L.raw.customers), ["customer_id"]),
        "dim_sellers": (warehouse.dim_sellers(L.raw.sellers), ["seller_id"]),
        "dim_products": (warehouse.dim_products(L.raw.products, L.raw.category_translation), ["product_id"]),
        "dim_date": (warehouse.dim_date(L.raw.orders), ["date_key"]),
        "fact_order_items": (L.fact_order_items, ["order_id", "order_item_id"]),
        "order_facts": (L.order_facts, ["order_id"]),
        "item_facts": (marts.item_facts(L.fact_order_items), ["order_id", "order_item_id"]),
        "delivery_review": (L.delivery_review, ["order_id"]),
        "sla_risk_scoring": (proxy_store_keys(L.cohort), ["order_id", "score_date"]),
    })


@register
def qa_nulls(spark, sf_dir):
    L = layers(spark, sf_dir)
    return quality.null_counts({"fact_order_items": (L.fact_order_items, ["order_id", "order_item_id"]),
                                "sla_risk_scoring": (proxy_store(spark, sf_dir), quality.SCORE_NOT_NULL)})


def dirty_fact(fact: DataFrame) -> DataFrame:
    """The item fact with faults: second items twice, and third items again without their order. The fact is read once."""
    item = F.col("order_item_id")
    copies = F.when(item == 2, F.array(F.lit(False), F.lit(False))).when(item == 3, F.array(F.lit(False), F.lit(True))).otherwise(
        F.array(F.lit(False)))
    lost = F.when(~F.col("_lost"), F.col("order_id")).alias("order_id")
    return fact.select("*", F.explode(copies).alias("_lost")).select(*[lost if c == "order_id" else F.col(c) for c in fact.columns])


@register
def qa_dirty_keys(spark, sf_dir):
    """The key checks on a fact that does have faults."""
    return quality.duplicate_key_counts({"dirty_fact": (dirty_fact(layers(spark, sf_dir).fact_order_items), ["order_id", "order_item_id"])})


@register
def qa_dirty_nulls(spark, sf_dir):
    return quality.null_counts({"dirty_fact": (dirty_fact(layers(spark, sf_dir).fact_order_items), ["order_id", "order_item_id"])})


@register
def qa_staged(spark, sf_dir):
    """Checks taken while tables are written, and their keys from one scan: the item fact, the same with faults, and the
    customers, staged below the checkpoint folder."""
    from functools import reduce

    from orderlens.session import delete_path, scratch_path
    from orderlens.sources.tables import Layer
    L = layers(spark, sf_dir)
    item_key = ["order_id", "order_item_id"]
    staged = Layer(spark, scratch_path(spark, "qa-staged"))
    keys, seen = {}, []
    # the faulty fact is made from the stored one: lines are numbered and joined to their orders once
    for name, build, key in (("fact_order_items", lambda: L.fact_order_items, item_key),
                             ("dirty_fact", lambda: dirty_fact(staged.read("fact_order_items")), item_key),
                             ("customer_rfm", lambda: L.customer_rfm, ["customer_id"])):
        metrics = [F.count(F.lit(1)).alias("rows_written"), *quality.null_metrics(key[:1])]
        stored, row = staged.overwrite_observed(name, build(), metrics)
        keys[name] = (stored, key)
        seen.append(row.select(F.lit(name).alias("t"), "rows_written", F.col(f"null_{key[0]}").alias("null_cnt")))
    found = quality.key_checks(keys).join(reduce(DataFrame.unionByName, seen), "t").checkpoint(eager=True)  # a row per table
    delete_path(spark, staged.root)
    return found


@register
def qa_rfm(spark, sf_dir):
    return quality.rfm_profile(layers(spark, sf_dir).customer_rfm)


@register
def qa_segments(spark, sf_dir):
    return quality.segment_distribution(layers(spark, sf_dir).customer_rfm)


@register
def qa_top_monetary(spark, sf_dir):
    return quality.top_customers(layers(spark, sf_dir).customer_rfm, "monetary_value")


@register
def qa_top_frequency(spark, sf_dir):
    return quality.top_customers(layers(spark, sf_dir).customer_rfm, "frequency")


@register
def qa_late_percentiles(spark, sf_dir):
    return rounded(quality.late_percentiles(layers(spark, sf_dir).sla_orders))


@register
def qa_very_late(spark, sf_dir):
    return quality.very_late(layers(spark, sf_dir).sla_orders)


@register
def qa_recent_days(spark, sf_dir):
    return rounded(quality.recent_delivered_days(layers(spark, sf_dir).sla_orders))


# --- model input ---
@register
def train_test_split(spark, sf_dir):
    from orderlens.model.features import train_test_split as split
    return rounded(split(layers(spark, sf_dir).cohort))


@register
def design_matrix(spark, sf_dir):
    from orderlens.model import features
    return rounded(features.design_matrix(layers(spark, sf_dir).cohort))


ABSENT_MONTH, ABSENT_BUCKET = 1, "4-7"


@register
def align_columns(spark, sf_dir):
    """A batch in which January (the baseline month) and one bucket don't occur: its design has columns for
    the levels that do, and is conformed to the model's full term list."""
    from orderlens.model import features
    from orderlens.schema import DELAY_BUCKET_LEVELS, MONTH_LEVELS
    buckets = [b for b in DELAY_BUCKET_LEVELS if b != ABSENT_BUCKET]
    months = [m for m in MONTH_LEVELS if m != ABSENT_MONTH]
    batch = layers(spark, sf_dir).cohort.filter(
        (F.col("month") != ABSENT_MONTH) & (F.col("delay_bucket") != ABSENT_BUCKET))
    part = features.design_matrix(batch, features.observed_terms(buckets, months))
    return rounded(features.align_columns(part, features.FEATURE_TERMS))


# --- scores: deterministic proxy scores over the cohort (SQL-checkable), and the real model ---
PROXY_A = (20_000, 100)  # score = (delay_cap * a + freight_value * b) / 1e6, exact in both engines
PROXY_B = (25_000, 100)


def proxy_score(cohort: DataFrame, weights=PROXY_A, out: str = "risk_score") -> DataFrame:
    a, b = weights
    k = F.col("delay_cap").cast("long") * a + (F.col("freight_value") * b).cast("long")
    return cohort.select("*", (k.cast("double") / F.lit(1_000_000.0)).alias(out))


DAY1, DAY2, DAY3 = "2024-01-01", "2024-01-02", "2024-01-03"


def proxy_store_parts(spark, sf_dir):
    """Existing store: every cohort order scored on day 1 and day 2 (score A). Incoming batches:
    late orders re-scored on day 2 (score B, replaces) and orders 4-14 days late scored on day 3 (new).
    The cohort feeds four batches (each with its own percentile job): it is checkpointed once."""
    from orderlens.model.score import assemble_scores, flag_cuts
    c = layers(spark, sf_dir).cohort.checkpoint(eager=True)
    a = proxy_score(c, PROXY_A)
    b = proxy_score(c, PROXY_B)
    cuts = tuple(flag_cuts(a, stage_input=False).first())  # both days hold the same batch
    existing = assemble_scores(a, DAY1, cuts=cuts).unionByName(assemble_scores(a, DAY2, cuts=cuts))
    incoming = (assemble_scores(b.filter(F.col("delay_cap") > 0), DAY2)
                .unionByName(assemble_scores(b.filter(F.col("delay_cap").between(4, 14)), DAY3)))
    return existing, incoming


def proxy_store(spark, sf_dir):
    from orderlens.operators.keyed import upsert_merge
    existing, incoming = proxy_store_parts(spark, sf_dir)
    return upsert_merge(existing, incoming, ["order_id", "score_date"])


def proxy_store_keys(cohort: DataFrame) -> DataFrame:
    """The keys of the same store, which take no cut-offs: a lazy plan."""
    from functools import reduce

    from orderlens.operators.keyed import upsert_merge
    cap = F.col("delay_cap")
    batches = [cohort, cohort, cohort.filter(cap > 0), cohort.filter(cap.between(4, 14))]
    keyed = [b.select("order_id", F.lit(d).cast("date").alias("score_date")) for b, d in zip(batches, (DAY1, DAY2, DAY2, DAY3))]
    return upsert_merge(reduce(DataFrame.unionByName, keyed[:2]), reduce(DataFrame.unionByName, keyed[2:]), ["order_id", "score_date"])


@register
def exact_quantile(spark, sf_dir):
    from orderlens.operators.rank import exact_quantiles
    s = proxy_score(layers(spark, sf_dir).cohort)
    return rounded(exact_quantiles(s, "risk_score", [0.5, 0.9, 0.95, 0.99]))


@register
def risk_flags(spark, sf_dir):
    from orderlens.model.score import assemble_scores
    return assemble_scores(proxy_score(layers(spark, sf_dir).cohort), DAY1)


@register
def score_run_summary(spark, sf_dir):
    from orderlens.model.score import assemble_scores, run_summary
    return run_summary(assemble_scores(proxy_score(layers(spark, sf_dir).cohort), DAY1))


@register
def roc_curve(spark, sf_dir):
    from orderlens.model import evaluate
    return rounded(evaluate.roc_curve(proxy_score(layers(spark, sf_dir).cohort), "risk_score", "is_low_review"))


@register
def roc_auc(spark, sf_dir):
    from orderlens.model import evaluate
    return rounded(evaluate.auc(proxy_score(layers(spark, sf_dir).cohort), "risk_score", "is_low_review"))


@register
def youden(spark, sf_dir):
    from orderlens.model import evaluate
    return rounded(evaluate.youden(proxy_score(layers(spark, sf_dir).cohort), "risk_score", "is_low_review"))


CONFUSION_THRESHOLDS = (0.5, 0.3, 0.2, 0.1)


@register
def confusion(spark, sf_dir):
    from orderlens.model import evaluate
    s = proxy_score(layers(spark, sf_dir).cohort)
    return rounded(evaluate.confusion(s, "risk_score", "is_low_review", CONFUSION_THRESHOLDS))


@register
def upsert_scores(spark, sf_dir):
    return proxy_store(spark, sf_dir).drop("created_at")


@register
def stored_scores(spark, sf_dir):
    """The same store through Parquet: written, upserted twice with the re-scores, and read back. The incoming
    rows come without their thresholds' defaults and version, which the store fills in; ``renewed`` tells the
    rows of the last write by their ``created_at``."""
    from orderlens.model.score import ScoreStore
    from orderlens.session import scratch_path
    existing, incoming = proxy_store_parts(spark, sf_dir)
    store = ScoreStore(spark, scratch_path(spark, "stored-scores"))
    store.upsert(existing)
    store.upsert(incoming.drop("model_version"))
    before = store.read().agg(F.max("created_at")).first()[0]
    store.upsert(incoming.withColumn("model_version", F.lit(None).cast("string")))
    return store.read().select("*", (F.col("created_at") > F.lit(before)).alias("renewed")).drop("created_at")


@register
def latest_score(spark, sf_dir):
    from orderlens.plans.report import latest_scores
    return latest_scores(proxy_store(spark, sf_dir))


def bucketed_store(spark, sf_dir):
    """The proxy store laid out by order: written, then upserted with the re-scores."""
    from orderlens.model.bucketed import BucketedScoreStore
    from orderlens.session import scratch_path
    existing, incoming = proxy_store_parts(spark, sf_dir)
    store = BucketedScoreStore(spark, scratch_path(spark, "bucketed-scores"))
    store.upsert(existing)
    store.upsert(incoming.drop("model_version"))
    return store


@register
def bucketed_latest_score(spark, sf_dir):
    return bucketed_store(spark, sf_dir).latest()


@register
def bucketed_order_scored(spark, sf_dir):
    return bucketed_store(spark, sf_dir).scored(layers(spark, sf_dir).enriched)


@register
def insert_if_absent(spark, sf_dir):
    """Existing table: the proxy scores of day 1 and 2. Incoming: the day-2 re-scores and day-3 scores.
    Insert-if-absent keeps every existing (order, day) as it was and adds only the day-3 rows."""
    from orderlens.operators.keyed import insert_if_absent as ins
    existing, incoming = proxy_store_parts(spark, sf_dir)
    return ins(existing, incoming, ["order_id", "score_date"])


@register
def sla_order_scored(spark, sf_dir):
    from orderlens.plans import report
    return report.sla_order_scored(layers(spark, sf_dir).enriched, proxy_store(spark, sf_dir))


@register
def wbr_weekly(spark, sf_dir):
    from orderlens.plans import report
    scored = report.sla_order_scored(layers(spark, sf_dir).enriched, proxy_store(spark, sf_dir))
    return report.wbr_weekly(scored)


@register
def follow_up_list(spark, sf_dir):
    from orderlens.plans import report
    scored = report.sla_order_scored(layers(spark, sf_dir).enriched, proxy_store(spark, sf_dir))
    return report.follow_up_list(scored)


@register
def delay_summary(spark, sf_dir):
    from orderlens.plans import report
    return rounded(report.delay_summary(layers(spark, sf_dir).cohort))


# --- scoring and effects with a declared coefficient vector, which SQL can follow ---
DECLARED_INTERCEPT = -1.5


def declared_betas() -> dict[str, float]:
    """-0.2 to 0.2 in turn over the model's terms."""
    from orderlens.model.features import FEATURE_TERMS
    return {t: (k % 5 - 2) / 10 for k, t in enumerate(FEATURE_TERMS)}


@register
def declared_scores(spark, sf_dir):
    """A daily batch scored with the declared coefficients: design, alignment, probability, flags."""
    from orderlens.model.score import assemble_scores, predict_linear
    return assemble_scores(predict_linear(DECLARED_INTERCEPT, declared_betas(), layers(spark, sf_dir).cohort), DAY1)


@register
def declared_probability(spark, sf_dir):
    """Implied probabilities per delay bucket in the training split, through the declared odds ratios."""
    from orderlens.model import evaluate, features
    betas = declared_betas()
    train = features.train_test_split(layers(spark, sf_dir).cohort).filter(F.col("split") == "train")
    coefs = evaluate.coefficient_table(spark, list(betas), DECLARED_INTERCEPT, list(betas.values()))
    return rounded(evaluate.implied_probability(train, coefs))


# --- unadjusted effects, which SQL can follow: the same reports over them ---
def crude(spark, sf_dir):
    """Effects of delay bucket and month, and of a price band, which is no key term."""
    from orderlens.model import evaluate
    from orderlens.schema import DELAY_BUCKET_LEVELS, MONTH_LEVELS
    factors = {"delay_bucket": (F.col("delay_bucket"), DELAY_BUCKET_LEVELS[0]), "month": (F.col("month"), str(MONTH_LEVELS[0])),
               "price_band": (F.least(F.floor(F.col("price") / 100_000), F.lit(4)).cast("int"), "0")}
    return evaluate.crude_effects(layers(spark, sf_dir).cohort, factors)


@register
def crude_effects(spark, sf_dir):
    return rounded(crude(spark, sf_dir))


@register
def crude_key_terms(spark, sf_dir):
    from orderlens.model import evaluate
    return rounded(evaluate.key_terms(crude(spark, sf_dir)))


@register
def crude_top_effects(spark, sf_dir):
    from orderlens.model import evaluate
    return rounded(evaluate.top_effects(crude(spark, sf_dir)))


# --- the ridge model itself (fit by Spark ML; no SQL oracle for its figures: rows-only checks) ---
_MODELS: dict[tuple[str, str], tuple] = {}


def trained(spark, sf_dir):
    """Split, cross-validate and fit once per session and input; reused by the model products."""
    from orderlens.model import features, ridge
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _MODELS:
        split = features.train_test_split(layers(spark, sf_dir).cohort)  # a projection of stored rows
        train = split.filter(F.col("split") == "train")
        design = features.design_matrix(train, keep=("order_id", "is_low_review"))
        m1se, mmin = ridge.train_ridge(design)
        _MODELS[key] = (split, m1se, mmin)
    return _MODELS[key]


def _coefs(spark, model):
    from orderlens.model import evaluate
    return evaluate.coefficient_table(spark, model.terms, model.intercept, model.betas)


@register
def ridge_cv(spark, sf_dir):
    from orderlens.model import ridge
    _, m1se, _ = trained(spark, sf_dir)
    return ridge.cv_table(spark, m1se)


@register
def coefficients(spark, sf_dir):
    _, m1se, _ = trained(spark, sf_dir)
    return _coefs(spark, m1se)


#: a fit is at its optimum where no derivative is larger
GRADIENT_TOLERANCE = 1e-5


@register
def ridge_settled(spark, sf_dir):
    """Per term: is the fitted model (lambda.1se) at its optimum over the training split?"""
    from orderlens.model import evaluate, features
    from orderlens.model.score import predict
    split, m1se, _ = trained(spark, sf_dir)
    train = split.filter(F.col("split") == "train")
    design = features.design_matrix(train, keep=("order_id", "is_low_review")).join(
        predict(m1se, train).select("order_id", "risk_score"), "order_id")
    g = evaluate.gradient(design, m1se.terms, m1se.betas, m1se.lambda_used)
    return g.select("term", (F.abs("gradient") < GRADIENT_TOLERANCE).alias("settled"))


@register
def key_terms(spark, sf_dir):
    from orderlens.model import evaluate
    return evaluate.key_terms(_coefs(spark, trained(spark, sf_dir)[1]))


@register
def top_effects(spark, sf_dir):
    from orderlens.model import evaluate
    return evaluate.top_effects(_coefs(spark, trained(spark, sf_dir)[1]))


@register
def implied_probability(spark, sf_dir):
    from orderlens.model import evaluate
    split, m1se, _ = trained(spark, sf_dir)
    return evaluate.implied_probability(split.filter(F.col("split") == "train"), _coefs(spark, m1se))


@register
def batch_scores(spark, sf_dir):
    """Daily batch: the model at lambda.1se scores the cohort; batch P90/P95 flags."""
    from orderlens.model.score import assemble_scores, predict
    _, m1se, _ = trained(spark, sf_dir)
    return assemble_scores(predict(m1se, layers(spark, sf_dir).cohort), DAY1)


@register
def model_evaluation(spark, sf_dir):
    """Test split: AUC at lambda.min and lambda.1se; confusion at 0.5, 0.3, the Youden threshold and 0.2."""
    from orderlens.model import evaluate
    from orderlens.model.score import predict
    split, m1se, mmin = trained(spark, sf_dir)
    test = split.filter(F.col("split") == "test")
    labels = test.select("order_id", "is_low_review")
    p1 = predict(m1se, test).join(labels, "order_id")
    p0 = predict(mmin, test).join(labels, "order_id")
    a1 = evaluate.auc(p1, "risk_score", "is_low_review").first()["auc"]
    a0 = evaluate.auc(p0, "risk_score", "is_low_review").first()["auc"]
    yj = evaluate.youden(p1, "risk_score", "is_low_review").first()["threshold"]
    conf = evaluate.confusion(p1, "risk_score", "is_low_review", [0.5, 0.3, yj, 0.2])
    return conf.select(F.lit(a0).alias("auc_lambda_min"), F.lit(a1).alias("auc_lambda_1se"), "*")


#: the tables of a whole run, and the columns that their checksums cover
RUN_TABLES = {
    "dim_customer": ("customer_id", "customer_city"), "dim_sellers": ("seller_id", "seller_city"),
    "dim_products": ("product_id", "product_category_name_english"), "dim_date": ("date_key", "day_of_week"),
    "fact_order_items": ("order_id", "order_item_id", "price"), "order_facts": ("order_id", "gmv", "is_late"),
    "customer_rfm": ("customer_id", "monetary_value", "rfm_score"), "sla_orders": ("order_id", "days_late"),
    "sla_daily": ("purchase_date", "orders_cnt", "late_cnt"), "sla_delivered_daily": ("delivered_date", "delivered_cnt", "late_cnt"),
    "item_facts": ("order_id", "order_item_id", "item_total"), "delivery_review": ("order_id", "review_score", "delivery_delay_days"),
    "sla_risk_scoring": ("order_id", "score_date"), "sla_wbr_weekly": ("week_start", "delivered_cnt", "late_cnt", "scored_cnt"),
}


def checksum(columns) -> Column:
    """The sum over all rows of 32 bits of an MD5 of the columns as text."""
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in columns])
    return F.sum(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long"))


@register
def full_run(spark, sf_dir):
    """The whole run (warehouse, gate, marts, model, scores, weekly report) into a fresh folder under
    the checkpoint directory: rows and checksum of each of its 14 stored tables, read back from Parquet."""
    from functools import reduce

    from orderlens.plans import runner
    from orderlens.session import delete_path, scratch_path
    out = scratch_path(spark, "full-run")
    res = runner.run(spark, from_testdata(spark, sf_dir), out, score_date=DAY1)
    parts = [spark.read.parquet(res.tables[t]).agg(F.lit(t).alias("t"), F.count(F.lit(1)).alias("n_rows"), checksum(c).alias("checksum"))
             for t, c in RUN_TABLES.items()]
    found = reduce(DataFrame.unionByName, parts).checkpoint(eager=True)  # a row per table
    delete_path(spark, out)
    return found
