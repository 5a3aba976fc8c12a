"""Driver tier: each registered query against its DuckDB oracle on sf0.001 (the cheap ones here;
scripts/compare.py runs them all)."""

import decimal
import math

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem".split()
FAST = ["dim_date", "order_facts", "sla_orders", "sla_daily", "sla_delivered_daily", "delivery_review",
        "sla_order_enriched", "model_cohort", "low_review_by_bucket", "customer_rfm", "qa_late_percentiles",
        "qa_recent_days", "qa_duplicate_keys", "exact_quantile", "roc_auc", "youden", "confusion", "wbr_weekly",
        "align_columns", "stored_scores", "latest_score", "bucketed_latest_score", "bucketed_order_scored", "qa_dirty_keys", "qa_staged", "qa_dirty_nulls", "dim_customer",
        "declared_scores", "declared_probability", "csv_reviews", "crude_effects", "crude_key_terms", "crude_top_effects"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    if isinstance(v, decimal.Decimal):
        return str(v.normalize())
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in records), key=lambda t: [(x is None, str(x)) for x in t])


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle_or_is_model_only():
    q, o = E.queries(), E.oracle_sql()
    rows_only = set(q) - set(o) - set(E.LLM_QUERIES)  # those have their own tests
    assert rows_only <= {"ridge_cv", "coefficients", "key_terms", "top_effects", "implied_probability",
                         "batch_scores", "model_evaluation"}


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "late_rate" in df.columns


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(ocols, res.fetchall())
