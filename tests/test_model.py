"""Model input and the ridge fit: exact split sizes, design columns, alignment, optimality of the fit."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderlens.model import features, ridge
from orderlens.queries import layers

SF = "/root/testdata/sf0.001"


def test_split_sizes_exact(spark):
    cohort = layers(spark, SF).cohort
    n = cohort.count()
    split = features.train_test_split(cohort)
    counts = {r["split"]: r["count"] for r in split.groupBy("split").count().collect()}
    assert counts["train"] == math.floor(0.8 * n) and counts["train"] + counts["test"] == n


def test_design_and_alignment(spark):
    df = spark.createDataFrame([("a", "1-3", 3, 1.0, 2.0, 2), ("b", "0", 12, 0.5, 0.1, 1)],
                               "order_id string, delay_bucket string, month int, log_price double, "
                               "log_freight_value double, items_count long")
    dm = {r["order_id"]: r for r in features.design_matrix(df).collect()}
    assert dm["a"]["delay_bucket1_3"] == 1.0 and dm["a"]["month3"] == 1.0 and dm["a"]["month12"] == 0.0
    assert dm["b"]["month12"] == 1.0 and dm["b"]["delay_bucket1_3"] == 0.0
    assert len(features.FEATURE_TERMS) == 18
    # a design built only from the levels present lacks most month/bucket columns: aligned -> zeros
    part = features.design_matrix(df, features.observed_terms(["0", "1-3"], [3, 12]))
    aligned = features.align_columns(part.withColumn("extra", F.lit(9.0)), features.FEATURE_TERMS)
    assert aligned.columns == ["order_id"] + features.FEATURE_COLUMNS
    row = {r["order_id"]: r for r in aligned.collect()}["a"]
    assert row["month5"] == 0.0 and row["delay_bucket8_14"] == 0.0 and row["delay_bucket1_3"] == 1.0
    assert row["month3"] == 1.0 and row["month12"] == 0.0  # the baseline is January, though it doesn't occur


def test_unknown_month_is_rejected(spark):
    df = spark.createDataFrame([("a", "0", 13)], "order_id string, delay_bucket string, month int")
    try:
        features.check_levels(df)
    except ValueError:
        return
    raise AssertionError("month 13 accepted")


@pytest.mark.parametrize("bucket, month", [(None, 3), ("0", None), ("9-9", 1)])
def test_null_and_unknown_levels_are_rejected(spark, bucket, month):
    df = spark.createDataFrame([("a", "0", 1), ("b", bucket, month)], "order_id string, delay_bucket string, month int")
    with pytest.raises(ValueError):
        features.check_levels(df)


def _gradient(X, y, b0, b, lam, sd):
    p = 1 / (1 + np.exp(-(b0 + X @ b)))
    return np.append(X.T @ (p - y) / len(y) + lam * sd**2 * b, np.mean(p - y))


def test_full_path_and_optimal_fits(spark):
    """100 lambdas; at the fits for lambda.min, lambda.1se and a larger lambda the gradient of the mean log-loss +
    lambda/2 * sum((sd_j * beta_j)^2) vanishes; held-out losses equal those of refits in numpy, weighted by
    the folds' sizes."""
    cohort = layers(spark, SF).cohort
    design = features.design_matrix(cohort, keep=("order_id", "is_low_review")).checkpoint()
    table, lambdas, rows = ridge.cross_validate(design)
    assert len(table) == len(lambdas) == 100 and lambdas == sorted(lambdas, reverse=True)
    lmin, l1se = ridge.choose_lambdas(table)
    pdf = design.withColumn("_fold", ridge.fold_of("order_id")).toPandas()
    assert rows == len(pdf)
    X, y = pdf[features.FEATURE_COLUMNS].to_numpy(float), pdf["is_low_review"].to_numpy(float)
    for lam in (lmin, l1se, 0.05):
        lr = ridge.fit_ridge(design, lam).stages[-1]
        assert np.max(np.abs(_gradient(X, y, lr.intercept, lr.coefficients.toArray(), lam, X.std(axis=0, ddof=1)))) < 1e-5
    for r in (table[0], table[50], table[99]):
        total = 0.0
        for f in range(5):
            inside = (pdf["_fold"] != f).to_numpy()
            Xi, yi = np.column_stack([np.ones(inside.sum()), X[inside]]), y[inside]
            sd = X[inside].std(axis=0, ddof=1)
            beta = np.zeros(Xi.shape[1])
            pen = np.append(0.0, r["lambda"] * sd**2)
            for _ in range(50):
                p = 1 / (1 + np.exp(-Xi @ beta))
                h = (Xi * (p * (1 - p))[:, None]).T @ Xi / len(yi) + np.diag(pen) + 1e-10 * np.eye(len(beta))
                beta = beta - np.linalg.solve(h, Xi.T @ (p - yi) / len(yi) + pen * beta)
            m = np.column_stack([np.ones((~inside).sum()), X[~inside]]) @ beta
            total += float((np.logaddexp(0, m) - y[~inside] * m).sum())
        assert abs(total / len(y) - r["mean_logloss"]) < 1e-6


def test_path_that_does_not_settle_raises(spark, monkeypatch):
    monkeypatch.setattr(ridge, "MAX_STEPS", 1)
    design = features.design_matrix(layers(spark, SF).cohort, keep=("order_id", "is_low_review"))
    with pytest.raises(RuntimeError, match="not settled"):
        ridge.cross_validate(design, n_lambda=2)


def test_choose_lambdas_one_se_rule():
    table = [{"lambda": 10.0, "mean_logloss": 0.50, "se_logloss": 0.01},
             {"lambda": 1.0, "mean_logloss": 0.405, "se_logloss": 0.01},
             {"lambda": 0.1, "mean_logloss": 0.40, "se_logloss": 0.01},
             {"lambda": 0.01, "mean_logloss": 0.401, "se_logloss": 0.01}]
    assert ridge.choose_lambdas(table) == (0.1, 1.0)


def test_all_folds_and_lambdas_in_few_jobs(spark):
    """500 models take their steps together: one job a pass, in parallel over the partitions."""
    sc = spark.sparkContext
    cohort = layers(spark, SF).cohort
    design = features.design_matrix(cohort, keep=("order_id", "is_low_review")).repartition(5, "order_id").checkpoint()
    sc.setJobGroup("ridge-path", "")
    try:
        table, _, _ = ridge.cross_validate(design)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    jobs = sc.statusTracker().getJobIdsForGroup("ridge-path")
    assert len(table) == 100 and 3 <= len(jobs) <= 15
    assert all(len(sc.statusTracker().getJobInfo(j).stageIds) <= 3 for j in jobs)


def test_constant_columns_and_a_fold_without_rows(spark, monkeypatch):
    """A column that never varies keeps the coefficient 0; an empty fold has no part in the means."""
    rows = [(str(k), k % 3 == 0, float(k % 7), 1.0) for k in range(60)]
    design = spark.createDataFrame(rows, "order_id string, y boolean, a double, b double").select(
        "order_id", F.col("y").cast("int").alias("y"), "a", "b")
    monkeypatch.setattr(ridge, "term_column", lambda t: t)
    monkeypatch.setattr(ridge, "fold_of", lambda *_: F.pmod(F.col("order_id").cast("int"), F.lit(2)).cast("int"))
    table, lambdas, n = ridge.cross_validate(design, "y", ["a", "b"], folds=3, n_lambda=5)
    alone, _, _ = ridge.cross_validate(design, "y", ["a"], folds=3, n_lambda=5)
    assert n == 60 and all(r["folds"] == 2 for r in table) and len(lambdas) == 5
    assert all(abs(r["mean_logloss"] - s["mean_logloss"]) < 1e-9 for r, s in zip(table, alone))


def test_a_fitted_model_scores_in_a_session_that_has_observed_a_query(spark):
    """The training summary holds the session; a model that carries it can't be sent to tasks after an observation."""
    from pyspark.sql import Observation

    rows = [(str(i), i % 3 == 0, float(i % 7)) for i in range(60)]
    design = spark.createDataFrame(rows, "order_id string, low boolean, a double").select("order_id", F.col("low").cast("int").alias("low"), "a")
    model = ridge.fit_ridge(design, 0.1, "low", ["a"])
    assert not model.stages[-1].hasSummary
    seen = Observation()
    assert design.observe(seen, F.count(F.lit(1)).alias("n")).count() == 60 and seen.get["n"] == 60
    assert model.transform(design).select("probability").distinct().count() == 7


@pytest.mark.parametrize("ids", [[str(i) for i in range(23)], ["a"] * 9 + ["b"] * 4, [None] * 6 + ["a", "b", "b", None], ["x"], []])
def test_split_is_exact_without_a_sort_of_all_rows(spark, ids):
    """The rows of the sorted order come first, also where ids repeat or are missing, and no shuffle moves them all."""
    import hashlib

    df = spark.createDataFrame([(x, k) for k, x in enumerate(ids)], "order_id string, k int")
    split = features.train_test_split(df)
    got = sorted((x is not None, hashlib.md5(f"{x}{features.SPLIT_SEED}".encode()).hexdigest() if x is not None else "", x or "", s != "train")
                 for x, _, s in split.collect())
    assert [g[2] for g in got] == [x or "" for x in sorted(ids, key=lambda x: (
        x is not None, hashlib.md5(f"{x}{features.SPLIT_SEED}".encode()).hexdigest() if x is not None else ""))]
    n_train = math.floor(features.TRAIN_FRACTION * len(ids))
    assert [g[3] for g in got] == [False] * n_train + [True] * (len(ids) - n_train)
    if len(set(ids)) == len(ids) and ids:
        assert "Exchange" not in split._jdf.queryExecution().executedPlan().toString()


def test_a_pass_reads_stored_blocks_and_sums_exactly(spark):
    rng = np.random.default_rng(3)
    rows = [(float(a), float(b), float(rng.random() < 0.4), int(k % 3)) for k, (a, b) in enumerate(rng.normal(size=(700, 2)))]
    data = spark.createDataFrame(rows, "a double, b double, y double, _fold int").repartition(3)
    blocks = ridge._blocks(data, ["a", "b"], "y")
    X, y, fold = np.array([[1.0, r[0], r[1]] for r in rows]), np.array([r[2] for r in rows]), np.array([r[3] for r in rows])
    betas, out_of = np.array([[0.1, -0.3, 0.5], [900.0, 2.0, 1.0], [-900.0, 1.0, 0.0]]), np.array([0, 1, 2])
    loss, grad, hess = ridge._pass(blocks, betas, out_of)
    for k, b in enumerate(betas):
        m, held = X @ b, fold == out_of[k]
        p = 1 / (1 + np.exp(-np.clip(m, -500, 500)))
        assert np.isclose(loss[k], (np.log1p(np.exp(-np.abs(m))) + np.maximum(m, 0) - y * m)[held].sum())
        assert np.allclose(grad[k], X[~held].T @ (p - y)[~held])
        assert np.allclose(hess[k], (X[~held].T * (p * (1 - p))[~held]) @ X[~held])
    sums = ridge._moments(blocks, 2, 3)
    assert np.allclose(sums[1], np.concatenate([[(fold == 1).sum(), y[fold == 1].sum()], X[fold == 1, 1:].sum(0),
                                                (X[fold == 1, 1:] ** 2).sum(0), y[fold == 1] @ X[fold == 1, 1:]]))
