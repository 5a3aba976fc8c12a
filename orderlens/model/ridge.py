"""Ridge (L2) logistic regression with k-fold cross-validation over a lambda path, lambda.min and
lambda.1se.

All folds and lambdas are fitted together by Newton's steps: a step is one pass, one job, over the cached design
for every model that has not settled, and a tree adds the partitions' sums up on the executors. The final models are fitted by Spark ML.
Only sums of fixed size, from some square root of the
partitions, and coefficients reach the driver.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.model.features import FEATURE_TERMS, term_column
from orderlens.schema import CV_FOLDS, MODEL_VERSION, SPLIT_SEED
from orderlens.session import delete_path, scratch_path

# glmnet-style path: lambda_max as for alpha = 0.001, down to ratio * lambda_max
RIDGE_ALPHA_FOR_LMAX = 0.001
LAMBDA_MIN_RATIO = 1e-4
N_LAMBDA = 100
# Newton's steps: the change of a scaled coefficient that counts as none, the largest that one step makes, and how
# many steps a model may take
TOLERANCE = 1e-5
MAX_CHANGE = 2.0
MAX_STEPS = 50
# rows that a pass works on at a time: the weights of 500 models over them are 1 MB, which stays in a core's cache
BLOCK_ROWS = 256
# iterations of the final fits
MAX_ITERATIONS = 1000


@dataclass
class RidgeModel:
    terms: list[str]
    model: PipelineModel
    lambda_used: float
    lambda_min: float
    lambda_1se: float
    version: str = MODEL_VERSION
    cv: list[dict] = field(default_factory=list)

    @property
    def intercept(self) -> float:
        return float(self.model.stages[-1].intercept)

    @property
    def betas(self) -> list[float]:
        return [float(b) for b in self.model.stages[-1].coefficients.toArray()]

    def save(self, path: str) -> None:
        self.model.write().overwrite().save(path)
        spark = SparkSession.getActiveSession()
        meta = {"terms": self.terms, "lambda_used": self.lambda_used, "lambda_min": self.lambda_min,
                "lambda_1se": self.lambda_1se, "version": self.version, "cv": self.cv}
        spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode(
            "overwrite").text(path.rstrip("/") + "/orderlens_meta")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "RidgeModel":
        try:
            model = PipelineModel.load(path)
            meta = json.loads(spark.read.text(path.rstrip("/") + "/orderlens_meta").first()[0])
        except Exception as e:  # noqa: BLE001 - the reason is re-raised with the path
            raise FileNotFoundError(f"model not found or unreadable at {path}: {e}") from e
        return cls(meta["terms"], model, meta["lambda_used"], meta["lambda_min"], meta["lambda_1se"],
                   meta["version"], meta.get("cv", []))


def fold_of(id_col: str, folds: int = CV_FOLDS, seed: int = SPLIT_SEED) -> Column:
    """Reproducible fold number from a hash of the row id."""
    return F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.lit(seed)), F.lit(folds)).cast("int")


def lambda_path(sums: np.ndarray, n_lambda: int = N_LAMBDA, ratio: float = LAMBDA_MIN_RATIO) -> tuple[list[float], int]:
    """Decreasing log-spaced lambdas from lambda_max (glmnet's rule on standardised columns) to
    ratio * lambda_max, and the row count; from the :func:`_moments` of all folds."""
    n, sy = sums[:, 0].sum(), sums[:, 1].sum()
    sx, sq, sc = sums[:, 2:].sum(0).reshape(3, -1)
    sd = np.sqrt(np.maximum(sq / n - (sx / n) ** 2, 0.0))
    some = sd > 0
    best = float((np.abs(sc - sx * sy / n)[some] / sd[some] / n).max(initial=0.0))
    lmax = max(best / RIDGE_ALPHA_FOR_LMAX, 1e-6)
    if n_lambda == 1:
        return [lmax], int(n)
    step = math.log(ratio) / (n_lambda - 1)
    return [lmax * math.exp(step * k) for k in range(n_lambda)], int(n)


def _lr(lam: float, label: str) -> LogisticRegression:
    return LogisticRegression(featuresCol="features", labelCol=label, family="binomial", regParam=lam,
                              elasticNetParam=0.0, standardization=True, fitIntercept=True,
                              maxIter=MAX_ITERATIONS, tol=1e-9)


def _blocks(data: DataFrame, cols: list[str], label: str) -> DataFrame:
    """``data`` (with ``_fold``) as blocks of rows of one fold: the fold, and the matrix of 1, ``cols`` and the label as bytes.
    Every pass reads them as they are, so that no row is converted twice. A block has the rows of an Arrow batch at most."""
    def run(batches):
        for b in batches:
            rows = np.column_stack([np.ones(len(b)), b[[*cols, label]].to_numpy(float)])
            fold = b["_fold"].to_numpy()
            found = np.unique(fold)
            yield pd.DataFrame({"fold": found, "rows": [rows[fold == f].tobytes() for f in found]})

    return data.mapInPandas(run, "fold int, rows binary")


def _summed(blocks: DataFrame, run, size: int) -> np.ndarray:
    """The sum over all partitions of the array of ``size`` numbers that ``run`` makes of a partition's blocks: one job.

    Partitions are added up in a tree on the executors, so the driver gets some square root of their number at most, however
    many there are."""
    # the one use of an RDD: DataFrames have no aggregate that adds arrays up in one job
    parts = blocks.rdd.mapPartitions(lambda rows: [run(rows)])
    return parts.treeReduce(np.add) if parts.getNumPartitions() else np.zeros(size)


def _moments(blocks: DataFrame, columns: int, folds: int) -> np.ndarray:
    """Per fold: rows, sum of the label, and for every column the sums of x, x * x and x * label."""
    width = 2 + 3 * columns

    def run(rows):
        out = np.zeros((folds, width))
        for fold, block in rows:
            m = np.frombuffer(block).reshape(-1, columns + 2)
            x, y = m[:, 1:-1], m[:, -1]
            out[fold] += np.concatenate([[len(m), y.sum()], x.sum(0), (x * x).sum(0), y @ x])
        return out.ravel()

    return _summed(blocks, run, folds * width).reshape(folds, width)


def _spreads(sums: np.ndarray) -> np.ndarray:
    """The standard deviation of every column over the rows outside each fold."""
    rest = sums.sum(0) - sums
    rows = rest[:, :1]
    sx, sq, _ = np.split(rest[:, 2:], 3, axis=1)
    return np.sqrt(np.maximum((sq - sx**2 / np.maximum(rows, 1)) / np.maximum(rows - 1, 1), 0))


def _pass(blocks: DataFrame, betas: np.ndarray, out_of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One pass over the data for many models: the summed log-loss of each over the fold it leaves out (``out_of``), and the
    gradient and second derivatives of the summed log-loss over all other rows.

    The second derivatives of all models are one product of their weights with the rows' pairwise products of columns."""
    models, width = betas.shape
    upper = np.triu_indices(width)
    size = 1 + width + len(upper[0])

    def run(rows):
        room = np.empty((2, BLOCK_ROWS * models))
        sums = {}  # per fold: the models that leave it out, all others, and the sums of both
        for fold, block in rows:
            data = np.frombuffer(block).reshape(-1, width + 1)
            if fold not in sums:
                held, rest = np.flatnonzero(out_of == fold), np.flatnonzero(out_of != fold)
                sums[fold] = held, rest, np.zeros(len(held)), np.zeros((len(rest), width)), np.zeros((len(rest), len(upper[0])))
            held, rest, loss, grad, hess = sums[fold]
            b_held, b_rest = betas[held].T, -betas[rest].T
            for k in range(0, len(data), BLOCK_ROWS):
                x, y = data[k:k + BLOCK_ROWS, :-1], data[k:k + BLOCK_ROWS, -1]
                if len(held):
                    m = x @ b_held
                    # one logarithm for a block's product: a factor is 2 at most, and 2 ** BLOCK_ROWS is a finite double
                    loss += np.log((1 + np.exp(-np.abs(m))).prod(0)) + np.maximum(m, 0).sum(0) - y @ m
                # the same two arrays serve all blocks, as fresh ones of this size cost more than what is done with them
                p, square = room[:, :len(x) * len(rest)].reshape(2, len(x), len(rest))
                np.matmul(x, b_rest, out=p)
                with np.errstate(over="ignore"):  # a probability whose exponential overflows is 0
                    np.exp(p, out=p)
                p += 1
                np.reciprocal(p, out=p)
                grad += p.T @ x - y @ x
                np.multiply(p, p, out=square)
                p -= square
                pairs = x[:, upper[0]] * x[:, upper[1]]
                some = pairs.any(0)  # levels of one factor never meet: the products of their columns add nothing
                hess[:, some] += p.T @ pairs[:, some]
        out = np.zeros((models, size))
        for held, rest, loss, grad, hess in sums.values():
            out[held, 0] += loss
            out[rest, 1:1 + width] += grad
            out[rest, 1 + width:] += hess
        return out.ravel()

    total = _summed(blocks, run, models * size).reshape(models, size)
    hess = np.zeros((models, width, width))
    hess[:, upper[0], upper[1]] = hess[:, upper[1], upper[0]] = total[:, 1 + width:]
    return total[:, 0], total[:, 1:1 + width], hess


def cross_validate(design: DataFrame, label: str = "is_low_review", terms: list[str] | None = None,
                   id_col: str = "order_id", folds: int = CV_FOLDS, n_lambda: int = N_LAMBDA,
                   seed: int = SPLIT_SEED) -> tuple[list[dict], list[float], int]:
    """Per lambda: mean and standard error, weighted by the folds' sizes, of the held-out mean log-loss; the
    lambdas; the number of training rows.

    The models of all folds and lambdas take their Newton steps together, one pass (one job) over the one cached frame a
    step; those that have settled are left out of the next. A step that would change a scaled coefficient by more
    than ``MAX_CHANGE`` is shortened. A model that has not settled after ``MAX_STEPS`` passes raises.
    """
    terms = list(terms or FEATURE_TERMS)
    cols = [term_column(t) for t in terms]
    data = design.select(F.col(label).cast("double").alias(label), *cols, fold_of(id_col, folds, seed).alias("_fold"))
    # deterministic lineage (hash folds): a lost cached block is recomputed identically
    data = _blocks(data, cols, label).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        sums = _moments(data, len(cols), folds)
        lambdas, rows = lambda_path(sums, n_lambda)
        n, sd = sums[:, 0], _spreads(sums)
        used = n.sum() - n
        live = sd > 0  # a column that is constant outside a fold keeps the coefficient 0, as its scale is unknown
        scale = np.column_stack([np.ones(folds), np.where(live, sd, 1.0)])
        free = np.column_stack([np.ones(folds, bool), live])
        # a model for every fold and lambda, those of one fold together
        out_of, lam = np.repeat(np.arange(folds), len(lambdas)), np.tile(lambdas, folds)
        betas, losses = np.zeros((len(lam), len(cols) + 1)), np.zeros(len(lam))
        open_ = np.flatnonzero(used[out_of] > 0)
        change = 0.0
        for _ in range(MAX_STEPS):
            if not len(open_):
                break
            fold = out_of[open_]
            losses[open_], g, h = _pass(data, betas[open_], fold)
            penalty = lam[open_, None] * scale[fold] ** 2
            penalty[:, 0] = 0.0
            grad = np.where(free[fold], g / used[fold, None] + penalty * betas[open_], 0.0)
            hess = h / used[fold, None, None] + np.einsum("ij,jk->ijk", penalty + 1e-12, np.eye(len(cols) + 1))
            both = free[fold][:, :, None] & free[fold][:, None, :]
            hess = np.where(both, hess, np.eye(len(cols) + 1))
            step = np.linalg.solve(hess, grad[:, :, None])[:, :, 0]
            size = np.abs(step * scale[fold]).max(axis=1)
            betas[open_] -= step * np.minimum(1.0, MAX_CHANGE / np.maximum(size, 1e-300))[:, None]
            change = float(size.max())
            open_ = open_[size >= TOLERANCE]
        if len(open_):
            raise RuntimeError(f"lambda {lam[open_].min():g} has not settled after {MAX_STEPS} passes (last change {change:g})")
    finally:
        data.unpersist()
    held = n > 0
    means = losses.reshape(folds, -1)[held] / n[held, None]
    weight, k = n[held, None] / n.sum(), int(held.sum())
    mean = (weight * means).sum(0)
    spread = (weight * (means - mean) ** 2).sum(0)
    table = [{"lambda": x, "mean_logloss": float(m), "se_logloss": math.sqrt(s / max(k - 1, 1)), "folds": k}
             for x, m, s in zip(lambdas, mean, spread)]
    return table, lambdas, rows


def choose_lambdas(table: list[dict]) -> tuple[float, float]:
    """lambda.min (lowest mean loss) and lambda.1se (largest lambda within one standard error of it)."""
    best = min(table, key=lambda r: (r["mean_logloss"], -r["lambda"]))
    limit = best["mean_logloss"] + best["se_logloss"]
    one_se = max(r["lambda"] for r in table if r["mean_logloss"] <= limit)
    return best["lambda"], one_se


def _as_stored(spark: SparkSession, model: PipelineModel) -> PipelineModel:
    """The model stored and read back. A fitted one keeps its training summary, and with that the session, which
    goes into the tasks that score and can't once the session has observed a query."""
    path = scratch_path(spark, "model")
    model.write().save(path)
    try:
        return PipelineModel.load(path)
    finally:
        delete_path(spark, path)


def fit_ridge(design: DataFrame, lam: float, label: str = "is_low_review",
              terms: list[str] | None = None) -> PipelineModel:
    """The model at one lambda; raises if the optimiser stops at its limit of iterations."""
    cols = [term_column(t) for t in (terms or FEATURE_TERMS)]
    pipe = Pipeline(stages=[VectorAssembler(inputCols=cols, outputCol="features"), _lr(lam, label)])
    data = design.select(label, *cols).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model = pipe.fit(data)
        done = model.stages[-1].summary.totalIterations
        if done >= MAX_ITERATIONS:
            raise RuntimeError(f"the fit at lambda {lam:g} has not settled after {done} iterations")
        return _as_stored(design.sparkSession, model)
    finally:
        data.unpersist()


def train_ridge(design: DataFrame, label: str = "is_low_review", terms: list[str] | None = None,
                use: str = "lambda.1se", **cv_args) -> tuple[RidgeModel, RidgeModel]:
    """Cross-validate, then fit on all of ``design`` at lambda.1se and at lambda.min.
    Returns (model at ``use``, model at the other lambda)."""
    terms = list(terms or FEATURE_TERMS)
    table, _, _ = cross_validate(design, label, terms, **cv_args)
    lmin, l1se = choose_lambdas(table)
    for r in table:
        r["is_min"] = r["lambda"] == lmin
        r["is_1se"] = r["lambda"] == l1se
    p1 = fit_ridge(design, l1se, label, terms)
    p0 = p1 if lmin == l1se else fit_ridge(design, lmin, label, terms)
    m1 = RidgeModel(terms, p1, l1se, lmin, l1se, cv=table)
    m0 = RidgeModel(terms, p0, lmin, lmin, l1se, cv=table)
    return (m1, m0) if use == "lambda.1se" else (m0, m1)


def cv_table(spark: SparkSession, model: RidgeModel) -> DataFrame:
    rows = [(r["lambda"], r["mean_logloss"], r["se_logloss"], int(r["folds"]), bool(r.get("is_min")),
             bool(r.get("is_1se"))) for r in model.cv]
    return spark.createDataFrame(
        rows, "lambda double, mean_logloss double, se_logloss double, folds int, is_min boolean, is_1se boolean")
