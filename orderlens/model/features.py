"""Model input: exact train/test split, design matrix with treatment contrasts, column alignment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.operators.rank import global_row_number, order_statistics
from orderlens.schema import DELAY_BUCKET_LEVELS, MONTH_LEVELS, NUMERIC_FEATURES, SPLIT_SEED, TRAIN_FRACTION
from orderlens.session import checkpoint_dir


def term_column(term: str) -> str:
    """DataFrame column name of a design term (``delay_bucket1-3`` -> ``delay_bucket1_3``)."""
    return term.replace("-", "_")


def design_terms(buckets: Sequence[str] = DELAY_BUCKET_LEVELS,
                 months: Sequence[int] = MONTH_LEVELS) -> list[str]:
    """Term names in design order: bucket levels after the baseline, numeric features, months after the
    first. The first level of each factor is the baseline and has no column."""
    return ([f"delay_bucket{b}" for b in buckets[1:]] + list(NUMERIC_FEATURES)
            + [f"month{m}" for m in months[1:]])


FEATURE_TERMS = design_terms()
FEATURE_COLUMNS = [term_column(t) for t in FEATURE_TERMS]


def _term_expr(term: str) -> Column:
    if term.startswith("delay_bucket"):
        return F.when(F.col("delay_bucket") == term[len("delay_bucket"):], 1.0).otherwise(0.0)
    if term.startswith("month"):
        return F.when(F.col("month") == int(term[len("month"):]), 1.0).otherwise(0.0)
    return F.col(term).cast("double")


def design_matrix(cohort: DataFrame, terms: Sequence[str] = FEATURE_TERMS,
                  keep: Sequence[str] = ("order_id",)) -> DataFrame:
    """One double column per term (indicator columns for factor levels), plus the ``keep`` columns.

    A row with an unknown factor value has zeros in all that factor's columns, like the baseline; callers
    reject such rows first with :func:`check_levels`, as the runner does.
    """
    return cohort.select(*keep, *[_term_expr(t).alias(term_column(t)) for t in terms])


def observed_terms(buckets: Sequence[str], months: Sequence[int]) -> list[str]:
    """The terms of a batch in which only these levels occur. The baselines are the declared first
    levels, whether they occur or not: no other level loses its column to them."""
    return [t for t in FEATURE_TERMS
            if not (t.startswith("delay_bucket") and t[len("delay_bucket"):] not in set(buckets)
                    or t.startswith("month") and int(t[len("month"):]) not in set(months))]


def check_levels(cohort: DataFrame) -> None:
    """Raise when a row has a bucket or month that is NULL or not a known level (a data error upstream)."""
    bucket, month = F.col("delay_bucket"), F.col("month")
    unknown = (bucket.isNull() | ~bucket.isin(list(DELAY_BUCKET_LEVELS)) | month.isNull() | ~month.isin(list(MONTH_LEVELS)))
    found = cohort.agg(F.count_if(unknown).alias("rows"), F.min(F.when(unknown, bucket)).alias("bucket"),
                       F.min(F.when(unknown, month)).alias("month")).first()
    if found["rows"]:
        raise ValueError(f"{found['rows']} cohort rows with NULL or unknown factor levels "
                         f"(for example bucket {found['bucket']!r}, month {found['month']!r})")


def align_columns(design: DataFrame, terms: Sequence[str], keep: Sequence[str] = ("order_id",)) -> DataFrame:
    """Conform a design matrix to a model's term list: missing terms become 0, extra ones are
    dropped, and the order is the model's."""
    have = set(design.columns)
    cols = []
    for t in terms:
        c = term_column(t)
        cols.append(F.col(c).cast("double").alias(c) if c in have else F.lit(0.0).alias(c))
    return design.select(*keep, *cols)


def split_key(order_id: Column | str, seed: int = SPLIT_SEED) -> Column:
    """Pseudo-random but reproducible order of rows: md5 of the id and the seed."""
    oid = F.col(order_id) if isinstance(order_id, str) else order_id
    return F.md5(F.concat(oid.cast("string"), F.lit(str(seed))))


def train_test_split(cohort: DataFrame, fraction: float = TRAIN_FRACTION, seed: int = SPLIT_SEED,
                     id_col: str = "order_id", num_partitions: int | None = None) -> DataFrame:
    """Adds ``split`` = 'train' for exactly floor(fraction * n) rows, 'test' for the rest.

    The training rows are the first by ``md5(id || seed)`` (NULL first, ties by id), so the sizes are exact
    (``randomSplit`` only gets them approximately). Nothing is sorted: the first 48 bits of the key at the last training
    row are found by bracketed selection over the stored rows, and only the rows that have the same 48 bits are numbered.
    """
    checkpoint_dir(cohort.sparkSession)
    key = split_key(id_col, seed)
    bits = F.coalesce(F.conv(F.substring(key, 1, 12), 16, 10).cast("double"), F.lit(-1.0))  # exact as a double
    stored = cohort.withColumn("_split_bits", bits).checkpoint(eager=True)
    n = stored.count()
    n_train = int(fraction * n // 1)
    at = F.col("_split_bits")
    if not 0 < n_train < n:
        return stored.select(*cohort.columns, F.lit("train" if n_train else "test").alias("split"))
    cut = F.lit(order_statistics(stored, "_split_bits", [n_train - 1], n)[n_train - 1])
    before, same = stored.agg(F.count_if(at < cut), F.count_if(at == cut)).first()
    if before + same == n_train:
        return stored.select(*cohort.columns, F.when(at <= cut, "train").otherwise("test").alias("split"))
    tied, _ = global_row_number(stored.filter(at == cut).withColumn("_split_key", key),
                                [F.col("_split_key").asc(), F.col(id_col).asc()], "_split_rn", num_partitions)
    clear = stored.filter(at != cut).select(*cohort.columns, F.when(at < cut, "train").otherwise("test").alias("split"))
    return clear.unionByName(tied.select(
        *cohort.columns, F.when(F.col("_split_rn") <= n_train - before, "train").otherwise("test").alias("split")))
