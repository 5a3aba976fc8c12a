"""Keyed table maintenance: insert-if-absent, upsert merge, latest row per key, duplicate keys.

All are aggregations or anti-joins on the key, so they partition by the key and pre-aggregate
map-side; a hot key never brings its rows into one task as a list.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def one_per_key(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Keep one row per key, deterministically: the smallest row by the remaining columns in order.

    A ``min`` over a struct is a partial aggregate, so duplicates collapse map-side. Spark plans it as a
    sort aggregate (a struct is no fixed-width buffer): one sort by the key on each side of the one shuffle.
    """
    keys = _keys(key)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates(keys)
    picked = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row"))
    return picked.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*df.columns)


def insert_if_absent_rows(existing: DataFrame, incoming: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rows of ``incoming`` to append so that existing keys are kept as they are (ON CONFLICT DO NOTHING).

    Incoming rows with a NULL key are dropped; several incoming rows for one new key give one row.
    """
    keys = _keys(key)
    inc = incoming.select(*existing.columns).dropna(subset=keys)
    fresh = inc.join(existing.select(*keys), keys, "left_anti")
    return one_per_key(fresh, keys)


def insert_if_absent(existing: DataFrame, incoming: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """The whole table after an insert-if-absent load."""
    return existing.unionByName(insert_if_absent_rows(existing, incoming, key))


def upsert_merge(existing: DataFrame, incoming: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """The whole table after an upsert: incoming rows replace existing rows with the same key.

    ``incoming`` must hold one row per key (it is the batch being written).
    """
    keys = _keys(key)
    kept = existing.join(incoming.select(*keys), keys, "left_anti")
    return kept.unionByName(incoming.select(*existing.columns))


def latest_per_key(df: DataFrame, key: str | Sequence[str], order_col: str,
                   columns: Sequence[str] | None = None) -> DataFrame:
    """The row with the greatest ``order_col`` per key (DISTINCT ON … ORDER BY order_col DESC).

    The greatest value per key is a hash aggregation of two narrow columns, joined back to the rows on
    key and value; nothing is sorted by anything else. ``(key, order_col)`` must be unique, as it is in
    a table that is upserted by them. Rows with a NULL key or ``order_col`` are left out.
    """
    keys = _keys(key)
    cols = [c for c in (columns or df.columns) if c not in keys]
    best = df.groupBy(*keys).agg(F.max(order_col).alias(order_col))
    return df.join(best, [*keys, order_col]).select(*keys, *cols)


def duplicate_keys(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    keys = _keys(key)
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows_cnt"))
            .filter(F.col("rows_cnt") > 1))
