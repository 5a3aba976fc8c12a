"""Exact percentiles of many groups at once, for continuous values and groups of any size.

Spark's ``percentile`` keeps a map from value to count for each group, in one task: fine for whole days, not for fractions of
a day where one group holds a third of the rows. Here all groups are searched together. A bracket of values is cut into
equal cells; the rows inside are counted per (group, cell), map side first; the cell that holds the wanted rank becomes the
next bracket, with the smallest and largest value found in it. These differ from the old ones unless a single
value is left, so every round gets nearer. A round is one join to the brackets and one aggregation.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.session import checkpoint_dir

#: cells of a bracket: the rows of one group that leave a task in a round, at most
CELLS = 1024
#: brackets that are sent to all tasks; more are joined by a shuffle, which AQE splits where a group is large
BROADCAST_BRACKETS = 100_000
MAX_ROUNDS = 400


def grouped_percentiles(df: DataFrame, groups: Sequence[str], values: Mapping[str, Column], outputs: Mapping[str, tuple[str, float]],
                        stage_input: bool = True) -> DataFrame:
    """Per group, linearly interpolated percentiles (``percentile_cont``): one row per group of ``df``, ``groups`` and one double
    column per output.

    ``values``: name -> numeric column; use ``F.when(condition, column)`` for a percentile over some of the rows.
    ``outputs``: column -> (value name, probability). NULL values are left out; a group without values has NULL. A NULL group
    is a group like any other. NaN counts as the largest value, as in Spark's order; infinities are values. The input is
    checkpointed unless it is stored (every round reads it).
    """
    checkpoint_dir(df.sparkSession)
    keys = [f"_g{k}" for k in range(len(groups))]
    names = list(values)
    each = F.array(*[F.struct(F.lit(k).alias("m"), values[n].cast("double").alias("v")) for k, n in enumerate(names)])
    rows = df.select(*[F.col(g).alias(k) for g, k in zip(groups, keys)], F.explode(each).alias("_e")).select(
        *keys, F.col("_e.m").alias("_m"), F.col("_e.v").alias("_v"))
    rows = rows.checkpoint(eager=True) if stage_input else rows
    by = [*keys, "_m"]
    # NaN and the infinities are told apart by a rank of their kind, so that cells are cut between finite numbers only
    kind = F.when(F.isnan("_v"), 2).when(F.col("_v") == float("inf"), 1).when(F.col("_v") == float("-inf"), -1).otherwise(0)
    found = rows.filter(F.col("_v").isNotNull()).withColumn("_k", kind)
    # the cells of the first round are the kinds; finite values are in one bracket from their least to their greatest
    size = found.groupBy(*by, "_k").agg(F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    upto = Window.partitionBy(*by).orderBy("_k")
    every = Window.partitionBy(*by)
    first = size.select(*by, "_c", "_lo", "_hi", (F.sum("_c").over(upto) - F.col("_c")).alias("_below"), F.sum("_c").over(every).alias("_n"))
    wanted = F.array(*[F.struct(F.lit(names.index(v)).alias("m"), (F.lit(float(p)) * (F.col("_n") - 1)).alias("h")) for v, p in outputs.values()])
    ranks = F.array_distinct(F.flatten(F.transform(F.filter(wanted, lambda w: w["m"] == F.col("_m")), lambda w: F.array(
        F.floor(w["h"]), F.ceil(w["h"])))))
    state = first.withColumn("_r", F.explode(ranks)).filter(
        (F.col("_r") >= F.col("_below")) & (F.col("_r") < F.col("_below") + F.col("_c"))).select(*by, "_lo", "_hi", "_below", "_r")
    state = state.checkpoint(eager=True)
    finite = found.filter("_k = 0").select(*by, "_v")
    for _ in range(MAX_ROUNDS):
        still = state.filter(F.col("_lo") < F.col("_hi"))
        brackets = still.select(*by, "_lo", "_hi", "_below").distinct()
        n = brackets.count()
        if not n:
            break
        state = state.filter(~(F.col("_lo") < F.col("_hi"))).unionByName(_round(finite, brackets, still, by, n)).checkpoint(eager=True)
    else:
        raise RuntimeError(f"percentiles have not settled after {MAX_ROUNDS} rounds")
    return _interpolated(rows, state, first, groups, keys, names, outputs)


def _same(a: DataFrame, b: DataFrame, by: Sequence[str]) -> Column:
    out = F.lit(True)
    for c in by:
        out = out & a[c].eqNullSafe(b[c])
    return out


def _round(finite: DataFrame, brackets: DataFrame, still: DataFrame, by: list[str], n: int) -> DataFrame:
    """The open ranks, each in the cell of its bracket that holds it."""
    few = n <= BROADCAST_BRACKETS
    b = brackets.select(*[F.col(c).alias(f"b{c}") for c in brackets.columns])
    b = F.broadcast(b) if few else b
    on = F.lit(True)
    for c in by:
        on = on & finite[c].eqNullSafe(b[f"b{c}"])
    inside = finite.join(b, on & (F.col("_v") >= F.col("b_lo")) & (F.col("_v") <= F.col("b_hi")))
    # halves first: the width of a bracket may be beyond the largest double
    part = (F.col("_v") / 2 - F.col("b_lo") / 2) / (F.col("b_hi") / 2 - F.col("b_lo") / 2)
    # the least value in the first cell and the greatest in the last, however the division rounds
    cell = F.when(F.col("_v") == F.col("b_hi"), CELLS).otherwise(F.least(F.floor(part * CELLS), F.lit(CELLS - 1)))
    cells = inside.groupBy(*by, "b_lo", "b_below", cell.alias("_cell")).agg(
        F.count(F.lit(1)).alias("_c"), F.min("_v").alias("n_lo"), F.max("_v").alias("n_hi"))
    upto = Window.partitionBy(*by, "b_lo").orderBy("_cell")  # CELLS + 1 rows a bracket at most
    placed = cells.select(*[F.col(c).alias(f"p{c}") for c in by], "b_lo", "n_lo", "n_hi", "_c",
                          (F.col("b_below") + F.sum("_c").over(upto) - F.col("_c")).alias("n_below"))
    on = still["_lo"] == placed["b_lo"]
    for c in by:
        on = on & still[c].eqNullSafe(placed[f"p{c}"])
    on = on & (F.col("_r") >= F.col("n_below")) & (F.col("_r") < F.col("n_below") + F.col("_c"))
    return still.join(placed, on).select(*by, F.col("n_lo").alias("_lo"), F.col("n_hi").alias("_hi"), F.col("n_below").alias("_below"), "_r")


def _interpolated(rows, state, first, groups, keys, names, outputs) -> DataFrame:
    by = [*keys, "_m"]
    sizes = first.select(*by, "_n").distinct()
    at = state.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("_r", "_lo"))).alias("_at"))  # a few ranks each
    at = at.select(*[F.col(c).alias(f"a{c}") for c in by], "_at")
    on = F.lit(True)
    for c in by:
        on = on & sizes[c].eqNullSafe(at[f"a{c}"])
    joined = sizes.join(at, on)
    cols = []
    for out, (value, p) in outputs.items():
        h = F.lit(float(p)) * (F.col("_n") - 1)
        low, high = F.element_at("_at", F.floor(h)), F.element_at("_at", F.ceil(h))
        # equal ends are not mixed: between infinities that would be no number
        mixed = F.when(low == high, low).otherwise(low + (high - low) * (h - F.floor(h)))
        cols.append(F.max(F.when(F.col("_m") == names.index(value), mixed)).alias(out))
    found = joined.groupBy(*keys).agg(*cols)
    all_groups = rows.select(*keys).distinct()
    return all_groups.join(found, _same(all_groups, found, keys), "left").select(
        *[all_groups[k].alias(g) for g, k in zip(groups, keys)], *outputs)
