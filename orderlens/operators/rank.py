"""Global ordering operators without a single-partition window, and exact order statistics without a sort.

A plain ``Window.orderBy`` (NTILE, ROW_NUMBER, cumulative sums, exact quantiles of a continuous
column) makes Catalyst plan ``Exchange SinglePartition``: the whole table in one task. Here the
table is range-partitioned on a *total* order (the caller's sort columns end with a unique key),
sorted within partitions and checkpointed to the session's reliable checkpoint folder, so the
layout cannot change between the counting job and the numbering job, even if an executor is lost
and the data has to be re-read. Only one small row per partition (its count or sums) reaches the
driver; each row's global position is its partition's offset plus its position in the partition.
A hot sort value is spread over many partitions by the unique tie-break.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.session import checkpoint_dir

_PID = "_rank_pid"
_POS = "_rank_pos"


def _sort_cols(order: Sequence[Column | str]) -> list[Column]:
    out = []
    for c in order:
        out.append(F.col(c).asc_nulls_last() if isinstance(c, str) else c)
    return out


def _partitions(df: DataFrame, num_partitions: int | None) -> int:
    """Range partitions: as many as the (staged) input has, at least the cluster's cores. The staged
    input's partitions come out of AQE's coalescing at the advisory size (or from the files), so the count follows the data volume, without an upper bound."""
    if num_partitions:
        return num_partitions
    spark = df.sparkSession
    return max(1, spark.sparkContext.defaultParallelism, df.rdd.getNumPartitions())


def range_sorted(df: DataFrame, order: Sequence[Column | str], num_partitions: int | None = None,
                 stage_input: bool = True) -> DataFrame:
    """Range-partition and sort within partitions on ``order``, then checkpoint (reliable, eager).

    The range partitioner samples its input in a job of its own before the shuffle reads it again,
    so by default the input is checkpointed first: the upstream plan runs once, and both the sampling
    and the shuffle read the stored rows. Pass ``stage_input=False`` when the input is already cheap
    to read (a checkpoint, or a narrow plan over one).
    """
    checkpoint_dir(df.sparkSession)
    cols = _sort_cols(order)
    stored = df.checkpoint(eager=True) if stage_input else df
    n = _partitions(stored, num_partitions)
    return stored.repartitionByRange(n, *cols).sortWithinPartitions(*cols).checkpoint(eager=True)


def _offsets(staged: DataFrame, sums: Sequence[str] = ()) -> tuple[DataFrame, dict[str, int | float], list[tuple]]:
    """Per-partition exclusive prefix of row counts (and of ``sums``), as a small frame keyed by
    partition id, the grand totals, and the same prefixes as rows. One row per partition is collected."""
    aggs = [F.count(F.lit(1)).alias("_n")] + [F.sum(c).alias(c) for c in sums]
    per = staged.groupBy(F.spark_partition_id().alias(_PID)).agg(*aggs).collect()
    per = sorted(per, key=lambda r: r[_PID])
    running = {"_n": 0, **{c: 0 for c in sums}}
    rows = []
    for r in per:
        rows.append((r[_PID], *[running[k] for k in running]))
        for k in running:
            running[k] += r[k] or 0
    fields = [T.StructField(_PID, T.IntegerType())] + [T.StructField("_off_n", T.LongType())]
    for c in sums:
        dt = staged.schema[c].dataType
        fields.append(T.StructField(f"_off_{c}", T.LongType() if isinstance(dt, T.IntegralType) else T.DoubleType()))
    rows = [tuple(v if i < 2 or isinstance(fields[i].dataType, T.LongType) else float(v)
                  for i, v in enumerate(row)) for row in rows]
    off = staged.sparkSession.createDataFrame(rows, T.StructType(fields))
    return off, running, rows


def global_row_number(df: DataFrame, order: Sequence[Column | str], out: str = "row_num",
                      num_partitions: int | None = None, stage_input: bool = True) -> tuple[DataFrame, int]:
    """1-based position of each row in ``order`` (which must be a total order), and the row count."""
    staged = range_sorted(df, order, num_partitions, stage_input)
    off, totals, _ = _offsets(staged)
    pid = F.spark_partition_id()
    local = staged.select("*", pid.alias(_PID),
                          (F.monotonically_increasing_id() - F.shiftleft(pid.cast("long"), 33)).alias(_POS))
    # one row per partition: a proven size bound for the broadcast
    numbered = local.join(F.broadcast(off), _PID, "inner")
    res = numbered.select(*df.columns, (F.col("_off_n") + F.col(_POS) + 1).alias(out))
    return res, int(totals["_n"])


def ntile_of(row_num: Column, n: int, k: int) -> Column:
    """NTILE(k) bucket of a 1-based row number among n rows: sizes differ by at most one, larger first."""
    q, r = divmod(n, k)
    big = r * (q + 1)
    head = F.floor((row_num - 1) / F.lit(q + 1)) + 1
    tail = F.floor((row_num - 1 - F.lit(big)) / F.lit(max(q, 1))) + 1 + F.lit(r)
    return F.when(row_num <= F.lit(big), head).otherwise(tail).cast("int")


def global_ntile(df: DataFrame, order: Sequence[Column | str], k: int, out: str,
                 num_partitions: int | None = None, stage_input: bool = True) -> DataFrame:
    """``NTILE(k) OVER (ORDER BY order)`` without a single-partition window."""
    numbered, n = global_row_number(df, order, "_rank_rn", num_partitions, stage_input)
    return numbered.select(*df.columns, ntile_of(F.col("_rank_rn"), n, k).alias(out))


#: distinct values of a bracket that may come to the driver
BRACKET_VALUES = 10_000


def order_statistics(df: DataFrame, value: str, ranks: Sequence[int], rows: int) -> dict[int, float]:
    """The values at 0-based ``ranks`` of the ``rows`` non-NULL values of a double column, exactly.

    Nothing is sorted as a whole: an approximate percentile brackets each rank, counts tell how many rows
    lie below the bracket, and the next round looks inside it only, until a bracket is a single value
    or has at most ``BRACKET_VALUES`` rows, whose distinct values are then read. The rows at a bracket's end
    values are counted: a rank among them is found, else they leave the bracket, so every round takes at
    least two values out, however heavy. Each round narrows a bracket to a few ten-thousandths and is two
    aggregations over ``df`` (which should be stored).
    """
    v = F.col(value)
    accuracy = 10_000
    found: dict[int, float] = {}
    # rank -> (value below all inside or None, value above all inside or None, rows below, rows inside)
    state = {r: (None, None, 0, rows) for r in ranks}

    def inside(lo, hi) -> Column:
        c = v.isNotNull()
        c = c if lo is None else c & (v > F.lit(lo))
        return c if hi is None else c & (v < F.lit(hi))

    while state:
        small = {r: s for r, s in state.items() if s[3] <= BRACKET_VALUES}
        for r, (lo, hi, below, _) in small.items():
            at = below
            for x, n in sorted(tuple(t) for t in df.filter(inside(lo, hi)).groupBy(v).count().collect()):
                at += n
                if r < at:
                    found[r] = x
                    break
            del state[r]
        if not state:
            break
        todo = list(state.items())
        margin = 2.0 / accuracy
        aggs = [F.percentile_approx(F.when(inside(lo, hi), v), [
            max(0.0, (r - below) / n - margin), min(1.0, (r - below + 1) / n + margin)], accuracy).alias(f"q{k}")
            for k, (r, (lo, hi, below, n)) in enumerate(todo)]
        cuts = df.agg(*aggs).first()
        counts = []
        for k in range(len(todo)):
            lo, hi = cuts[f"q{k}"]
            counts += [F.count_if(c).alias(f"{name}{k}") for name, c in (
                ("below", v < F.lit(lo)), ("low", v <= F.lit(lo)), ("under", v < F.lit(hi)), ("high", v <= F.lit(hi)))]
        got = df.agg(*counts).first()
        for k, (r, (old_lo, old_hi, old_below, old_n)) in enumerate(todo):
            lo, hi = cuts[f"q{k}"]
            below, low, under, high = (got[f"{name}{k}"] for name in ("below", "low", "under", "high"))
            if r < below:  # the approximation missed: what lies below the bracket, down to the old one
                state[r] = (old_lo, lo, old_below, below - old_below)
            elif r < low:
                found[r] = lo
            elif r < under:
                state[r] = (lo, hi, low, under - low)
            elif r < high:
                found[r] = hi
            else:
                state[r] = (hi, old_hi, high, old_below + old_n - high)
            if r in found:
                del state[r]
    return found


def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float], names: Sequence[str] | None = None,
                    stage_input: bool = True) -> DataFrame:
    """Exact linearly interpolated quantiles (``percentile_cont``, R type 7) of a continuous column.

    NULLs are ignored. Returns one row with one double column per probability (NULL if no values). See
    :func:`order_statistics`; with ``stage_input`` the column is checkpointed first, as it is read several
    times.
    """
    names = list(names or [f"p{int(round(p * 100))}" for p in probs])
    spark = df.sparkSession
    vals = df.select(F.col(value).cast("double").alias("_q_v"))
    if stage_input:
        checkpoint_dir(spark)
        vals = vals.checkpoint(eager=True)
    n = vals.agg(F.count("_q_v")).first()[0]
    schema = T.StructType([T.StructField(nm, T.DoubleType()) for nm in names])
    if n == 0:
        return spark.createDataFrame([tuple([None] * len(names))], schema)
    places = []
    for p in probs:
        h = (n - 1) * float(p)
        lo = int(h // 1)
        places.append((lo, min(lo + 1, n - 1) if h > lo else lo, h - lo))
    at = order_statistics(vals, "_q_v", sorted({k for x in places for k in x[:2]}), n)
    return spark.createDataFrame([tuple(at[lo] + part * (at[hi] - at[lo]) for lo, hi, part in places)], schema)


def global_cumsum(df: DataFrame, order: Sequence[Column | str], cols: Sequence[str],
                  prefix: str = "cum_", num_partitions: int | None = None) -> DataFrame:
    """Running (inclusive) sums of ``cols`` in ``order``, as ``prefix + col``.

    Partition totals give each partition's starting offset; the running sum inside a partition is an
    Arrow-batched pandas ``cumsum`` over the already sorted partition.
    """
    staged = range_sorted(df, order, num_partitions)
    _, _, rows = _offsets(staged, cols)
    start = {r[0]: list(r[2:]) for r in rows}  # partition id -> starting sums (one entry per partition)
    out_fields = list(staged.schema.fields) + [
        T.StructField(prefix + c, T.LongType() if isinstance(staged.schema[c].dataType, T.IntegralType)
                      else T.DoubleType()) for c in cols]
    out_schema = T.StructType(out_fields)
    cols = list(cols)

    def run(batches):
        from pyspark import TaskContext

        pid = TaskContext.get().partitionId()
        acc = list(start.get(pid, [0] * len(cols)))
        for pdf in batches:
            for i, c in enumerate(cols):
                cs = pdf[c].fillna(0).cumsum() + acc[i]
                if len(cs):
                    acc[i] = cs.iloc[-1]
                pdf[prefix + c] = cs
            yield pdf

    return staged.mapInPandas(run, out_schema)


def row_number_within(df: DataFrame, key: str, order: Sequence[Column | str], out: str,
                      num_partitions: int | None = None) -> DataFrame:
    """``ROW_NUMBER() OVER (PARTITION BY key ORDER BY order)`` without one task per key.

    The rows are ranked globally on ``(key, order…)`` (a hot key is spread over many range
    partitions); a key's number is its global position minus the key's first position plus one.
    The first positions are a per-key ``min`` (partial aggregate, one row per key) joined back on the
    key, a join AQE can split when one key is large. Rows tied on the whole order get consecutive
    numbers in the order the staged input stored them, as a window would give them in arbitrary order.
    """
    tie = "_rw_tie"
    staged = df.withColumn(tie, F.monotonically_increasing_id()).checkpoint(eager=True)
    sort = [F.col(key).asc_nulls_last(), *_sort_cols(order), F.col(tie).asc()]
    numbered, _ = global_row_number(staged, sort, "_rw_rn", num_partitions, stage_input=False)
    first = numbered.groupBy(key).agg(F.min("_rw_rn").alias("_rw_first"))
    j = numbered.join(first, key, "inner") if df.schema[key].nullable is False else \
        numbered.join(first, numbered[key].eqNullSafe(first[key]), "inner").drop(first[key])
    return j.select(*df.columns, (F.col("_rw_rn") - F.col("_rw_first") + 1).cast("int").alias(out))
