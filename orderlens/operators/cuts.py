"""Tiles by exact cut keys: NTILE over a whole table without sorting or moving its rows.

NTILE(k) needs the keys of k - 1 rows only, the last ones of its first k - 1 tiles. They are found by bracketed
selection on the composite key (value, unique tie-break): an approximate percentile brackets each wanted rank, counts
place the bracket, and the next round looks inside it only. A rank that falls on one heavy value goes on among
that value's rows, by the tie-break, six bytes of it at a time. All ranks of all columns share a round (two
aggregations over the stored frame) until few enough rows are left to read. One projection then compares
every row with the cut keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.operators import rank
from orderlens.session import checkpoint_dir

#: bytes of a text key that fit a double exactly
CHUNK = 6
ACCURACY = 10_000


def _numbers(c: Column, kind: T.DataType) -> list[Column]:
    """Numbers that order, one after the other, as the column does; each is exact as a double, as percentiles need it."""
    if isinstance(kind, T.DecimalType) and kind.precision > 15:
        unit = Decimal(10) ** (15 - kind.scale)
        high = F.floor(c / F.lit(unit)).cast(T.DecimalType(min(38, kind.precision), 0))
        return [*_numbers(high, T.DecimalType(max(1, kind.precision - 15), 0)), (c - high * F.lit(unit)).cast(T.DecimalType(16, max(kind.scale, 0)))]
    if isinstance(kind, T.LongType):
        return [F.shiftright(c, 32), c.bitwiseAND(F.lit(0xFFFFFFFF))]
    if isinstance(kind, T.NumericType):
        return [c]
    if isinstance(kind, T.DateType):
        return [F.datediff(c, F.lit("1970-01-01").cast("date"))]
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return _numbers(F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast(kind), c), T.LongType())
    raise TypeError(f"tiles need numbers, dates or timestamps, not {kind.simpleString()}")


def _value_parts(df: DataFrame, value: str) -> list[Column]:
    """Numbers that are never NULL and order as the value does, NULL last."""
    v = F.col(value)
    return [F.when(v.isNull(), 1).otherwise(0)] + [F.coalesce(c, F.lit(0)) for c in _numbers(v, df.schema[value].dataType)]


def _tie_parts(df: DataFrame, tie: str, tie_bytes: int) -> list[Column]:
    if not isinstance(df.schema[tie].dataType, T.StringType):
        return _numbers(F.col(tie), df.schema[tie].dataType)
    raw = F.col(tie).cast("binary")
    chunks = [F.conv(F.rpad(F.hex(F.substring(raw, at + 1, CHUNK)), 2 * CHUNK, "0"), 16, 10).cast("double")
              for at in range(0, max(tie_bytes, 1), CHUNK)]
    return chunks + [F.length(raw)]  # texts that are equal when filled up with zero bytes: the shorter first


@dataclass
class _Wanted:
    """One rank on its way: ``below`` rows come before all of the ``inside`` rows that are still looked at."""
    value: str
    at: int
    below: int
    inside: int
    prefix: list = field(default_factory=list)
    low: object = None
    high: object = None

    def where(self, parts: list[Column], low=None, high=None) -> Column:
        c = F.lit(True)
        for p, x in zip(parts, self.prefix):
            c = c & (p == F.lit(x))
        here = parts[len(self.prefix)]
        for bound, op in ((self.low if low is None else low, Column.__gt__), (self.high if high is None else high, Column.__lt__)):
            if bound is not None:
                c = c & op(here, F.lit(bound))
        return c


def keys_at(df: DataFrame, ranks: Mapping[str, Sequence[int]], tie: str, rows: int, tie_bytes: int) -> dict[tuple[str, int], tuple]:
    """(value column, 0-based rank) -> (value, tie) of the row at that rank by (value ascending, NULL last; tie). ``df`` should
    be stored; ``tie`` must be unique and not NULL."""
    # the parts of all keys are stored once, so that the rounds compare plain numbers
    made = {f"_v{i}_{j}": c for i, v in enumerate(ranks) for j, c in enumerate(_value_parts(df, v))}
    ties = {f"_t{j}": c for j, c in enumerate(_tie_parts(df, tie, tie_bytes))}
    df = df.select(*[F.col(v) for v in ranks], F.col(tie), *[c.alias(n) for n, c in (made | ties).items()]).checkpoint(eager=True)
    ends = df.agg(*[f(n).alias(f"{n}_{k}") for n in made | ties for k, f in enumerate((F.min, F.max))]).first()
    told = [n for n in made | ties if ends[f"{n}_0"] != ends[f"{n}_1"]]  # a part that is the same in all rows orders nothing
    parts = {v: [F.col(n) for n in told if n in ties or n.startswith(f"_v{i}_")] or [F.lit(0)] for i, v in enumerate(ranks)}
    todo = [_Wanted(v, r, 0, rows) for v, rs in ranks.items() for r in rs]
    small: list[_Wanted] = []
    margin = 2.0 / ACCURACY
    while True:
        small += [w for w in todo if w.inside <= rank.BRACKET_VALUES]
        todo = [w for w in todo if w.inside > rank.BRACKET_VALUES]
        if not todo:
            break
        here = [parts[w.value][len(w.prefix)] for w in todo]
        cuts = df.agg(*[F.percentile_approx(F.when(w.where(parts[w.value]), c), [
            max(0.0, (w.at - w.below) / w.inside - margin), min(1.0, (w.at - w.below + 1) / w.inside + margin)], ACCURACY).alias(f"q{k}")
            for k, (w, c) in enumerate(zip(todo, here))]).first()
        counts = []
        for k, (w, c) in enumerate(zip(todo, here)):
            low, high = cuts[f"q{k}"]
            inside = w.where(parts[w.value])
            counts += [F.count_if(inside & x).alias(f"{name}{k}") for name, x in (
                ("below", c < F.lit(low)), ("low", c <= F.lit(low)), ("under", c < F.lit(high)), ("high", c <= F.lit(high)))]
        got = df.agg(*counts).first()
        for k, w in enumerate(todo):
            low, high = cuts[f"q{k}"]
            below, upto_low, under, upto_high = (w.below + got[f"{name}{k}"] for name in ("below", "low", "under", "high"))
            end, before = w.below + w.inside, (len(w.prefix), w.inside)
            if w.at < below:  # the approximation missed: what lies below the bracket
                w.high, w.inside = low, below - w.below
            elif w.at < upto_low:
                w.prefix, w.low, w.high, w.below, w.inside = [*w.prefix, low], None, None, below, upto_low - below
            elif w.at < under:
                w.low, w.high, w.below, w.inside = low, high, upto_low, under - upto_low
            elif w.at < upto_high:
                w.prefix, w.low, w.high, w.below, w.inside = [*w.prefix, high], None, None, under, upto_high - under
            else:
                w.low, w.below, w.inside = high, upto_high, end - upto_high
            if (len(w.prefix), w.inside) == before:
                raise RuntimeError(f"{w.value}: the bracket of rank {w.at} does not shrink")
    found = {}
    if not small:
        return found
    # at most BRACKET_VALUES rows for each rank come to the driver, in one job for all columns
    place = {v: f"_s{i}" for i, v in enumerate(ranks)}
    of_value = {v: [k for k, w in enumerate(small) if w.value == v] for v in ranks}
    hits = F.filter(F.array(*[F.when(w.where(parts[w.value]), F.lit(k)) for k, w in enumerate(small)]), lambda k: k.isNotNull())
    read = df.select(F.explode(hits).alias("_k"), F.col(tie).alias("_t"), *[
        F.struct(F.col(v).alias("v"), *[c.alias(f"c{j}") for j, c in enumerate(parts[v])]).alias(s) for v, s in place.items()])
    read = read.select("_k", "_t", *[F.when(F.col("_k").isin(of_value[v]), F.col(s)).alias(s) for v, s in place.items()])
    of = {k: [] for k in range(len(small))}
    for r in read.collect():
        of[r["_k"]].append((r["_t"], r[place[small[r["_k"]].value]]))
    for k, w in enumerate(small):
        tied, row = sorted(of[k], key=lambda r: tuple((x != x, 0 if x != x else x) for x in r[1][1:]))[w.at - w.below]
        found[w.value, w.at] = row[0], tied
    return found


def beyond(value: str, tie: str, key: tuple) -> Column:
    """Does a row come after ``key`` by (value ascending, NULL last; tie)?"""
    v, t = F.col(value), F.col(tie)
    at, after = key
    if at is None:
        return v.isNull() & (t > F.lit(after))
    return v.isNull() | (v > F.lit(at)) | ((v == F.lit(at)) & (t > F.lit(after)))


def ntiles(df: DataFrame, tiles: Mapping[str, str], tie: str, k: int, stage_input: bool = True) -> DataFrame:
    """``df`` with ``NTILE(k) OVER (ORDER BY value ASC NULLS LAST, tie)`` for every output name -> value column.

    ``tie`` is unique and not NULL. The input is checkpointed first unless it is stored (it is read several times). An empty
    input stays empty; with fewer rows than tiles the last tiles have none.
    """
    if stage_input:
        checkpoint_dir(df.sparkSession)
        df = df.checkpoint(eager=True)
    text = isinstance(df.schema[tie].dataType, T.StringType)
    n, width = df.agg(F.count(F.lit(1)), F.max(F.length(F.col(tie).cast("binary"))) if text else F.lit(0)).first()
    size, more = divmod(n, k)
    ends = [t * size + min(t, more) for t in range(1, k)]
    ranks = sorted({e - 1 for e in ends if 0 < e < n})
    keys = keys_at(df, {v: ranks for v in tiles.values()}, tie, n, width or 0) if ranks else {}
    out = {}
    for name, value in tiles.items():
        tile = F.lit(1)
        for r in ranks:
            tile = tile + F.when(beyond(value, tie, keys[value, r]), 1).otherwise(0)
        out[name] = tile.cast("int")
    return df.select("*", *[c.alias(name) for name, c in out.items()])
