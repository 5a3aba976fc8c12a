"""Mixing sources to target weights, in DataFrame operations only.

Tokens are aggregated per source; each source's target comes from its weight; its repetition rate is
target / size. A document is emitted floor(rate) times plus one copy with probability equal to the
fraction, drawn from a hash of the seed, the document's id and text, and its number among equal rows (same
id, source and text), so that reruns agree and rows that share an id, or have none, are drawn one by one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import cut, read, unit_hash, words_of
from orderlens.operators.rank import global_row_number

WEIGHTS = (5, 2, 1)
MAX_RATE = 3
SEED = 42
#: sources up to which the table of rates (three numbers each) is sent to every task
BROADCAST_SOURCES = 100_000
#: equal rows that one task numbers
RUN_ROWS = 4_096


def word_count(text: Column) -> Column:
    return F.size(words_of(text)).cast("long")


def ranked_sources(sources: DataFrame, weights=WEIGHTS) -> DataFrame:
    """Weights dealt in turn to the sources in code point order, NULL last.

    The order is over one row per source, ranked by range partitions instead of in one task.
    """
    parts = sources.sparkSession.sparkContext.defaultParallelism
    ranked, _ = global_row_number(sources, [F.col("source").asc_nulls_last()], "_turn", parts)
    turn = ((F.col("_turn") - 1) % len(weights) + 1).cast("int")
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), turn)
    return ranked.select(*sources.columns, weight.cast("long").alias("weight"))


def targets(sized: DataFrame, weights=WEIGHTS, max_rate: int = MAX_RATE) -> DataFrame:
    """One row per source: source, source_size, weight, target.

    ``sized`` has source and size. The sum of all sizes is shared by weight; a source whose share is
    above ``max_rate`` times its size stops there and the excess is shared again by weight among the
    others, until none is above. Each round is one aggregation over the sources and sends two
    numbers to the driver. All sizes zero: targets are zero. No rows: no rows.
    """
    per = sized.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    src = cut(ranked_sources(per, weights))
    cap = F.col("source_size") * max_rate
    stopped, n_stopped = F.lit(False), 0
    total = src.agg(F.sum("source_size")).first()[0] or 0
    while True:
        left, open_weight = src.agg(F.sum(F.when(stopped, cap).otherwise(0)),
                                    F.sum(F.when(stopped, 0).otherwise(F.col("weight")))).first()
        share = F.lit(float(total - (left or 0))) * F.col("weight") / F.lit(float(open_weight or 1))
        # shares only grow from round to round: what has stopped is above its cap in every later one
        now = stopped | (share > cap)
        n = src.filter(now).count()
        if n == n_stopped:
            return src.select("source", "source_size", "weight",
                              F.when(stopped, cap.cast("double")).otherwise(share).alias("target"))
        stopped, n_stopped = share > cap, n


def text_key(text: Column) -> Column:
    """The text's MD5; NULL counts as empty."""
    return F.md5(F.coalesce(text, F.lit("")).cast("binary"))


def draw(seed: int) -> Column:
    """A row's draw in [0, 1), from its doc_id, ``_mix_key`` (text) and ``_mix_no`` (number among equal rows)."""
    return unit_hash(seed, F.col("doc_id"), F.col("_mix_key"), F.col("_mix_no"))


def numbered(equal: DataFrame) -> DataFrame:
    """Groups of equal rows with their number of rows ``_mix_rows`` -> one row each, numbered in ``_mix_no``.

    Equal rows are counted map side, however many; a group of more than ``RUN_ROWS`` is dealt out in runs of
    numbers, so that no task makes all of its rows.
    """
    last = F.col("_mix_rows")
    small = equal.filter(last <= RUN_ROWS).withColumn("_mix_no", F.explode(F.sequence(F.lit(1).cast("long"), last)))
    runs = equal.filter(last > RUN_ROWS).withColumn("_mix_run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((last - 1) / RUN_ROWS))))
    first = F.col("_mix_run") * RUN_ROWS
    large = runs.repartition("_mix_run", "_mix_key").withColumn("_mix_no", F.explode(F.sequence(first + 1, F.least(first + RUN_ROWS, last))))
    return small.unionByName(large.drop("_mix_run")).drop("_mix_rows")


def mix(docs: DataFrame, weights=WEIGHTS, max_rate: int = MAX_RATE, seed: int = SEED) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken, copies.

    NULL text: size 0 and nothing taken. NULL source: a source of its own, ordered last. NULL ids and ids
    that repeat: each row is drawn by its text too. Repeated rows are documents of their own, each with its own
    draw. Empty input: no rows. Columns besides doc_id, text and source are not read, so their names can't clash.
    """
    equal = cut(docs.select("doc_id", "source", text_key(F.col("text")).alias("_mix_key"), word_count(F.col("text")).alias("size"))
                .groupBy("doc_id", "source", "_mix_key", "size").agg(F.count(F.lit(1)).alias("_mix_rows")))
    sized = equal.select("source", (F.col("size") * F.col("_mix_rows")).alias("size"))
    rates = targets(sized, weights, max_rate).withColumnRenamed("source", "_s")
    if rates.count() <= BROADCAST_SOURCES:
        rates = F.broadcast(rates)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(rate)
    extra = F.when(draw(seed) < rate - whole, 1).otherwise(0)
    out = numbered(equal).join(rates, F.col("source").eqNullSafe(F.col("_s")))
    return out.select("doc_id", "size", "source_size", "target",
                      ((whole + extra) * F.col("size")).cast("long").alias("taken"),
                      (whole + extra).cast("long").alias("copies"))


def _row_numbers(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_mix_key`` and ``_mix_no``. Only rows that have an equal one (same id, source and text) are
    sorted, by all columns over range partitions: a group of any size is spread, and reruns number it alike."""
    group = ["doc_id", "source", "_mix_key"]
    keyed = docs.withColumn("_mix_key", text_key(F.col("text")))
    again = cut(keyed.groupBy(*group).count().filter("count > 1").select(*[F.col(c).alias(f"_mix_{c}") for c in group]))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_mix_{c}")) for c in group])
    one = F.lit(1).cast("long").alias("_mix_no")
    if again.isEmpty():
        return keyed.select("*", one)
    single = keyed.join(again, same, "left_anti").select("*", one)
    repeated = keyed.join(again, same, "left_semi")
    order = [F.col(c).asc_nulls_first() for c in group] + [F.md5(F.to_json(F.struct(*docs.columns)).cast("binary"))]
    repeated = cut(repeated.withColumn("_mix_place", F.monotonically_increasing_id()))
    parts = docs.sparkSession.sparkContext.defaultParallelism
    placed, _ = global_row_number(repeated, [*order, F.col("_mix_place")], "_mix_at", parts, stage_input=False)
    first = placed.groupBy(*[F.col(c).alias(f"_mix_{c}") for c in group]).agg(F.min("_mix_at").alias("_mix_first"))
    out = placed.join(first, same).select(*keyed.columns, (F.col("_mix_at") - F.col("_mix_first") + 1).alias("_mix_no"))
    return single.unionByName(out)


def emit(docs: DataFrame, weights=WEIGHTS, max_rate: int = MAX_RATE, seed: int = SEED) -> DataFrame:
    """The mixed corpus: every document's row as often as its copies say, numbered from 1 in ``copy``.

    The per-source rates go to the documents, so the texts are not shuffled while there are at most
    ``BROADCAST_SOURCES`` sources, but for those of rows that repeat. Edge cases as in :func:`mix`.
    """
    sized = cut(docs.select("source", word_count(F.col("text")).alias("size")).groupBy("source").agg(
        F.sum("size").alias("size")))
    rates = targets(sized, weights, max_rate).select(F.col("source").alias("_mix_s"), F.when(
        F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias("_mix_rate"))
    if rates.count() <= BROADCAST_SOURCES:
        rates = F.broadcast(rates)
    out = _row_numbers(docs).join(rates, F.col("source").eqNullSafe(F.col("_mix_s")))
    rate = F.col("_mix_rate")
    copies = F.floor(rate) + F.when(draw(seed) < rate - F.floor(rate), 1).otherwise(0)
    keep = [c for c in docs.columns if c != "copy"]
    return out.withColumn("_mix_n", copies.cast("int")).filter(F.col("_mix_n") > 0).select(
        *keep, F.explode(F.sequence(F.lit(1), F.col("_mix_n"))).alias("copy"))


def op9_mixing(spark, sf_dir: str) -> DataFrame:
    return mix(read(spark, sf_dir, "documents")).drop("copies")


ORACLE = f"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
         md5(coalesce(text, '')) AS text_key,
         row_number() OVER (PARTITION BY doc_id, source, md5(coalesce(text, ''))) AS no
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CAST([5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS BIGINT) AS weight
  FROM d GROUP BY source),
o AS (
  SELECT *, sum(3 * source_size) OVER w AS caps, sum(weight) OVER w AS used,
         sum(source_size) OVER () AS total, sum(weight) OVER () AS all_w
  FROM s WINDOW w AS (ORDER BY 3.0 * source_size / weight, source NULLS LAST
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
k AS (
  SELECT CAST(total - coalesce(caps, 0) AS DOUBLE) AS rest, CAST(all_w - coalesce(used, 0) AS DOUBLE) AS w
  FROM o WHERE (total - coalesce(caps, 0)) * 1.0 * weight / (all_w - coalesce(used, 0)) <= 3.0 * source_size
  ORDER BY 3.0 * source_size / weight LIMIT 1),
t AS (
  SELECT source, source_size, least(rest * weight / w, CAST(3 * source_size AS DOUBLE)) AS target FROM s, k),
r AS (
  SELECT doc_id, size, source_size, target,
         CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate,
         CAST(('0x' || substr(md5(concat_ws(':', '{SEED}', coalesce(CAST(doc_id AS VARCHAR), ''), text_key, no)), 1, 13)) AS BIGINT) / {float(2**52)} AS u
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST((floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) * size AS BIGINT) AS taken
FROM r
"""
