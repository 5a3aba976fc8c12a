"""SimHash near-duplicates through a Gray-order hierarchical index.

Fingerprints within ``max_bits`` differing bits of each other are linked; a document's component is
named by its smallest doc_id. Equal fingerprints are one node. Of ``max_bits + 1`` blocks of a
fingerprint two linked ones share at least one, so each is dealt out once per block, rotated to have
that block on top; the copies of one block value are a bucket. A bucket is sorted by Gray rank, which
brings fingerprints with like leading bits together. Runs of neighbours become nodes that hold the
bits which all below share (mask and pattern), nodes become nodes above them, and a search compares
nodes from the top: differences in shared bits add up on the way down, and a pair of nodes above
``max_bits`` is dropped with all that is below it.

A bucket above ``SPLIT`` rows is cut into parts by hash and every pair of parts is a bucket of its own,
so that no task holds it whole. A bucket's links go out as at most one edge a row, to the smallest
linked one, not as all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import cut, id_as_text, id_back, read, with_row_key
from orderlens.llm.graph import components

SHINGLE = 3
MAX_BITS = 3
SEED = 42
#: rows of a bucket up to which one task searches it whole
SPLIT = 2048
FANOUT = 8
PAIRS_AT_ONCE = 1 << 15


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64 majority bits of the hashes of a text's word shingles; 0 for a text without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # ASCII case and white space only
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[k:] for k in range(shingle)), strict=False))
    h = xxhash.xxh64_intdigest
    hashes = np.fromiter((h(g, SEED) for g in grams), np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at:at + (1 << 16)]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, *more: str) -> DataFrame:
    """(doc_id, fp) with fp as a signed long, and the columns ``more`` (longs that are not NULL)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            fps = np.array([fingerprint(t, shingle) for t in b["text"]], np.uint64)
            yield pd.DataFrame({"doc_id": b["doc_id"], "fp": fps.view(np.int64)} | {c: b[c] for c in more})

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = ", ".join(["doc_id string, fp long", *[f"{c} long" for c in more]])
    return id_back(id_as_text(docs.select("doc_id", "text", *more)).mapInPandas(run, schema), kind)


def _gray_rank(x: Column) -> Column:
    for k in (1, 2, 4, 8, 16, 32):
        x = x.bitwiseXOR(F.shiftrightunsigned(x, k))
    return x


def _dealt(nodes: DataFrame, max_bits: int) -> DataFrame:
    """A row per fingerprint and block: block number, block value (in Gray order), Gray rank, fp."""
    n = max_bits + 1
    edges = [64 * k // n for k in range(n + 1)]
    parts = []
    for k in range(n):
        at, width = edges[k], edges[k + 1] - edges[k]
        fp = F.col("fp")
        turned = fp if at == 0 else F.shiftleft(fp, at).bitwiseOR(F.shiftrightunsigned(fp, 64 - at))
        rank = _gray_rank(turned)
        parts.append(F.struct(F.lit(k).alias("block"), F.shiftrightunsigned(rank, 64 - width).alias("value"), rank.alias("rank")))
    # unsigned order of the ranks: flip the sign bit
    return nodes.select("fp", F.explode(F.array(*parts)).alias("p")).select(
        "p.block", "p.value", F.col("p.rank").bitwiseXOR(F.lit(-(2**63))).alias("rank"), "fp")


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def _merge(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Give linked rows the smallest label of either, in place."""
    while len(i):
        li, lj = label[i], label[j]
        open_ = li != lj
        i, j, li, lj = i[open_], j[open_], li[open_], lj[open_]
        np.minimum.at(label, np.maximum(li, lj), np.minimum(li, lj))
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label[:] = up


def linked_rows(fps: np.ndarray, bucket: np.ndarray, max_bits: int) -> np.ndarray:
    """For rows sorted by bucket and Gray rank: the smallest row that each is linked to, over chains of
    links within its bucket."""
    n = len(fps)
    label = np.arange(n)
    if n < 2:
        return label
    # levels[0] are the rows; each level: first child, end child, mask and pattern of shared bits, bucket
    levels = [(None, None, np.full(n, ~np.uint64(0)), fps, bucket)]
    both, any_ = fps, fps
    while True:
        owner = levels[-1][4]
        first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        if len(first) == len(owner):
            break
        within = np.arange(len(owner)) - np.repeat(first, np.diff(np.r_[first, len(owner)]))
        start = np.flatnonzero(within % FANOUT == 0)
        both, any_ = np.bitwise_and.reduceat(both, start), np.bitwise_or.reduceat(any_, start)
        mask = ~(both ^ any_)
        levels.append((start, np.r_[start[1:], len(owner)], mask, both & mask, owner[start]))
    top = np.arange(len(levels[-1][4]))
    stack = [(len(levels) - 1, top, top, np.zeros(len(top), np.int64), np.zeros(len(top), np.uint64))]
    while stack:
        at, a, b, apart, known = stack.pop()
        if at == 0:
            _merge(label, a, b)
            continue
        if len(a) > PAIRS_AT_ONCE:
            h = len(a) // 2
            stack += [(at, a[:h], b[:h], apart[:h], known[:h]), (at, a[h:], b[h:], apart[h:], known[h:])]
            continue
        start, end = levels[at][:2]
        mask, pattern = levels[at - 1][2:4]
        na, nb = end[a] - start[a], end[b] - start[b]
        pair = np.repeat(np.arange(len(a)), na * nb)
        k = np.arange(len(pair)) - np.repeat(np.cumsum(na * nb) - na * nb, na * nb)
        i, j = start[a][pair] + k // nb[pair], start[b][pair] + k % nb[pair]
        use = (i < j) if at == 1 else (i <= j)
        pair, i, j = pair[use], i[use], j[use]
        # only bits that both share below and that were not compared above
        shared = mask[i] & mask[j]
        found = apart[pair] + _popcount((pattern[i] ^ pattern[j]) & shared & ~known[pair])
        near = found <= max_bits
        stack.append((at - 1, i[near], j[near], found[near], shared[near]))
    return label


def links(nodes: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b): edges between distinct fingerprints at ``max_bits`` or fewer differing bits; within each
    bucket the linked ones hang on one of them."""
    dealt = cut(_dealt(nodes, max_bits))
    large = dealt.groupBy("block", "value").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > SPLIT)
    large = large.select(F.col("block").alias("_b"), F.col("value").alias("_v"), F.ceil(F.col("n") / SPLIT).cast("int").alias("parts"))
    j = dealt.join(large, (F.col("block") == F.col("_b")) & (F.col("value") == F.col("_v")), "left")
    part = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    pairs = F.when(F.col("parts").isNull(), F.array(F.lit(0))).otherwise(F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1),
        lambda o: F.least(o, part) * F.col("parts") + F.greatest(o, part)))
    spread = j.select("block", "value", F.explode(pairs).alias("pair"), "rank", "fp")
    # the sort brings a bucket's rows together in Gray order
    n = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = spread.repartition(n, "block", "value", "pair").sortWithinPartitions("block", "value", "pair", "rank")

    def search(fps: np.ndarray, bucket: np.ndarray) -> pd.DataFrame:
        label = linked_rows(fps.view(np.uint64), bucket, max_bits)
        on = label != np.arange(len(label))
        return pd.DataFrame({"a": fps[on], "b": fps[label[on]]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept: list[pd.DataFrame] = []
        for b in batches:
            if not len(b):
                continue
            kept.append(b)
            all_ = pd.concat(kept, ignore_index=True) if len(kept) > 1 else b
            key = all_[["block", "value", "pair"]].to_numpy()
            change = np.r_[True, (key[1:] != key[:-1]).any(axis=1)]
            last = int(np.flatnonzero(change)[-1])  # the last bucket may go on in the next batch
            if last:
                yield search(all_["fp"].to_numpy()[:last], np.cumsum(change)[:last])
            kept = [all_.iloc[last:]]
        if kept:
            fps = pd.concat(kept)["fp"].to_numpy()
            yield search(fps, np.zeros(len(fps), np.int64))

    return spread.mapInPandas(run, "a long, b long")


def grouped(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """Per document: doc_id, fp (signed long), component_id.

    NULL and empty texts, and texts without words, have fingerprint zero and are linked like others;
    long texts are hashed whole; repeated rows each get a row; no rows: no rows. A component without
    any non-NULL doc_id has component_id NULL. Columns besides doc_id and text are not read.
    """
    fps = cut(fingerprints(docs, shingle))
    nodes = cut(fps.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = components(links(nodes.select("fp"), max_bits))
    named = nodes.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    least = named.groupBy("root").agg(F.min("first").alias("component_id")).withColumnRenamed("root", "_r")
    named = cut(named.join(least, F.col("root") == F.col("_r")).select(F.col("fp").alias("_fp"), "component_id"))
    # a fingerprint that a third of all documents share is split by the adaptive join
    return fps.join(named, F.col("fp") == F.col("_fp")).select("doc_id", "fp", "component_id")


def near_dedup(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with exactly one row of each component, the one with the smallest doc_id; all columns stay.

    Rows are told apart by a key of their own, so several rows without a doc_id, or with the same one, are
    rows like others. Of rows that share the smallest doc_id the one with the least hash of its text stays;
    rows without a doc_id come last. Edge cases of the grouping as in :func:`grouped`.
    """
    stored, key = with_row_key(docs, "near-dedup-rows")
    narrow = stored.select(F.col(key).alias("row"), "doc_id", "text", F.xxhash64("text").alias("text_hash"))
    fps = fingerprints(narrow, shingle, "row", "text_hash")
    nodes = cut(fps.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash", "row")).alias("first")))
    roots = components(links(nodes.select("fp"), max_bits))
    named = nodes.join(roots, F.col("fp") == F.col("node"), "left")
    least = named.groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("first").alias("first"))
    return stored.join(least.select(F.col("first.row").alias("_keep")), stored[key] == F.col("_keep"), "left_semi").drop(key)


def op7_simhash(spark, sf_dir: str) -> DataFrame:
    found = grouped(read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
