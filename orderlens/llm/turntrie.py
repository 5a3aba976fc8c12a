"""Prefix trie of conversations in double arrays, shard by shard.

A conversation is a sequence of turns, each known by a 128-bit digest. Equal sequences are counted first, then the
distinct ones are range-partitioned in lexicographic order, so a shard holds a stretch of neighbouring prefixes of bounded
size, however many conversations share a first turn. A shard numbers its turns densely, packs its trie into two arrays
(child of node s by turn c: the slot BASE[s] + c, if CHECK there is s), walks all sequences through them at once,
and sums up from the deepest nodes. Only nodes on the path of a shard's first and last sequence can occur in
another shard: these two border paths of every shard, which follow one another in the order of the trie, are merged in one
pass with a stack no higher than the longest conversation; all other nodes are final.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import cut, read, stage

#: turns that a shard holds, about
SHARD_TURNS = 1 << 16
#: free slots that are tried for a node with several children before its block goes to the end
TRIES = 16
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


class DoubleArray:
    """A trie over codes 0, 1, ... in BASE and CHECK arrays; slot 0 is the root."""

    def __init__(self, room: int = 1024):
        self.base = np.zeros(room, np.int64)
        self.check = np.full(room, -1, np.int64)
        self.check[0] = 0  # taken; the root is nobody's child, as no slot refers to 0 below
        self.free, self.top = 1, 1

    def _grow(self, size: int) -> None:
        if size > len(self.base):
            more = max(size, 2 * len(self.base)) - len(self.base)
            self.base = np.concatenate([self.base, np.zeros(more, np.int64)])
            self.check = np.concatenate([self.check, np.full(more, -1, np.int64)])

    def place(self, node: int, codes: np.ndarray) -> np.ndarray:
        """Give ``node`` its children by increasing codes; returns their slots."""
        codes = np.asarray(codes, np.int64)
        while self.free < self.top and self.check[self.free] >= 0:
            self.free += 1
        offsets = codes - codes[0]
        width = int(offsets[-1]) + 1
        self._grow(self.top + width)
        slot = self.free
        for _ in range(TRIES):
            if slot >= self.top or (self.check[slot + offsets] < 0).all():
                break
            slot += 1
            self._grow(slot + width)
        else:
            slot = self.top
            self._grow(slot + width)
        slots = slot + offsets
        self.base[node] = slot - int(codes[0])
        self.check[slots] = node
        self.top = max(self.top, int(slots[-1]) + 1)
        return slots

    def step(self, nodes: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The children of ``nodes`` by ``codes``, -1 where there is none."""
        to = self.base[nodes] + codes
        ok = (to > 0) & (to < len(self.check))
        return np.where(ok & (self.check[np.where(ok, to, 0)] == nodes), to, -1)


def build(sequences: list[np.ndarray]) -> DoubleArray:
    """The trie of sequences of codes, level by level. Sequences come in lexicographic order of their turns (equal
    prefixes stand together)."""
    trie = DoubleArray(2 * sum(map(len, sequences)) + 2)
    lengths = np.array([len(s) for s in sequences], np.int64)
    at = np.zeros(len(sequences), np.int64)
    for d in range(int(lengths.max(initial=0))):
        live = np.flatnonzero(lengths > d)
        nodes, codes = at[live], np.array([sequences[k][d] for k in live], np.int64)
        first = np.ones(len(live), bool)  # a new node at each change of the parent or of the turn
        first[1:] = (nodes[1:] != nodes[:-1]) | (codes[1:] != codes[:-1])
        heads = np.flatnonzero(first)
        parents, kids = nodes[heads], codes[heads]
        starts = np.flatnonzero(np.append(True, parents[1:] != parents[:-1]))
        slots = np.empty(len(heads), np.int64)
        for a, b in zip(starts, np.append(starts[1:], len(heads))):
            by = np.argsort(kids[a:b])
            slots[a:b][by] = trie.place(int(parents[a]), kids[a:b][by])
        at[live] = slots[np.cumsum(first) - 1]
    return trie


def dense(turns: list[list[bytes]]) -> list[np.ndarray]:
    """Turns numbered from 0 by depth and first occurrence, so that the children of a node lie close together."""
    codes: dict[bytes, int] = {}
    out = [np.empty(len(t), np.int64) for t in turns]
    live, d = list(range(len(turns))), 0
    while live:
        live = [k for k in live if len(turns[k]) > d]
        for k in live:
            out[k][d] = codes.setdefault(turns[k][d], len(codes))
        d += 1
    return out


def keys_of(turns: list[bytes]) -> list[bytes]:
    """A 128-bit key of every prefix of a sequence, the empty one first."""
    keys = [hashlib.sha256(b"").digest()[:16]]
    for t in turns:
        keys.append(hashlib.sha256(keys[-1] + t).digest()[:16])
    return keys


LOCAL = ("border boolean, shard int, side int, key binary, parent_key binary, depth long, conv_id long, parent_conv_id long, n_convs long, "
         "n_children long, n_leaves long, saved_tokens long, n_bytes long, end_key string")
COLUMNS = [c.split()[0] for c in LOCAL.split(", ")]


def shard_nodes(turns: list[list[bytes]], sizes: list, members: np.ndarray, least: np.ndarray, end_keys: list[str], shard: int) -> pd.DataFrame:
    """The nodes of one shard of distinct sequences in order: ``members`` conversations have each, ``least`` is the smallest."""
    sequences = dense(turns)
    trie = build(sequences)
    room = len(trie.base)
    count, saved, children, leaves, n_bytes, depth = (np.zeros(room, np.int64) for _ in range(6))
    conv = np.full(room, np.iinfo(np.int64).max)
    ends = {}
    lengths = np.array([len(s) for s in sequences], np.int64)
    at = np.zeros(len(sequences), np.int64)
    for d in range(int(lengths.max()) + 1):  # all sequences walk down a step at a time
        live = np.flatnonzero(lengths >= d)
        if d:
            at[live] = trie.step(at[live], np.array([sequences[k][d - 1] for k in live], np.int64))
            n_bytes[at[live]] = [sizes[k][d - 1] for k in live]
        np.add.at(count, at[live], members[live])
        np.minimum.at(conv, at[live], least[live])
        depth[at[live]] = d
        for k in live[lengths[live] == d]:
            ends[int(at[k])] = end_keys[k]
    nodes = np.flatnonzero(count > 0)
    nodes = nodes[np.argsort(depth[nodes], kind="stable")]
    borders, key = [], {}
    for k in (0, len(turns) - 1):
        path = [0]
        for c in sequences[k]:
            path.append(int(trie.step(np.array([path[-1]]), np.array([c]))[0]))
        key.update(zip(path, keys_of(turns[k])))
        borders.append(path)
    border = np.zeros(room, bool)
    border[list(key)] = True
    levels = np.searchsorted(depth[nodes], np.arange(int(depth[nodes[-1]]) + 2))
    for d in range(len(levels) - 2, -1, -1):
        own = nodes[levels[d]:levels[d + 1]]
        own = own[~border[own]]  # what hangs on a border node is summed in it; border nodes meet when they are merged
        leaves[own] += children[own] == 0
        saved[own] += (count[own] - 1) * n_bytes[own]
        if d:
            up = trie.check[own]
            np.add.at(children, up, 1)
            np.add.at(leaves, up, leaves[own])
            np.add.at(saved, up, saved[own])
    inner = nodes[~border[nodes]]
    up = trie.check[inner]
    rows = [(False, shard, 0, None, key.get(p), int(depth[s]), int(conv[s]), None if border[p] else int(conv[p]), int(count[s]),
             int(children[s]), int(leaves[s]), int(saved[s]), int(n_bytes[s]), ends.get(s)) for s, p in zip(inner.tolist(), up.tolist())]
    told = set()
    for side, path in enumerate(borders):
        for d, s in enumerate(path):
            new = s not in told  # what both paths hold counts once
            told.add(s)
            rows.append((True, shard, side, key[s], key[path[d - 1]] if d else None, d, int(conv[s]), None, int(count[s]) * new,
                         int(children[s]) * new, int(leaves[s]) * new, int(saved[s]) * new, int(n_bytes[s]), ends.get(s)))
    return pd.DataFrame(rows, columns=COLUMNS).astype({"conv_id": "Int64", "parent_conv_id": "Int64"})


def merge_borders(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The border nodes of all shards, by shard, side and depth, merged: a stack holds the present path."""
    stack: list[dict] = []

    def close(depth: int) -> list[dict]:
        done = []
        while len(stack) > depth:
            node = stack.pop()
            node["n_leaves"] += node["n_children"] == 0
            node["saved_tokens"] += (node["n_convs"] - 1) * node["n_bytes"]
            if stack:
                stack[-1]["n_children"] += 1
                stack[-1]["n_leaves"] += node["n_leaves"]
                stack[-1]["saved_tokens"] += node["saved_tokens"]
            done.append(node)
        return done

    def frame(done: list[dict]) -> pd.DataFrame:
        return pd.DataFrame(done, columns=COLUMNS).astype({"conv_id": "Int64", "parent_conv_id": "Int64"})

    for b in batches:
        done = []
        for values in zip(*[b[c].tolist() for c in COLUMNS]):
            row = dict(zip(COLUMNS, values))
            row["parent_conv_id"] = None
            d = row["depth"]
            if d < len(stack) and stack[d]["key"] == row["key"]:
                node = stack[d]
                node["conv_id"] = min(node["conv_id"], row["conv_id"])
                node["end_key"] = node["end_key"] or row["end_key"]
                for c in ("n_convs", "n_children", "n_leaves", "saved_tokens"):
                    node[c] += row[c]
            else:
                done += close(d)
                stack.append(row)
        if done:
            yield frame(done)
    yield frame(close(0))


def end_digests(members: DataFrame) -> DataFrame:
    """Per end_key: SHA-256 of its conversations' decimal ids in ascending order, joined by commas.

    The ids are sorted over all partitions and joined piece by piece, so a key that a third of all conversations share
    comes to its one hashing task as a stream of long pieces."""
    def pieces(batches):
        for b in batches:
            if len(b):
                joined = b.groupby("end_key", sort=False)["conv_id"].agg([("first_id", "first"), ("ids", lambda x: ",".join(map(str, x)))])
                yield joined.reset_index()

    def hashed(batches):
        key, h = None, None
        for b in batches:
            out = []
            for k, ids in zip(b["end_key"], b["ids"]):
                if k != key:
                    if key is not None:
                        out.append((key, h.hexdigest()))
                    key, h = k, hashlib.sha256(ids.encode())
                else:
                    h.update(b"," + ids.encode())
            if out:
                yield pd.DataFrame(out, columns=["end_key", "ends_sha256"])
        if key is not None:
            yield pd.DataFrame([(key, h.hexdigest())], columns=["end_key", "ends_sha256"])

    n = max(1, members.rdd.getNumPartitions())
    ordered = members.repartitionByRange(n, "end_key", "conv_id").sortWithinPartitions("end_key", "conv_id")
    joined = ordered.mapInPandas(pieces, "end_key string, first_id long, ids string")
    dealt = joined.repartition("end_key").sortWithinPartitions("end_key", "first_id")
    return dealt.mapInPandas(hashed, "end_key string, ends_sha256 string")


def turn_sequences(conversations: DataFrame) -> DataFrame:
    """Per conversation: conv_id and ``turns``, an array of (turn digest, UTF-8 bytes of the text) ordered by turn, NULL first.

    NULL role or text counts as empty; rows with the same turn are ordered by their digest, repeated rows are turns of
    their own. Rows without conv_id belong to no conversation. Other columns are not read. A conversation is gathered in one
    task, at some 20 bytes a turn; the texts are not."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    sha = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id"), F.struct(
        F.col("turn").alias("t"), F.unhex(F.substring(sha, 1, 32)).alias("k"), F.octet_length(text).cast("long").alias("b")).alias("turn"))
    ordered = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    return ordered.select("conv_id", F.transform("turns", lambda t: F.struct(t["k"].alias("k"), t["b"].alias("b"))).alias("turns"))


def prefix_trie(sequences: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row per node of the trie over ``sequences`` (conv_id, turns as of :func:`turn_sequences`; a row per conversation).

    Returns conv_id (smallest member), depth, parent_conv_id (NULL for the root), n_convs, n_children, n_leaves,
    saved_tokens (bytes), ends_sha256 (see :func:`end_digests`; of nothing: the empty text's hash). Conversations without turns end at the root. No
    conversations: no nodes. Equal conversations are one path.
    """
    ks = F.transform("turns", lambda t: t["k"])
    keyed = cut(sequences.select("conv_id", ks.alias("ks"), F.transform("turns", lambda t: t["b"]).alias("bs"),
                                 F.sha2(F.array_join(F.transform(ks, F.hex), ""), 256).alias("end_key")))
    distinct = cut(keyed.groupBy("ks", "bs", "end_key").agg(F.count(F.lit(1)).alias("members"), F.min("conv_id").alias("least")))
    shards = max(1, -(-(distinct.agg(F.sum(F.size("ks") + 1)).first()[0] or 0) // shard_turns))

    def nodes(batches):
        from pyspark import TaskContext

        parts = [b for b in batches if len(b)]
        if parts:
            b = pd.concat(parts, ignore_index=True)
            yield shard_nodes([list(map(bytes, x)) for x in b["ks"]], list(b["bs"]), b["members"].to_numpy(np.int64), b["least"].to_numpy(np.int64),
                              b["end_key"].tolist(), TaskContext.get().partitionId())

    ordered = distinct.repartitionByRange(shards, "ks").sortWithinPartitions("ks")
    local = stage(ordered.mapInPandas(nodes, LOCAL), "turntrie-nodes")
    borders = local.filter("border").repartition(1).sortWithinPartitions("shard", "side", "depth")
    merged = cut(borders.mapInPandas(merge_borders, LOCAL))
    name = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_name"))
    inner = local.filter(~F.col("border"))
    hanging = inner.filter(F.col("parent_conv_id").isNull()).unionByName(merged.filter("depth > 0")).join(name, "parent_key")
    shown = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "end_key"]
    found = inner.filter(F.col("parent_conv_id").isNotNull()).select(*shown).unionByName(
        hanging.withColumn("parent_conv_id", F.col("parent_name")).select(*shown)).unionByName(merged.filter("depth = 0").select(*shown))
    ends = end_digests(keyed.select("end_key", "conv_id"))
    ending = found.filter(F.col("end_key").isNotNull()).join(ends, "end_key")
    passing = found.filter(F.col("end_key").isNull()).withColumn("ends_sha256", F.lit(EMPTY_SHA))
    return ending.select(*shown[:-1], "ends_sha256").unionByName(passing.select(*shown[:-1], "ends_sha256"))


def with_shared_heads(sequences: DataFrame) -> DataFrame:
    """The contract's conversations: conversation c begins with the first h turns of c - c % 5, h being crc32(c) % 9, and goes
    on with its own turns after the first h."""
    c = F.col("conv_id")
    h = (F.crc32(c.cast("string").cast("binary")) % 9).cast("int")
    heads = sequences.select(c.alias("_from"), F.slice("turns", 1, 8).alias("_head"))
    none = F.array().cast(sequences.schema["turns"].dataType)
    own = sequences.withColumn("_from", c - c % 5).join(heads, "_from", "left")
    return own.select("conv_id", F.concat(F.coalesce(F.slice("_head", F.lit(1), h), none), F.slice(
        "turns", h + 1, F.greatest(F.size("turns") - h, F.lit(0)))).alias("turns"))


def op13_turntrie(spark, sf_dir: str) -> DataFrame:
    return prefix_trie(with_shared_heads(cut(turn_sequences(read(spark, sf_dir, "conversations")))))


#: crc32 by its definition (reflected, polynomial 0xEDB88320): DuckDB has none
ORACLE = """
WITH RECURSIVE bits(n, k, v) AS (
  SELECT n, 0, n FROM range(256) t(n)
  UNION ALL SELECT n, k + 1, CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM bits WHERE k < 8),
crc_table AS (SELECT n, v FROM bits WHERE k = 8),
t AS (
  SELECT conv_id, octet_length(encode(coalesce(text, ''))) AS b,
         substr(sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 1, 32) AS k,
         turn FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, list({'k': k, 'b': b} ORDER BY turn NULLS FIRST, k) AS turns FROM t GROUP BY conv_id),
crc(conv_id, i, v) AS (
  SELECT conv_id, 0, CAST(4294967295 AS BIGINT) FROM c
  UNION ALL SELECT conv_id, i + 1, xor(crc.v >> 8, crc_table.v)
  FROM crc JOIN crc_table ON crc_table.n = xor(crc.v, ascii(substr(CAST(conv_id AS VARCHAR), i + 1, 1))) & 255
  WHERE i < length(CAST(conv_id AS VARCHAR))),
h AS (SELECT conv_id, xor(v, 4294967295) % 9 AS h FROM crc WHERE i = length(CAST(conv_id AS VARCHAR))),
r AS (
  SELECT c.conv_id, list_concat(coalesce(p.turns[1:h], []), c.turns[h + 1:]) AS turns
  FROM c JOIN h USING (conv_id) LEFT JOIN c p ON p.conv_id = c.conv_id - c.conv_id % 5),
m AS (
  SELECT conv_id, d, len(turns) AS l, CASE WHEN d > 0 THEN turns[d].b ELSE 0 END AS b,
         sha256(array_to_string(list_transform(turns[1:d], lambda x: x.k), '')) AS k,
         sha256(array_to_string(list_transform(turns[1:d - 1], lambda x: x.k), '')) AS up
  FROM r, unnest(range(len(turns) + 1)) u(d)),
n AS (
  SELECT d, k, any_value(CASE WHEN d > 0 THEN up END) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(b) AS b,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE l = d), '')) AS ends_sha256
  FROM m GROUP BY d, k),
kids AS (SELECT up AS k, d - 1 AS d, count(*) AS n_children FROM n WHERE d > 0 GROUP BY ALL),
full_n AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN kids USING (k, d)),
sums AS (
  SELECT a.k, a.d, sum((u.n_convs - 1) * u.b) AS saved, count(*) FILTER (WHERE u.n_children = 0) AS leaves
  FROM full_n u JOIN m a ON a.conv_id = u.conv_id AND a.d <= u.d GROUP BY a.k, a.d)
SELECT x.conv_id, CAST(x.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, x.n_convs, x.n_children,
       CAST(s.leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, x.ends_sha256
FROM full_n x JOIN sums s USING (k, d) LEFT JOIN n p ON p.k = x.up AND p.d = x.d - 1
"""
