"""The conversation trie against brute force over all prefixes."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from awkward import SF, duck
from pyspark.sql import functions as F

from orderlens.llm import turntrie

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows, rebuild=True):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append((turn is not None, turn or 0, hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32], role, text))
    own = {c: [x[3:] for x in sorted(v)] for c, v in own.items()}
    seqs = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9 if rebuild else 0
        seqs[c] = tuple(own.get(c - c % 5, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    children = defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += children[p] == 0
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1].encode()) if p else 0
    sha = lambda ids: hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()
    return [(min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p],
             sha([c for c in m if len(seqs[c]) == len(p)])) for p, m in members.items()]


def key(t):
    return tuple((x is None, x or 0) for x in t[:7]) + (t[7],)


def conversations(n, seed, alphabet=3):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(rng.choice([1, 1, 2, 3, 4, 8, 12])):
            rows.append((c * rng.choice([1, 1, 1]), t, rng.choice(["user", "assistant"]), f"text {rng.randrange(alphabet)}"))
    rows += [(3, None, None, None), (3, 0, "user", "text 1"), (4, 7, "user", ""), (4, 7, "assistant", "é漢"), (None, 0, "user", "lost"),
             (2**60 + 1, 0, "user", "text 0"), (2**60 + 2, 0, "user", "text 0")]
    rows += [(1000 + k, t, "user", f"same {t}") for k in range(40) for t in range(30)]  # a hot conversation
    return rows


@pytest.mark.parametrize("shard_turns", [1, 37, 10**6])
@pytest.mark.parametrize("alphabet", [1, 3])
def test_nodes_equal_brute_force(spark, shard_turns, alphabet):
    rows = conversations(150, alphabet, alphabet)
    df = spark.createDataFrame(rows, SCHEMA).withColumn("key", F.lit("x")).withColumn("depth", F.lit("x"))
    for rebuild in (False, True):
        seqs = turntrie.turn_sequences(df)
        got = turntrie.prefix_trie(turntrie.with_shared_heads(seqs) if rebuild else seqs, shard_turns)
        assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(brute(rows, rebuild), key=key)


def test_query_equals_sql_and_brute_force(spark):
    table = spark.read.parquet(f"{SF}/conversations.parquet")
    got = sorted((tuple(r) for r in turntrie.op13_turntrie(spark, SF).collect()), key=key)
    assert got == sorted(brute([tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]), key=key)
    assert got == sorted(duck({"conversations": f"{SF}/conversations.parquet"}).execute(turntrie.ORACLE).fetchall(), key=key)


def test_empty_and_idless_tables(spark, tmp_path):
    for k, rows in enumerate([[], [(None, 1, "user", "x")]]):
        spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/{k}/conversations.parquet")
        assert turntrie.op13_turntrie(spark, f"{tmp_path}/{k}").count() == 0


def test_turnless_conversation_ends_at_the_root(spark):
    c = next(c for c in range(1, 10**5) if c % 5 and zlib.crc32(str(c).encode()) % 9 >= 2)
    rows = [(c, 0, "user", "gone")]
    got = [tuple(r) for r in turntrie.prefix_trie(turntrie.with_shared_heads(turntrie.turn_sequences(spark.createDataFrame(rows, SCHEMA)))).collect()]
    assert got == brute(rows) == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]


def test_double_array_holds_exactly_its_prefixes():
    rng = random.Random(4)
    seqs = sorted({tuple(rng.randrange(30) for _ in range(rng.randrange(7))) for _ in range(400)})
    codes = turntrie.dense([[bytes([x]) for x in s] for s in seqs])
    trie = turntrie.build(codes)
    slots = {}
    for s, c in zip(seqs, codes):
        at = 0
        for d, x in enumerate(c):
            at = int(trie.step(np.array([at]), np.array([x]))[0])
            assert at > 0 and slots.setdefault(at, s[:d + 1]) == s[:d + 1]
    assert len(slots) == len({s[:d] for s in seqs for d in range(1, len(s) + 1)})
    number = {s[d]: int(c[d]) for s, c in zip(seqs, codes) for d in range(len(s))}
    prefixes = {s[:d] for s in seqs for d in range(len(s) + 1)}
    nodes = {p: s for s, p in slots.items()} | {(): 0}
    for p, node in nodes.items():
        for x, c in number.items():
            assert (int(trie.step(np.array([node]), np.array([c]))[0]) >= 0) == (p + (x,) in prefixes)
    assert len(trie.base) < 20 * len(slots)
