"""SimHash components and removed substrings against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from awkward import SF, awkward, rows, with_clashes

from orderlens.llm import graph, simhash, substrings, suffix


def brute_fingerprint(text):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")) if w]
    grams = [" ".join(words[k:k + 3]) for k in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(pairs):
    """doc_id -> smallest linked doc_id, by comparing all pairs."""
    parent = list(range(len(pairs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(pairs)):
        for b in range(a):
            if (pairs[a][1] ^ pairs[b][1]).bit_count() <= 3:
                parent[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(pairs):
        r = find(k)
        least[r] = min([x for x in (least.get(r), i) if x is not None], default=None)
    return [(i, fp, least[find(k)]) for k, (i, fp) in enumerate(pairs)]


@pytest.mark.parametrize("table", ["test", "awkward"])
def test_components_equal_all_pairs(spark, table):
    docs = spark.read.parquet(f"{SF}/documents.parquet") if table == "test" else awkward(spark)
    pairs = [(r["doc_id"], brute_fingerprint(r["text"])) for r in docs.collect()]
    mine = [(r["doc_id"], r["fp"] % 2**64, r["component_id"]) for r in simhash.grouped(with_clashes(docs)).collect()]
    key = lambda t: tuple((x is None, str(x)) for x in t)
    assert sorted(mine, key=key) == sorted(brute_components(pairs), key=key)


def gray_order(x):
    r = x.copy()
    for k in (1, 2, 4, 8, 16, 32):
        r ^= r >> np.uint64(k)
    return np.argsort(r)


def test_index_finds_all_links_and_chains():
    rng = np.random.default_rng(3)
    found = set()
    for base in rng.integers(0, 2**63, 30, dtype=np.uint64):
        for _ in range(40):
            v = int(base)
            for b in rng.integers(0, 64, rng.integers(0, 6)):
                v ^= 1 << int(b)
            found.add(v)
    x = np.array(sorted(found), np.uint64)
    bucket = (x >> np.uint64(60)).astype(np.int64)
    order = np.lexsort((np.argsort(gray_order(x)), bucket))
    x, bucket = x[order], bucket[order]
    near = (np.bitwise_count(x[:, None] ^ x[None, :]) <= 3) & (bucket[:, None] == bucket[None, :])
    want = np.arange(len(x))
    while True:
        new = np.array([want[row].min() for row in near])
        if (new == want).all():
            break
        want = new
    assert (simhash.linked_rows(x, bucket, 3) == want).all()


def test_large_buckets_are_split_without_losing_links(spark, monkeypatch):
    rng = random.Random(1)
    centre = rng.getrandbits(64)
    fps = {centre}
    while len(fps) < 400:
        fps.add(rng.choice(sorted(fps)) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    fps |= {rng.getrandbits(64) for _ in range(200)}
    signed = [f - 2**64 if f >= 2**63 else f for f in fps]
    nodes = spark.createDataFrame([(f,) for f in signed], "fp long")
    want = {i: c for i, _, c in brute_components(sorted((f, f % 2**64) for f in signed))}
    for split in (2048, 16):
        monkeypatch.setattr(simhash, "SPLIT", split)
        root = {r["node"]: r["root"] for r in graph.components(simhash.links(nodes)).collect()}
        assert {f: root.get(f, f) for f in signed} == want


def test_components_of_a_chain_and_a_star(spark):
    edges = [(k, k + 1) for k in range(60)] + [(100, k) for k in range(101, 180)] + [(5, 5), (300, 301), (301, 300)]
    got = {r["node"]: r["root"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(61)} | {k: 100 for k in range(100, 180)} | {300: 300, 301: 300}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_dedup_keeps_one_of_each_group(spark):
    docs = with_clashes(awkward(spark))
    kept = simhash.near_dedup(docs)
    assert kept.columns == docs.columns
    # 1, 2, 3, 12 have no words; 5 twice and 6 are equal
    ids = [r["doc_id"] for r in kept.collect()]
    assert 1 in ids and not {2, 3, 12, 6} & set(ids) and ids.count(5) == 1 and len(ids) == len(set(ids))
    assert simhash.near_dedup(docs.limit(0)).count() == 0


def test_near_dedup_tells_rows_without_or_with_equal_ids_apart(spark):
    """One row of each group stays, whatever its doc_id: several groups without ids, one id with two texts."""
    rng = random.Random(8)
    texts = [" ".join(rng.choice("abcdefghijklmnop") + str(rng.randint(0, 99)) for _ in range(40)) for _ in range(9)]
    table = [(None, texts[0]), (None, texts[0]), (None, texts[1]), (None, texts[2]), (1, texts[2]), (7, texts[3]), (7, texts[4]),
             (7, texts[4]), (3, texts[4]), (None, texts[5]), (8, texts[6]), (8, texts[7]), (8, texts[7])]
    got = simhash.near_dedup(with_clashes(spark.createDataFrame(table, "doc_id long, text string")))
    want = [(None, 0), (None, 1), (1, 2), (7, 3), (3, 4), (None, 5), (8, 6), (8, 7)]
    assert rows(got.select("doc_id", "text")) == sorted(((i, texts[k]) for i, k in want), key=lambda t: tuple((x is None, str(x)) for x in t))
    one = [(None, texts[0]), (4, texts[1]), (None, texts[1])]  # a single group without ids
    assert rows(simhash.near_dedup(spark.createDataFrame(one, "doc_id long, text string"))) == [(4, texts[1]), (None, texts[0])]


def brute_removed(texts):
    data = [(t or "").encode() for t in texts]
    seen = Counter(b[p:p + 200] for b in data for p in range(len(b) - 199))
    out = []
    for b in data:
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - 199):
            if seen[b[p:p + 200]] > 1:
                gone[p:p + 200] = True
        runs = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out.append((len(b), int(gone.sum()), runs, hashlib.sha256(bytes(np.frombuffer(b, np.uint8)[~gone])).hexdigest()))
    return out


def planted(n=120, seed=2):
    """Texts with passages of 150 to 400 bytes at all distances, copies, periods, and one very common passage."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé ") for _ in range(rng.randint(2, 8)))
    text = lambda k: " ".join(word() for _ in range(k))
    passages = [text(60)[:rng.randint(150, 400)] for _ in range(6)]
    out = []
    for k in range(n):
        t = text(rng.randint(5, 80))
        for _ in range(rng.randint(0, 2)):
            t += rng.choice(passages) + text(rng.randint(0, 30))
        if k % 3 == 0:
            t += passages[0] + text(10)
        if k % 17 == 0:
            t += "ab" * rng.randint(90, 300)
        if k % 11 == 0 and out:
            t = rng.choice(out)
        if k % 13 == 0 and out:
            t = rng.choice(out)[: rng.randint(100, 900)] + text(5)
        out.append(t)
    return out


@pytest.mark.parametrize("bucket", [512, 3])
def test_removed_bytes_equal_brute_force(spark, monkeypatch, bucket):
    monkeypatch.setattr(substrings, "BUCKET", bucket)
    monkeypatch.setattr(substrings, "BLOCK", 1500)  # long texts in several parts
    texts = planted() + [None, "", "x" * 199, "x" * 200, "y" * 201, "é" * 99, "é" * 150]
    docs = spark.createDataFrame([(k // 2 if k % 10 == 0 else k + 1000, t) for k, t in enumerate(texts)], "doc_id long, text string")
    mine = substrings.remove_repeats(with_clashes(docs.repartition(3)))
    want = sorted((k // 2 if k % 10 == 0 else k + 1000, *r) for k, r in enumerate(brute_removed(texts)))
    assert sorted(tuple(r) for r in mine.collect()) == want


def test_removal_of_awkward_rows(spark):
    mine = rows(substrings.remove_repeats(awkward(spark)))
    texts = [r["text"] for r in awkward(spark).collect()]
    ids = [r["doc_id"] for r in awkward(spark).collect()]
    want = sorted(((i, *r) for i, r in zip(ids, brute_removed([t if t is None or len(t) < 20_000 else t for t in texts]), strict=True)),
                  key=lambda t: tuple((x is None, str(x)) for x in t))
    assert mine == want
    assert substrings.remove_repeats(awkward(spark).limit(0)).count() == 0


def test_cover_holds_a_sample_of_equal_windows_at_equal_places():
    rng = np.random.default_rng(5)
    data = rng.integers(97, 100, 4000).astype(np.uint8)
    data[2500:3100] = data[300:900]
    start, count, spot, rank, _ = suffix.cover_runs(data, np.array([2000, 4000]), 200, 48)
    sample = {}
    for s, c, p, r in zip(start, count, spot, rank, strict=True):
        for k in range(s, s + c):
            sample[int(k)] = (int(p) - int(k), int(r))
    assert set(sample) == set(range(0, 1801)) | set(range(2000, 3801))
    assert all(sample[k] == sample[k + 2200] for k in range(300, 700))
