"""Periodic runs against brute force."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from awkward import SF, awkward, with_clashes
from pyspark.sql import functions as F

from orderlens.llm import runs


def brute_runs(words, min_length=24, min_exponent=3):
    """All maximal stretches of every period, in decreasing order of work: every period, every position."""
    n, found = len(words), {}
    for q in range(1, n // min_exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(min_length, min_exponent * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def texts():
    rng = random.Random(5)
    out = [[], [7], [1] * 23, [1] * 24, [1] * 500, [1, 2] * 100, list(range(300)), ([1] * 20 + [2]) * 12,
           ([1] * 100 + [2]) * 5, ([1, 2, 1, 3] * 6 + [9] + [1, 2, 1, 3] * 6) * 4]
    a, b = [0], [0, 1]
    while len(b) < 400:
        a, b = b, b + a
    out.append(b)  # Fibonacci word: runs of many periods
    out.append([bin(i).count("1") & 1 for i in range(2048)])  # Thue-Morse: equal polynomial hashes, no cubes
    for _ in range(60):
        w = [rng.randrange(rng.choice([1, 2, 3, 50])) for _ in range(rng.randrange(120))]
        for _ in range(rng.randrange(3)):
            q = rng.choice([1, 2, 3, 5, 7, 8, 9, 15, 16, 17, 31, 33, 60])
            root = [rng.randrange(4) for _ in range(q)]
            w += (root * 9)[:rng.randrange(2 * q, 9 * q)] + [rng.randrange(50) for _ in range(rng.randrange(4))]
        out.append(w)
    return out


def test_runs_equal_brute_force_in_streams_and_alone():
    ws = texts()
    want = [brute_runs(w) for w in ws]
    assert sum(map(len, want)) > 80
    arrays = [np.array(w, np.int64) for w in ws]
    assert runs._stream_runs(arrays, 24, 3) == want
    for a, r in zip(arrays, want):
        assert runs._stream_runs([a], 24, 3) == [r]


@pytest.mark.parametrize("most", [1, 7, 100])
def test_appending_in_pieces_is_the_same(most):
    rng = random.Random(most)
    for w in texts()[::3 if most == 1 else 1]:
        c, at = runs.Catchers(), 0
        while at < len(w):
            k = rng.randint(1, most)
            c.append(np.array(w[at:at + k], np.int64))
            at += k
        assert c.runs() == brute_runs(w)


def test_longer_runs_and_more_periods():
    for w in texts()[:20]:
        c = runs.Catchers(min_length=40, min_exponent=5)
        if w:
            c.append(np.array(w, np.int64))
        assert c.runs() == brute_runs(w, 40, 5)
    with pytest.raises(ValueError):
        runs.Catchers(min_length=10)


def test_false_hashes_are_seen(monkeypatch):
    monkeypatch.setattr(runs, "_scrambled", lambda ids: np.zeros(len(ids), np.uint64))  # every hash is equal
    for w in texts()[4:9]:
        got = set(runs._stream_runs([np.array(w, np.int64)], 24, 3)[0])
        assert got <= set(brute_runs(w))


def test_a_long_text_of_one_word_is_quick():
    assert runs._stream_runs([np.zeros(2_000_000, np.int64)], 24, 3) == [[(0, 2_000_000, 1)]]


def digest(doc_id, text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute_runs(words)
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join(f"{s},{length},{q}\n" for s, length, q in found)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def key(t):
    return tuple((x is None, str(x)) for x in t)


def test_query_equals_brute_force(spark):
    docs = [r for r in spark.read.parquet(f"{SF}/documents.parquet").collect() if len((r["text"] or "").split()) < 3000]
    want = {r["doc_id"]: digest(r["doc_id"], r["text"]) for r in docs}
    got = {r["doc_id"]: tuple(r) for r in runs.op11_runs(spark, SF).collect()}
    assert len(got) == 200 and any(r[1] for r in got.values())
    assert {k: got[k] for k in want} == want


def test_awkward_rows_and_empty_table(spark, tmp_path):
    docs = with_clashes(awkward(spark)).filter("doc_id is null or doc_id <> 7")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in runs.op11_runs(spark, str(tmp_path)).collect()]
    assert sorted(got, key=key) == sorted((digest(r["doc_id"], r["text"]) for r in docs.collect()), key=key)
    assert runs.collapse_runs(docs.limit(0)).count() == 0
    long = awkward(spark).filter("doc_id = 7").withColumn("text", F.concat("text", F.repeat(F.lit(" ha"), 400_000)))
    r = runs.collapse_runs(long).first()
    assert r["runs"][-1]["length"] == 400_000 and r["runs"][-1]["period"] == 1 and r["collapsed"].endswith(" ha")
