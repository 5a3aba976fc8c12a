"""Periodic runs of words, found by catching squares online over completed power-of-two blocks.

A run is a stretch of words with smallest period q that no neighbouring word extends. :class:`Catchers` reads a
stream of words in any pieces. Level j keeps a catcher for every completed block of 2**j words: as words are
appended, each new suffix of 2**j words that starts 2**j to 2**(j+1) - 1 words behind the block is compared with it
(the lowest level also compares shorter distances). Equal block and suffix at distance d are half of a square of
period d; it is stretched both ways as far as the words agree, neighbouring squares of one period merge into a
run, and a run that reaches the last word is stretched on by the next append.

Suffixes are compared by rolling 64-bit hashes, so they can catch too much but miss nothing; every run
is held to the words themselves before it is told. Of a text of n words all levels together make n log n
comparisons in numpy; matches inside a run that is known already are left out, so a text of one word repeated is
no worse. Nothing is shuffled: a text is read by one task, with some 60 bytes of arrays a word.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import id_as_text, id_back, read, words_of

MIN_LENGTH, MIN_EXPONENT = 24, 3
#: log2 of the smallest block: periods up to twice its size are caught by it, so a run must be long enough to hold it
LOWEST = 3
#: texts are appended to one stream until it has so many words
STREAM = 1 << 18
#: bytes of a text that are split into words at a time
PIECE = 1 << 22
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the hash's base and of its inverse, modulo 2**64."""
    if len(_powers[0]) < n:
        for k, b in enumerate((_BASE, _INVERSE)):
            p = np.full(max(n, 1 << 16), b, np.uint64)
            p[0] = 1
            _powers[k] = np.cumprod(p, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


def _scrambled(ids: np.ndarray) -> np.ndarray:
    x = ids.astype(np.uint64) + np.uint64(1)
    for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(by)
    return x ^ (x >> np.uint64(31))


class Catchers:
    """The catchers over one stream of word numbers; see the module's text.

    ``longest``: no run is longer than this (the longest text of a stream of several); it bounds the levels.
    """

    def __init__(self, longest: int | None = None, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT):
        if min_exponent < 3 or min_length < 3 << LOWEST:
            raise ValueError("shorter runs need smaller blocks: at least three periods and 24 words")
        self.longest, self.min_length, self.min_exponent = longest, min_length, min_exponent
        self.n = 0
        self.words = np.empty(0, np.int64)
        self.sums = np.zeros(1, np.uint64)  # prefix sums of scrambled words times powers of the base
        self.compared = {}  # level -> first suffix that no catcher has seen
        self.ends: dict[tuple[int, int], int] = {}  # (start, period) -> end, for qualified runs
        self.open: dict[tuple[int, int], int] = {}  # the same for stretches that reach the last word, any length

    def _hash(self, at: np.ndarray, length) -> np.ndarray:
        return (self.sums[at + length] - self.sums[at]) * self._down[at]

    def _stretch(self, i: np.ndarray, j: np.ndarray, step: int) -> np.ndarray:
        """How many words agree before (step -1) or from (step 1) positions i < j on."""
        most = i.copy() if step < 0 else self.n - j
        got = np.zeros(len(i), np.int64)
        by = 1 << max(int(most.max(initial=0)).bit_length() - 1, 0)
        while by and len(i):
            to = got + by
            can = np.flatnonzero(to <= most)
            a, b, t = i[can], j[can], to[can]
            same = self._hash(a - t, t) == self._hash(b - t, t) if step < 0 else self._hash(a, t) == self._hash(b, t)
            got[can[same]] = t[same]
            by >>= 1
        return got

    def _report(self, start: int, end: int, period: int, inside: int) -> None:
        """Note a stretch, after holding it to the words; ``inside`` is a position that surely belongs to it."""
        w = self.words
        if end - start >= max(self.min_length, self.min_exponent * period) and not np.array_equal(
                w[start:end - period], w[start + period:end]):  # a false hash: look at the words alone
            off = np.flatnonzero(w[:self.n - period] != w[period:self.n])
            k = np.searchsorted(off, inside)
            start = int(off[k - 1]) + 1 if k else 0
            end = (int(off[k]) if k < len(off) else self.n - period) + period
        if end == self.n:
            self.open[start, period] = end
        if end - start >= max(self.min_length, self.min_exponent * period):
            self.ends[start, period] = max(end, self.ends.get((start, period), 0))

    def append(self, words: np.ndarray) -> None:
        """Read on. Words are numbers from 0; a negative number that occurs once is a border no run crosses."""
        old, self.n = self.n, self.n + len(words)
        up, self._down = _power_tables(self.n + 1)
        self.words = np.concatenate([self.words, words]) if old else np.asarray(words, np.int64)
        new = np.cumsum(_scrambled(self.words[old:]) * up[old:self.n], dtype=np.uint64)
        self.sums = np.concatenate([self.sums, self.sums[-1] + new])
        if self.open:
            waiting, self.open = list(self.open), {}
            start, period = np.array(waiting, np.int64).T
            at = np.full(len(start), old)
            more = self._stretch(at - period, at, 1)
            for s, p, m in zip(start.tolist(), period.tolist(), more.tolist()):
                self._report(s, old + m, p, s)
        level = LOWEST
        while level == LOWEST or (3 << level) <= min(self.n, self.longest or self.n):
            self._catch(level)
            level += 1

    def _catch(self, level: int) -> None:
        size = 1 << level
        first = self.compared.get(level, 1 if level == LOWEST else size)
        last = self.n - size  # the last suffix of this size that is complete
        if last < first:
            return
        self.compared[level] = last + 1
        at = np.arange(first, last + 1)
        own = self._hash(at, size)
        before = (at >> level) - 1
        low = int(before[0])  # -1 only on the lowest level
        blocks = self._hash(np.arange(max(low, 0), int(before[-1]) + 2) << level, size)
        if low < 0:
            blocks = np.concatenate([blocks[:1], blocks])
        k = np.flatnonzero(own == blocks[before - low])
        starts, suffixes = before[k] << level, at[k]
        if level == LOWEST:
            near = np.flatnonzero((own == blocks[before - low + 1]) & (at & (size - 1) != 0))
            starts = np.concatenate([starts, (before[near] + 1) << level])
            suffixes = np.concatenate([suffixes, at[near]])
            ok = starts >= 0
            starts, suffixes = starts[ok], suffixes[ok]
        if len(starts):
            self._squares(starts, suffixes - starts, size)

    def _squares(self, at: np.ndarray, period: np.ndarray, size: int) -> None:
        """Blocks at ``at`` that occur again ``period`` words on: stretch and merge them."""
        known = sorted((s, e) for (s, p), e in self.ends.items() if p < size)
        if known:  # a match inside a run of a period below the block's size is a multiple of it
            s, e = np.array(known).T
            k = np.searchsorted(s, at, "right") - 1
            reach = np.where(k >= 0, np.maximum.accumulate(e)[k], 0)
            new = at + period + size > reach
            at, period = at[new], period[new]
        if not len(at):
            return
        order = np.lexsort((at, period))
        at, period = at[order], period[order]
        head = np.ones(len(at), bool)
        head[1:] = (period[1:] != period[:-1]) | (at[1:] != at[:-1] + size)
        tail = np.append(head[1:], True)
        first, end, period = at[head], at[tail] + size, period[head]
        left = self._stretch(first, first + period, -1)
        right = self._stretch(end, end + period, 1)
        start, stop = first - left, end + period + right
        ok = (stop - start >= np.maximum(self.min_length, self.min_exponent * period)) | (stop == self.n)
        found, seed = np.unique(np.column_stack([start, stop, period])[ok], axis=0, return_index=True)
        for (s, e, p), inside in zip(found.tolist(), first[ok][seed].tolist()):
            self._report(s, e, p, inside)

    def runs(self) -> list[tuple[int, int, int]]:
        """(start, length, period) of the runs in all words so far, by start and period. A stretch that was
        caught with a multiple of its period counts once, with the smallest."""
        least: dict[tuple[int, int], int] = {}
        for (start, period), end in self.ends.items():
            least[start, end] = min(period, least.get((start, end), period))
        return sorted((s, e - s, p) for (s, e), p in least.items())


class _Numbers(dict):
    """Words numbered as they come; ``words`` leads back."""

    def __init__(self):
        self.words: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        k = self[word] = len(self.words)
        self.words.append(word)
        return k


def _pieces(data: bytes) -> Iterator[list[bytes]]:
    at = 0
    while at < len(data):
        m = _SPACE.search(data, at + PIECE) if len(data) - at > PIECE else None
        to = m.start() if m else len(data)
        yield data[at:to].split()
        at = to + 1


def _numbered(text: str | None, numbers: _Numbers) -> np.ndarray:
    got = [np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)) for words in _pieces((text or "").encode())]
    return np.concatenate(got) if got else np.empty(0, np.int64)


def _stream_runs(texts: list[np.ndarray], min_length: int, min_exponent: int) -> list[list[tuple[int, int, int]]]:
    """The runs of several texts, appended to one stream with a border after each."""
    catchers = Catchers(max(map(len, texts)), min_length, min_exponent)
    catchers.append(np.concatenate([x for k, t in enumerate(texts) for x in (t, np.array([-2 - k]))]))
    offsets = np.cumsum([0] + [len(t) + 1 for t in texts])
    out = [[] for _ in texts]
    for start, length, period in catchers.runs():
        k = int(np.searchsorted(offsets, start, "right")) - 1
        out[k].append((start - int(offsets[k]), length, period))
    return out


def _collapsed(words: np.ndarray, runs: list[tuple[int, int, int]], numbers: _Numbers) -> str:
    edges = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    kept = words[np.cumsum(edges[:-1]) == 0]
    return b" ".join(map(numbers.words.__getitem__, kept.tolist())).decode()


def collapse_runs(docs: DataFrame, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """Per document: doc_id, n_words, ``runs`` (array of start, length, period; by start, then period) and
    ``collapsed``: the words that stay when every run is cut to its first period, joined by one space.

    Runs hold at least ``min_length`` words and ``min_exponent`` periods. NULL, empty and blank texts have no words, no
    runs and an empty ``collapsed``; a text of any length is read whole. Repeated rows and rows without or with the same
    doc_id are documents of their own. Empty table: no rows. Only doc_id and text are read, so no other
    column can clash.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            order = np.argsort(-b["text"].str.len().fillna(0).to_numpy(), kind="stable")  # texts of a size share a stream
            b = b.iloc[order]
            ids, texts = b["doc_id"].tolist(), b["text"].tolist()
            done = 0
            while done < len(texts):
                numbers, group, n = _Numbers(), [], 0
                while done + len(group) < len(texts) and n < STREAM:
                    group.append(_numbered(texts[done + len(group)], numbers))
                    n += len(group[-1]) + 1
                runs = _stream_runs(group, min_length, min_exponent)
                yield pd.DataFrame({
                    "doc_id": ids[done:done + len(group)], "n_words": [len(w) for w in group],
                    "starts": [[r[0] for r in x] for x in runs], "lengths": [[r[1] for r in x] for x in runs],
                    "periods": [[r[2] for r in x] for x in runs],
                    "collapsed": [_collapsed(w, x, numbers) for w, x in zip(group, runs)]})
                done += len(group)

    found = id_as_text(docs.select("doc_id", "text")).mapInPandas(
        run, "doc_id string, n_words long, starts array<long>, lengths array<long>, periods array<long>, collapsed string")
    zipped = F.arrays_zip(F.col("starts").alias("start"), F.col("lengths").alias("length"), F.col("periods").alias("period"))
    return id_back(found, kind).select("doc_id", "n_words", zipped.alias("runs"), "collapsed")


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """The contract's texts: where crc32 of the decimal doc_id ends in 0, the words from a on repeat with period p."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    # a column of its own: used several times below, but split once, and only where it is needed
    split = docs.select("doc_id", "text", F.when(h % 10 == 0, words_of(F.col("text"))).alias("words"))
    n, g = F.size("words").cast("long"), F.floor(h / 10).cast("long")
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    rest = F.size("words") - a
    again = F.flatten(F.array_repeat(F.slice("words", a + 1, p), F.ceil(rest / p).cast("int")))
    planted = F.array_join(F.concat(F.slice("words", F.lit(1), a), F.slice(again, F.lit(1), rest)), " ")
    return split.select("doc_id", F.when(F.size("words") > 0, planted).otherwise(F.col("text")).alias("text"))


def op11_runs(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = collapse_runs(with_planted_runs(docs))
    # quotients of whole numbers below 2**26 differ by more than a double's last digit, or are equal
    best = F.array_min(F.transform("runs", lambda r: F.struct(
        (-(r["length"] / r["period"])).alias("e"), r["start"].alias("start"), r["period"].alias("period"), r["length"].alias("length"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", *[r[c].cast("string") for c in (
        "start", "length", "period")]), F.lit("\n"))), "")
    out = found.withColumn("best", best)
    return out.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
        F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
