"""Exact removal of long repeated byte strings, by bucketed suffixes and ranks of a cover's samples.

A byte goes if a string of ``LENGTH`` bytes that covers it starts anywhere else too. Only suffixes whose
first ``LENGTH`` bytes repeat matter, so suffixes are compared to that depth, one bucket at a time:

* A cover of every text is sampled so that two equal windows of ``LENGTH`` bytes always hold samples
  with equal distances to their starts. (A difference cover does this by positions; this one picks, out
  of each window, the position of its least gram hash: a fifth of the samples for the same promise.)
* The samples' ranks are fingerprints of their grams. Samples whose rank no other one has are dropped, and
  with them all suffixes that they stand for.
* Suffixes are put in buckets by their sample's rank. Long ties are resolved without reading on: a run
  of neighbouring suffixes whose whole stretch has the rank of another run's is settled at once;
  only the others' bytes are fetched, and their windows compared within the bucket, at equal distances from
  the sample.

A bucket with more than ``BUCKET`` different stretches is not held by one task: its windows' ranks are
dealt out by value, each task's ranks once, and come back if another task or row has them too.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import cut, id_as_text, id_back, read, stage
from orderlens.llm.suffix import cover_runs, fingerprints, mix, prefixes

LENGTH = 200
GRAM = 48
#: different stretches of a bucket that one task compares
BUCKET = 512
#: bytes of text taken together; longer texts are read in parts that overlap by a window
BLOCK = 1 << 21

_U = np.uint64


def _bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _parts(texts: list[bytes]) -> Iterator[tuple[list[int], list[int], bytes, np.ndarray]]:
    """Blocks of texts: rows, offset of each part in its text, the bytes, and where each part ends. Parts of a
    long text share ``LENGTH - 1`` bytes, so each window is in one of them."""
    rows, offsets, parts, size = [], [], [], 0
    for k, t in enumerate(texts):
        for at in range(0, max(1, len(t) - LENGTH + 1), BLOCK):
            part = t[at:at + BLOCK + LENGTH - 1]
            rows.append(k)
            offsets.append(at)
            parts.append(part)
            size += len(part)
            if size >= BLOCK:
                yield rows, offsets, b"".join(parts), np.cumsum([len(p) for p in parts])
                rows, offsets, parts, size = [], [], [], 0
    if rows:
        yield rows, offsets, b"".join(parts), np.cumsum([len(p) for p in parts])


def _key_type(docs: DataFrame) -> str:
    return docs.schema["doc_id"].dataType.simpleString()


def _samples(docs: DataFrame) -> DataFrame:
    """(doc_id, th, rank, stretch, at): a row per run of windows with one sample. ``at`` packs the first
    window's start, the sample's distance from it and the number of windows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            ids, ths = b["doc_id"].to_numpy(), b["th"].to_numpy()
            for rows, offsets, data, ends in _parts([_bytes(t) for t in b["text"]]):
                start, count, spot, rank, stretch = cover_runs(np.frombuffer(data, np.uint8), ends, LENGTH, GRAM)
                if not len(start):
                    continue
                part = np.searchsorted(ends, start, side="right")
                begin = np.concatenate([[0], ends[:-1]])[part]
                row = np.array(rows)[part]
                s = start - begin + np.array(offsets)[part]
                yield pd.DataFrame({"doc_id": ids[row], "th": ths[row], "rank": rank.view(np.int64),
                                    "stretch": stretch.view(np.int64), "at": s << 32 | (spot - start) << 16 | count})

    return docs.mapInPandas(run, f"doc_id {_key_type(docs)}, th long, rank long, stretch long, at long")


def covered(n: int, spans: np.ndarray) -> list[tuple[int, int]]:
    """The maximal runs that spans (rows of start, end) cover."""
    out: list[tuple[int, int]] = []
    for a, b in spans[np.argsort(spans[:, 0], kind="stable")].tolist():
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], b)
        else:
            out.append((a, b))
    return out


def _result(text: bytes, spans: np.ndarray) -> tuple[int, int, int, str]:
    """n_bytes, n_removed, n_spans and the digest of what is kept."""
    runs = covered(len(text), spans)
    kept, at = hashlib.sha256(), 0
    for a, b in runs:
        kept.update(text[at:a])
        at = b
    kept.update(text[at:])
    return len(text), sum(b - a for a, b in runs), len(runs), kept.hexdigest()


def _spans_of(at: np.ndarray) -> np.ndarray:
    start, count = at >> 32, at & 0xFFFF
    return np.column_stack([start, start + count - 1 + LENGTH])


def _window_ranks(rank: np.ndarray, at: np.ndarray, stretches: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A rank for every window of the stretches (of its bucket, its distance to the sample and its bytes), the
    row it belongs to and its number there."""
    data = np.frombuffer(b"".join(stretches), np.uint8)
    sums = prefixes(data)
    size = np.array([len(s) for s in stretches])
    begin = np.cumsum(size) - size
    count = at & 0xFFFF
    row = np.repeat(np.arange(len(at)), count)
    nr = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    distance = (at >> 16 & 0xFFFF)[row] - nr
    windows = fingerprints(sums, begin[row] + nr, LENGTH)
    return mix(mix(windows + mix(distance.astype(np.uint64))) ^ rank.view(np.uint64)[row]), row, nr


def _runs(row: np.ndarray, nr: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of neighbouring repeated windows, as row, start and end of the bytes that they cover."""
    if not len(row):
        z = np.zeros(0, np.int64)
        return z, z, z
    new = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (nr[1:] != nr[:-1] + 1)])
    last = np.r_[new[1:], len(row)] - 1
    base = at[row[new]] >> 32
    return row[new], base + nr[new], base + nr[last] + LENGTH


def _repeated(keys: np.ndarray) -> np.ndarray:
    """Which values occur more than once."""
    order = np.argsort(keys, kind="stable")
    s = keys[order]
    same = np.r_[False, s[1:] == s[:-1]]
    out = np.zeros(len(keys), bool)
    out[order] = same | np.r_[same[1:], False]
    return out


def _in_buckets(members: DataFrame) -> DataFrame:
    """Spans (doc_id, th, start, end) of open members' windows that another member of their bucket has."""
    kind = _key_type(members)
    n = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def search(b: pd.DataFrame) -> pd.DataFrame:
        at = b["at"].to_numpy()
        ranks, row, nr = _window_ranks(b["rank"].to_numpy(), at, list(b["bytes"]))
        hit = _repeated(ranks) & b["open"].to_numpy(bool)[row]
        r, a, e = _runs(row[hit], nr[hit], at)
        return pd.DataFrame({"doc_id": b["doc_id"].to_numpy()[r], "th": b["th"].to_numpy()[r], "start": a, "end": e})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept: list[pd.DataFrame] = []
        for b in batches:
            for lo in range(0, len(b), 4096):
                kept.append(b.iloc[lo:lo + 4096])
                all_ = pd.concat(kept, ignore_index=True) if len(kept) > 1 else kept[0]
                rank = all_["rank"].to_numpy()
                last = int(np.searchsorted(rank, rank[-1]))  # the last bucket may go on
                if last:
                    yield search(all_.iloc[:last])
                kept = [all_.iloc[last:]]
        if kept and len(kept[0]):
            yield search(kept[0])

    dealt = members.repartition(n, "rank").sortWithinPartitions("rank")
    return dealt.select("doc_id", "th", "rank", "at", "open", "bytes").mapInPandas(
        run, f"doc_id {kind}, th long, start long, end long")


def _in_large_buckets(members: DataFrame) -> DataFrame:
    """The same spans for buckets of any size. Members are dealt to sources by hash; a source sends each
    window rank once to the task that its value names, with a mark if it has it twice, and gets back
    those that more than one source, or one twice, has."""
    kind = _key_type(members)
    n = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    members = members.select("doc_id", "th", "rank", "at", "open", "bytes", F.pmod(F.xxhash64("rank", "stretch"), F.lit(4 * n)).alias("source"))

    def by(key: str, batches: Iterator[pd.DataFrame]) -> Iterator[tuple[int, pd.DataFrame]]:
        """The groups of rows that are sorted by ``key``."""
        kept: list[pd.DataFrame] = []
        for b in batches:
            for value, g in b.groupby(key, sort=False):
                if kept and kept[0][key].iloc[0] != value:
                    yield kept[0][key].iloc[0], pd.concat(kept, ignore_index=True)
                    kept = []
                kept.append(g)
        if kept:
            yield kept[0][key].iloc[0], pd.concat(kept, ignore_index=True)

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for source, g in by("source", batches):
            ranks, _, _ = _window_ranks(g["rank"].to_numpy(), g["at"].to_numpy(), list(g["bytes"]))
            ranks, times = np.unique(ranks, return_counts=True)
            to = (ranks % _U(n)).astype(np.int64)
            order = np.argsort(to, kind="stable")
            to, ranks, times = to[order], ranks[order], times[order]
            for part in np.split(np.arange(len(to)), np.flatnonzero(np.diff(to)) + 1):
                if len(part):
                    yield pd.DataFrame({"target": [to[part[0]]], "source": [source], "ranks": [ranks[part].tobytes()],
                                        "twice": [np.packbits(times[part] > 1).tobytes()]})

    def answer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, g in by("target", batches):
            ranks = [np.frombuffer(x, np.uint64) for x in g["ranks"]]
            all_ = np.concatenate(ranks)
            twice = np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=len(r)).astype(bool)
                                    for x, r in zip(g["twice"], ranks, strict=True)])
            hit = _repeated(all_) | twice
            ends = np.cumsum([len(r) for r in ranks])
            for source, part, h in zip(g["source"], ranks, np.split(hit, ends[:-1]), strict=True):
                if h.any():
                    yield pd.DataFrame({"source": [source], "ranks": [part[h].tobytes()]})

    def receive(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, g in by("source", batches):
            is_answer = g["ranks"].notna().to_numpy()
            if not is_answer.any():
                continue
            known = np.sort(np.concatenate([np.frombuffer(x, np.uint64) for x in g["ranks"][is_answer]]))
            m = g[~is_answer]
            at = m["at"].to_numpy(np.int64)
            ranks, row, nr = _window_ranks(m["rank"].to_numpy(np.int64), at, list(m["bytes"]))
            where = np.minimum(np.searchsorted(known, ranks), len(known) - 1)
            hit = (known[where] == ranks) & m["open"].to_numpy(bool)[row]
            r, a, e = _runs(row[hit], nr[hit], at)
            yield pd.DataFrame({"doc_id": m["doc_id"].to_numpy()[r], "th": m["th"].to_numpy(np.int64)[r], "start": a, "end": e})

    members = stage(members, "substrings-large")
    sent = members.repartition(n, "source").sortWithinPartitions("source").mapInPandas(
        send, "target long, source long, ranks binary, twice binary")
    answers = sent.repartition(n, "target").sortWithinPartitions("target").mapInPandas(answer, "source long, ranks binary")
    # no NULL numbers: pandas would turn the column to floating point and lose the last bits
    answers = answers.select(F.lit(None).cast(kind).alias("doc_id"), *[F.lit(0).cast("long").alias(c) for c in ("th", "rank", "at")],
                             F.lit(False).alias("open"), F.lit(None).cast("binary").alias("bytes"), "source", "ranks")
    both = members.withColumn("ranks", F.lit(None).cast("binary")).unionByName(answers)
    return both.repartition(n, "source").sortWithinPartitions("source").mapInPandas(
        receive, f"doc_id {kind}, th long, start long, end long")


_STATE = "n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    Positions are bytes of UTF-8; cuts may fall inside a character. NULL counts as empty; texts below
    ``LENGTH`` bytes lose nothing; long texts are read whole, in parts; a repeated row repeats all its
    strings, so of each such row all goes that is long enough; no rows: no rows. Columns besides doc_id
    and text are not read. Texts with one doc_id are told apart by a 64-bit hash.
    """
    id_kind, docs = _key_type(docs), id_as_text(docs.select("doc_id", "text"))
    kind = "string"
    # only where ids repeat do texts have to be told apart
    unique = docs.groupBy("doc_id").count().filter("count > 1").isEmpty()
    keyed = docs.select("doc_id", (F.lit(0) if unique else F.xxhash64("text")).cast("long").alias("th"), "text")
    ranks = cut(_samples(keyed).groupBy("rank").count().filter("count > 1").select(F.col("rank").alias("_rank")))
    samples = _samples(keyed)
    found = stage(samples.join(ranks, F.col("rank") == F.col("_rank")).drop("_rank"), "substrings-samples")
    classes = stage(found.groupBy("rank", "stretch").agg(
        F.count(F.lit(1)).alias("times"), F.min(F.struct("doc_id", "th", "at")).alias("one")), "substrings-stretches")
    mixed = cut(classes.groupBy("rank").count().filter("count > 1").select(F.col("rank").alias("_rank"), F.col("count").alias("_n")))
    settled = classes.filter("times > 1").select(F.col("rank").alias("_rank"), F.col("stretch").alias("_stretch"))
    whole = found.join(settled, (F.col("rank") == F.col("_rank")) & (F.col("stretch") == F.col("_stretch")), "left_semi")
    members = classes.join(mixed, F.col("rank") == F.col("_rank")).select(
        "one.doc_id", "one.th", "one.at", "rank", "stretch", (F.col("times") == 1).alias("open"), (F.col("_n") > BUCKET).alias("large"))
    # per document: spans that are settled, and members whose bytes are needed
    per = whole.select("doc_id", "th", "at").unionByName(members, allowMissingColumns=True)
    per = per.groupBy(F.col("doc_id").alias("_id"), F.col("th").alias("_th")).agg(
        F.collect_list(F.struct("at", "rank", "stretch", "open", "large")).alias("found"))

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "th": b["th"], "packed": [zlib.compress(_bytes(t), 1) for t in b["text"]]})

    packed = keyed.mapInPandas(pack, f"doc_id {kind}, th long, packed binary")

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Settled documents' results; the others' texts with their settled spans; the members' bytes."""
        names = ["doc_id", "th", "n_bytes", "n_removed", "n_spans", "kept_sha256", "packed", "spans", "rank", "stretch", "at", "open", "large", "bytes"]
        for b in batches:
            out = []
            for doc_id, th, blob, rows in zip(b["doc_id"], b["th"], b["packed"], b["found"], strict=True):
                text = zlib.decompress(blob)
                rows = [] if rows is None else rows
                spans = _spans_of(np.array([r["at"] for r in rows if r["rank"] is None], np.int64))
                pending = False
                for r in rows:
                    if r["rank"] is not None:
                        pending |= r["open"]
                        a, e = _spans_of(np.array([r["at"]]))[0]
                        out.append((doc_id, th, None, None, None, None, None, None, r["rank"], r["stretch"], r["at"], r["open"], r["large"], text[a:e]))
                if pending:
                    runs = np.array(covered(len(text), spans), np.int64).reshape(-1, 2)
                    out.append((doc_id, th, None, None, None, None, blob, runs.ravel().tolist(), None, None, None, None, None, None))
                else:
                    out.append((doc_id, th, *_result(text, spans), None, None, None, None, None, None, None, None))
            if out:
                f = pd.DataFrame(out, columns=names)
                for c in ("n_bytes", "n_removed", "n_spans", "rank", "stretch", "at"):
                    f[c] = f[c].astype("Int64")
                yield f

    joined = packed.join(per, packed["doc_id"].eqNullSafe(per["_id"]) & (packed["th"] == per["_th"]), "left")
    fetched = stage(joined.select("doc_id", "th", "packed", "found").mapInPandas(
        fetch, f"doc_id {kind}, th long, {_STATE}, packed binary, spans array<long>, rank long, stretch long, at long, "
               "open boolean, large boolean, bytes binary"), "substrings-fetched")
    done = fetched.filter("n_bytes IS NOT NULL").select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    members = fetched.filter("rank IS NOT NULL").select("doc_id", "th", "rank", "stretch", "at", "open", "large", "bytes")
    more = _in_buckets(members.filter("NOT large")).unionByName(_in_large_buckets(members.filter("large")))
    more = more.groupBy(F.col("doc_id").alias("_id"), F.col("th").alias("_th")).agg(
        F.collect_list(F.struct("start", "end")).alias("more"))
    pending = fetched.filter("packed IS NOT NULL").select("doc_id", "th", "packed", "spans")

    def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for doc_id, blob, spans, rows in zip(b["doc_id"], b["packed"], b["spans"], b["more"], strict=True):
                all_ = np.array(spans, np.int64).reshape(-1, 2)
                if rows is not None and len(rows):
                    all_ = np.concatenate([all_, np.array([(r["start"], r["end"]) for r in rows], np.int64)])
                out.append((doc_id, *_result(zlib.decompress(blob), all_)))
            yield pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    rest = pending.join(more, pending["doc_id"].eqNullSafe(more["_id"]) & (pending["th"] == more["_th"]), "left")
    rest = rest.select("doc_id", "packed", "spans", "more").mapInPandas(finish, f"doc_id {kind}, {_STATE}")
    return id_back(done.unionByName(rest), id_kind)


def op8_substrings(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(read(spark, sf_dir, "documents"))
