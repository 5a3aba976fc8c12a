"""Benchmark decontamination by template windows.

Texts are brought to a template: numbers, names and units become typed placeholders, other words are
lower-cased. A capitalised word that opens a sentence, line, quotation or bracket may be a name or not; it
is read both ways, and a window matches if one of its readings does. The windows of five template words of every benchmark item are hash-joined with those of
the documents. A window of placeholders only is no evidence and counts on neither side. An item with too few words beside its
placeholders (a table of numbers) has no template to go by: its windows hold the values themselves, and only equal values match. A document that holds 0.8 or more of an item's windows is checked slot by slot: what the
document has in place of the item's numbers, names and units must be a consistent renaming (a value
always replaced by the same one, different values by different ones). If the document holds the template
several times, one place that is consistent is enough. Unchanged values make the leak
``exact``, consistently changed ones ``reparameterised``; others are no leak.
"""

from __future__ import annotations

import bisect
import itertools
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from orderlens.llm.common import cut, read, with_row_key

WINDOW = 5
CONTAINED = 0.8
#: share of an item's matched slots that may contradict the renaming
SLACK = 1 - CONTAINED
#: share of an item's template words that must be words, not placeholders; an item below it is read by its values
LITERAL = 0.25
#: placeholders in a window that is read by its values
VALUED = 3
#: benchmark windows up to which the table of them is sent to every task (about 100 bytes each)
BROADCAST_WINDOWS = 1_000_000

NUM, NAME, UNIT = "", "", ""
#: before a word that may be a name
OPEN = "\ue0ff"
#: before the value of a slot, in windows read by values
VALUE = "\ue0fe"
MARKS = frozenset((NUM, NAME, UNIT))
# units, written after a number
UNITS = ("km", "m", "cm", "mm", "mi", "miles", "mile", "ft", "feet", "foot", "inches", "inch", "yards", "kg", "g", "mg",
         "lb", "lbs", "pounds", "pound", "oz", "tons", "l", "ml", "liters", "litres", "gallons", "s", "sec", "seconds",
         "second", "min", "minutes", "minute", "h", "hours", "hour", "days", "day", "weeks", "week", "months", "month",
         "years", "year", "percent", "dollars", "dollar", "cents", "euros", "euro", "degrees", "mph", "kmh", "watts")
_NUMBER = re.compile(rf"(?<!\w)(?P<n>\d+(?:[.,:/]\d+)*)(?!\d)(?:\s?(?P<u>%|°|€|\$|(?:{'|'.join(UNITS)})\b))?", re.IGNORECASE)
_DIGIT = re.compile(r"\d")
_CAPITAL = re.compile(r" ([A-ZÀ-ÖØ-Þ][a-zß-öø-ÿ]\w*)")
_OPENING = re.compile(r"[A-ZÀ-ÖØ-Þ](?<!\w.)[a-zß-öø-ÿ]")
_MARKS = re.compile(f"[{NUM}{NAME}{UNIT}{OPEN}{VALUE}]")
_WORD = re.compile(rf"{OPEN}?\w+|[{NUM}{NAME}{UNIT}]")
_PRIME = 0x9E3779B97F4A7C15


def _spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, placeholder) of the slots: numbers, units behind them, and names. A name is a capitalised (not all-capital)
    word that goes on a sentence, behind a word and at most a comma."""
    out = []
    for m in _CAPITAL.finditer(text):
        at = m.start()
        before = text[at - 2:at - 1] if text[at - 1:at] == "," else text[at - 1:at]
        if at and before.isalnum():
            out.append((m.start(1), m.end(), NAME))
    if _DIGIT.search(text):
        for m in _NUMBER.finditer(text):
            out.append((*m.span("n"), NUM))
            if m["u"] is not None:
                out.append((*m.span("u"), UNIT))
        out.sort()
    return out


def _read(text: str | None) -> tuple[list[str], list[int]]:
    """The template words of a text, and the places of those that may be names: capitalised words that go on no sentence."""
    text = _MARKS.sub(" ", text or "")
    parts, at = [], 0
    for start, end, mark in _spans(text):
        parts += [text[at:start], " ", mark, " "]
        at = end
    parts.append(text[at:])
    words = _WORD.findall(_OPENING.sub(rf"{OPEN}\g<0>", "".join(parts)).lower())
    opens = [k for k, w in enumerate(words) if w[0] == OPEN]
    for k in opens:
        words[k] = words[k][1:]
    return words, opens


def template(text: str | None) -> list[str]:
    """The template words of a text, a word that may be a name as it stands; none for NULL."""
    return _read(text)[0]


def slots(text: str | None) -> list[str]:
    """The values of the template's slots, in order."""
    text = _MARKS.sub(" ", text or "")
    return [text[start:end].lower() for start, end, _ in _spans(text)]


def _by_values(words: list[str]) -> bool:
    """Whether an item has too few words beside its placeholders to be known by its template."""
    return sum(w not in MARKS for w in words) < LITERAL * len(words)


def _valued(words: list[str], values: list[str]) -> tuple[list[str], np.ndarray]:
    """The template words with the slots' values instead of the placeholders, and the starts of the windows of ``VALUED``
    placeholders or more."""
    value = iter(values)
    slot = np.array([w in MARKS for w in words], bool)
    filled = [f"{VALUE}{next(value)}" if m else w for w, m in zip(words, slot, strict=True)]
    return filled, np.flatnonzero(_per_window(slot) >= VALUED)


def _per_window(slot: np.ndarray) -> np.ndarray:
    """The placeholders in every window."""
    total = np.concatenate([[0], np.cumsum(slot)])
    return total[WINDOW:] - total[:-WINDOW]


def _word_hash(word: str) -> int:
    return xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass")) | 1


def window_hashes(words: np.ndarray, width: int = WINDOW) -> np.ndarray:
    """A hash for every window of ``width`` word hashes."""
    n = len(words) - width + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(width):
        out = (out + words[k:k + n]) * np.uint64(_PRIME)
        out ^= out >> np.uint64(29)
    return out


#: for each set of places in a window (as bits), its non-empty subsets
_SUBSETS = np.array([[c if c & m == c else 0 for c in range(1, 1 << WINDOW)] for m in range(1 << WINDOW)])
_PLACES = np.arange(WINDOW)
_BITS = np.array([bin(c).count("1") for c in range(1 << WINDOW)])


def _readings(plain: np.ndarray, slot: np.ndarray, opens: list[int], name: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(places, hashes) of the windows of word hashes as they stand, and of those with some words of ``opens`` read as names,
    for every choice of such words. Windows with a word hash 0, and of placeholders (``slot``) only, are left out."""
    n = len(plain) - WINDOW + 1
    known = plain != 0
    marks = _per_window(slot)

    def whole(known: np.ndarray) -> np.ndarray:
        out = known[:n].copy()
        for k in range(1, WINDOW):
            out &= known[k:k + n]
        return np.flatnonzero(out)

    at = whole(known)
    at = at[marks[at] < WINDOW]
    out = [(at, window_hashes(plain)[at] if len(at) else np.zeros(0, np.uint64))]
    if not opens:
        return out
    may = np.zeros(len(plain), np.int64)
    may[opens] = 1
    at = whole(known | (may != 0))
    mask = may[at]
    for k in range(1, WINDOW):
        mask |= may[at + k] << k
    choices = _SUBSETS[mask]
    row, col = np.nonzero(choices)
    if not len(row):
        return out
    at, choice = at[row], choices[row, col]
    words = plain[at[:, None] + _PLACES]
    words[(choice[:, None] >> _PLACES & 1).astype(bool)] = name
    ok = (words != 0).all(axis=1) & (marks[at] + _BITS[choice] < WINDOW)
    at, words = at[ok], words[ok]
    hs = np.zeros(len(at), np.uint64)
    for k in range(WINDOW):
        hs = (hs + words[:, k]) * np.uint64(_PRIME)
        hs ^= hs >> np.uint64(29)
    return [*out, (at, hs)]


def _short_readings(words: list[str], opens: list[int]) -> Iterator[tuple[str, ...]]:
    """A short text's template words, for every choice of words in ``opens`` to read as names."""
    for choice in itertools.product(*[(w, NAME) if k in opens else (w,) for k, w in enumerate(words)]):
        yield choice


@dataclass
class Item:
    item_id: object
    words: list[str]
    opens: frozenset[int]
    values: list[str]
    hashes: list[int]  # of the windows as they stand
    n_windows: int  # different ones that count


@dataclass
class Index:
    """The benchmark's windows: hash -> (item, position)."""

    items: list[Item] = field(default_factory=list)
    at: dict[int, list[tuple[int, int]]] = field(default_factory=lambda: defaultdict(list))
    vocabulary: dict[str, int] = field(default_factory=dict)
    short: dict[tuple[str, ...], list[int]] = field(default_factory=lambda: defaultdict(list))
    hashes: np.ndarray | None = None
    #: windows of items read by their values: hash -> items
    valued: dict[int, list[int]] = field(default_factory=lambda: defaultdict(list))
    valued_words: dict[str, int] = field(default_factory=dict)
    valued_hashes: np.ndarray | None = None

    @classmethod
    def of(cls, rows: list[tuple[object, str | None]]) -> Index:
        ix = cls()
        name = ix.vocabulary.setdefault(NAME, _word_hash(NAME))
        for item_id, text in rows:
            words, opens = _read(text)
            if not words:
                continue
            k = len(ix.items)
            if len(words) < WINDOW:
                for reading in _short_readings(words, opens):
                    ix.short[reading].append(k)
                ix.items.append(Item(item_id, words, frozenset(opens), slots(text), [], 0))
                continue
            values = slots(text)
            if _by_values(words):
                filled, at = _valued(words, values)
                for w in filled:
                    ix.valued_words.setdefault(w, _word_hash(w))
                hs = window_hashes(np.array([ix.valued_words[w] for w in filled], np.uint64))[at].tolist()
                for h in set(hs):
                    ix.valued[h].append(k)
                ix.items.append(Item(item_id, words, frozenset(opens), values, hs, len(set(hs))))
                continue
            for w in words:
                ix.vocabulary.setdefault(w, _word_hash(w))
            plain = np.array([ix.vocabulary[w] for w in words], np.uint64)
            slot = np.array([w in MARKS for w in words], bool)
            for places, hs in _readings(plain, slot, opens, name):
                for q, h in zip(places.tolist(), hs.tolist(), strict=True):
                    ix.at[h].append((k, q))
            hs = window_hashes(plain)
            counted = len(np.unique(hs[_per_window(slot) < WINDOW]))
            ix.items.append(Item(item_id, words, frozenset(opens), values, hs.tolist(), counted))
        ix.hashes = np.array(sorted(ix.at), np.uint64)
        ix.valued_hashes = np.array(sorted(ix.valued), np.uint64)
        return ix

    def _equal_values(self, words: list[str], values: list[str]) -> list[tuple[object, float, str]]:
        """The items read by their values that the text holds: all are ``exact``."""
        filled, at = _valued(words, values)
        if not len(at):
            return []
        get = self.valued_words.get
        ids = np.fromiter((get(w, 0) for w in filled), np.uint64, len(filled))
        known = np.concatenate([[0], np.cumsum(ids != 0)])
        at = at[known[at + WINDOW] - known[at] == WINDOW]
        if not len(at):
            return []
        hs = np.intersect1d(window_hashes(ids)[at], self.valued_hashes)
        held = Counter(k for h in hs.tolist() for k in self.valued[h])
        return [(self.items[k].item_id, n / self.items[k].n_windows, "exact") for k, n in held.items()
                if n >= CONTAINED * self.items[k].n_windows]

    def leaks(self, text: str | None) -> list[tuple[object, float, str]]:
        """(item_id, share of the item's windows, kind) of the items that the text holds."""
        words, opens = _read(text)
        if len(words) < WINDOW:
            found = sorted({k for reading in _short_readings(words, opens) for k in self.short.get(reading, ())})
            return [(self.items[k].item_id, 1.0, kind) for k in found
                    if (kind := _kind(self.items[k], words, frozenset(opens), slots(text), [(0, 0)]))]
        out, values, may = [], None, frozenset(opens)
        if len(self.valued_hashes):
            values = slots(text)
            out += self._equal_values(words, values)
        if not len(self.hashes):
            return out
        get = self.vocabulary.get
        ids = np.fromiter((get(w, 0) for w in words), np.uint64, len(words))
        met: dict[int, list[tuple[int, int]]] = defaultdict(list)
        held: dict[int, set[int]] = defaultdict(set)
        plain: dict[int, list[tuple[int, int]]] = defaultdict(list)  # matches without an opening word as a name
        # a placeholder that no item has is an unknown word, whose windows are left out
        slot = np.isin(ids, np.array([self.vocabulary[m] for m in MARKS if m in self.vocabulary], np.uint64))
        for choice, (spots, hs) in enumerate(_readings(ids, slot, opens, self.vocabulary[NAME])):
            if not len(spots):
                continue
            where = np.minimum(np.searchsorted(self.hashes, hs), len(self.hashes) - 1)
            on = self.hashes[where] == hs
            for p, h in zip(spots[on].tolist(), hs[on].tolist(), strict=True):
                for k, q in self.at[h]:
                    own = self.items[k].hashes[q]
                    met[k].append((p, q))
                    held[k].add(own)
                    if not choice and own == h:
                        plain[k].append((p, q))
        for k, found in held.items():
            item = self.items[k]
            least = CONTAINED * item.n_windows
            if len(found) >= least:
                values = slots(text) if values is None else values
                kind = _kind(item, words, may, values, met[k])
                if not kind and len({item.hashes[q] for _, q in plain[k]}) >= least:
                    kind = _kind(item, words, frozenset(), values, plain[k])
                if kind:
                    out.append((item.item_id, len(found) / item.n_windows, kind))
        return out


def _alignments(item: Item, met: list[tuple[int, int]]) -> Iterator[tuple[int, list[tuple[int, int]]]]:
    """(shift, matches) of every way to lay the item on the text: all matches by their most common shift, then the matches of
    each shift alone, and with those of the shifts around it (words put in or left out), if they hold enough windows."""
    count = Counter(p - q for p, q in met)
    most = count.most_common(1)[0][0]
    yield most, met
    if len(count) < 2:
        return
    least = CONTAINED * item.n_windows
    by_shift: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for p, q in met:
        by_shift[p - q].append((p, q))
    shifts, reach = sorted(by_shift), max(1, len(item.words) // 2)

    def enough(some: list[tuple[int, int]]) -> bool:
        return len(some) >= least and len({item.hashes[q] for _, q in some}) >= least

    for s in shifts:
        alone = enough(by_shift[s])
        if alone:
            yield s, by_shift[s]
        low, high = bisect.bisect_left(shifts, s - reach), bisect.bisect_right(shifts, s + reach)
        if high - low > 1 and (alone or sum(len(by_shift[x]) for x in shifts[low:high]) >= least):
            near = [m for x in shifts[low:high] for m in by_shift[x]]
            if alone or enough(near):
                yield s, near


def _kind(item: Item, words: list[str], opens: frozenset[int], values: list[str], met: list[tuple[int, int]]) -> str | None:
    """``exact`` if an alignment of the item with the text has its values, ``reparameterised`` if one renames them
    consistently, None if the slots contradict each other in all. Opening words that differ, or that stand against a name,
    are slots too; with no ``opens``, only what is a slot on both sides."""
    own = np.cumsum([w in MARKS for w in item.words])
    theirs = np.cumsum([w in MARKS for w in words])
    found = None
    for shift, some in _alignments(item, met):
        kind = _kind_at(item, words, opens, values, own, theirs, shift, some)
        if kind == "exact":
            return kind
        found = found or kind
    return found


def _kind_at(item: Item, words: list[str], opens: frozenset[int], values: list[str], own: np.ndarray, theirs: np.ndarray,
             shift: int, met: list[tuple[int, int]]) -> str | None:
    """The kind by one alignment: a word of the item goes with that of the match nearest to ``shift``."""
    partner: dict[int, int] = {}
    width = min(WINDOW, len(item.words))
    for p, q in sorted(met, key=lambda x: abs(x[0] - x[1] - shift)):
        for d in range(width):
            partner.setdefault(q + d, p + d)
    pairs, n = [], 0
    for q, p in sorted(partner.items()):
        a, b = item.words[q], words[p]
        mark = a if a in MARKS else NAME if b == NAME or q in item.opens and p in opens else None
        if mark is None:
            continue
        x = item.values[own[q] - 1] if a in MARKS else a
        y = values[theirs[p] - 1] if b in MARKS else b
        pairs.append((mark, x, y))
        n += a in MARKS or x != y  # equal opening words only bear witness
    if all(a == b for _, a, b in pairs):
        return "exact"
    there: dict[tuple[str, str], str] = {}
    back: dict[tuple[str, str], str] = {}
    bad = 0
    for kind, a, b in pairs:
        bad += there.setdefault((kind, a), b) != b or back.setdefault((kind, b), a) != a
    return "reparameterised" if bad <= SLACK * n else None


LEAKS = "array<struct<item_id:{kind},contained:double,kind:string>>"


def _leaks_column(benchmark: DataFrame):
    """A column function: the leaks in a text, against a benchmark whose size has been checked."""
    rows = [(r["item_id"], r["text"]) for r in benchmark.select("item_id", "text").collect()]
    sent = benchmark.sparkSession.sparkContext.broadcast(rows)
    made: list[Index] = []

    @pandas_udf(LEAKS.format(kind=benchmark.schema["item_id"].dataType.simpleString()))
    def leaks(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        if not made:
            made.append(Index.of(sent.value))
        for s in texts:
            yield pd.Series([[{"item_id": i, "contained": c, "kind": k} for i, c, k in made[0].leaks(t)] for t in s],
                            dtype=object)

    return leaks


def n_windows(benchmark: DataFrame) -> int:
    """An upper bound of the benchmark's windows: its runs of white space and other separators."""
    words = F.size(F.split(F.coalesce("text", F.lit("")), r"[^\p{L}\p{N}_]+"))
    return int(benchmark.agg(F.sum(words)).first()[0] or 0)


def _by_join(ours: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The same leaks for a benchmark of any size, for stored documents (_row, doc_id, text) with a unique _row, which stays:
    window hashes meet in a shuffled join, one row for each different window of a document; only pairs that hold enough
    windows meet with their texts."""

    name = _word_hash(NAME)

    def windows(batches: Iterator[pd.DataFrame], items: bool) -> Iterator[pd.DataFrame]:
        for b in batches:
            for key, text in zip(b["key"], b["text"], strict=True):
                words, opens = _read(text)
                if len(words) < WINDOW:  # matched whole
                    h = np.array([xxhash.xxh64_intdigest("\0".join(x).encode("utf-8", "surrogatepass"))
                                  for x in _short_readings(words, opens) if x], np.uint64)
                    own = h[:1].repeat(len(h))
                else:
                    h = own = np.zeros(0, np.uint64)
                    valued = _by_values(words)
                    if valued or not items:  # an item is read one way, a document both
                        filled, at = _valued(words, slots(text))
                        h = own = np.unique(window_hashes(np.array([_word_hash(w) for w in filled], np.uint64))[at])
                    if not valued or not items:
                        plain = np.array([_word_hash(w) for w in words], np.uint64)
                        alone = window_hashes(plain)
                        found = _readings(plain, np.array([w in MARKS for w in words], bool), opens, name)
                        h = np.concatenate([h, *[x for _, x in found]])
                        own = np.concatenate([own, *[alone[at] for at, _ in found]])
                    h, own = np.unique(np.stack([h, own]), axis=1)
                yield pd.DataFrame({"key": pd.Series([key] * len(h), dtype=b["key"].dtype), "h": h.view(np.int64), "n": len(np.unique(own))})

    def keyed(df: DataFrame, key: str, items: bool) -> DataFrame:
        kind = df.schema[key].dataType.simpleString()
        return df.select(F.col(key).alias("key"), "text").mapInPandas(
            lambda batches: windows(batches, items), f"key {kind}, h long, n long")

    theirs = cut(benchmark.select("item_id", F.col("text").alias("_item")).withColumn("_nr", F.monotonically_increasing_id()))
    # an item has a row for each reading of each of its windows: their count is at least that of the windows held
    d = keyed(ours, "_row", False).select(F.col("key").alias("_row"), "h").distinct()
    b = keyed(theirs.withColumnRenamed("_item", "text"), "_nr", True).select(F.col("key").alias("_nr"), F.col("h").alias("_h"), "n")
    met = d.join(b, F.col("h") == F.col("_h")).groupBy("_row", "_nr", "n").count()
    met = met.filter(F.col("count") >= CONTAINED * F.col("n")).select("_row", "_nr")
    pairs = met.join(theirs, "_nr").join(ours, "_row")
    kind = benchmark.schema["item_id"].dataType.simpleString()

    @pandas_udf("struct<contained:double,kind:string>")
    def judge(items: pd.Series, texts: pd.Series) -> pd.DataFrame:
        found = [Index.of([(0, i)]).leaks(t) for i, t in zip(items, texts, strict=True)]
        return pd.DataFrame({"contained": [x[0][1] if x else None for x in found],
                             "kind": [x[0][2] if x else None for x in found]})

    out = pairs.select("_row", "doc_id", F.col("item_id").cast(kind).alias("item_id"), judge("_item", "text").alias("j"))
    return out.select("_row", "doc_id", "item_id", "j.contained", "j.kind").filter(F.col("kind").isNotNull())


def find_leaks(docs: DataFrame, benchmark: DataFrame, broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """A row per document and benchmark item that it holds: doc_id, item_id, contained, kind.

    NULL and empty texts have no windows and no leaks; a text of fewer than five template words, on
    either side, matches only one with the same whole template; an item of which less than a quarter are words (a table of
    numbers) matches by equal values only; long texts are taken whole; repeated
    rows each give their rows; empty tables: no rows. Columns besides doc_id, text (documents) and
    item_id, text (benchmark) are not read. The benchmark is sent to every task if it has at most
    ``broadcast_windows`` windows, else joined by shuffle.
    """
    if n_windows(benchmark) > broadcast_windows:
        ours = cut(docs.select("doc_id", "text").withColumn("_row", F.monotonically_increasing_id()))
        return _by_join(ours, benchmark).drop("_row")
    leaks = _leaks_column(benchmark)
    rows = docs.select("doc_id", F.explode(leaks("text")).alias("leak"))
    return rows.select("doc_id", "leak.item_id", "leak.contained", "leak.kind")


def drop_leaks(docs: DataFrame, benchmark: DataFrame, broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item; all columns stay.

    Edge cases as in :func:`find_leaks`; rows without a doc_id, or with the same one, go each by their own text.
    """
    if n_windows(benchmark) > broadcast_windows:
        stored, key = with_row_key(docs, "decontaminate-rows")
        bad = _by_join(stored.select(F.col(key).alias("_row"), "doc_id", "text"), benchmark).select(F.col("_row").alias("_bad")).distinct()
        return stored.join(bad, stored[key] == F.col("_bad"), "left_anti").drop(key)
    leaks = _leaks_column(benchmark)
    return docs.filter(F.size(leaks(docs["text"])) == 0)


def op2_decontaminate(spark, sf_dir: str) -> DataFrame:
    return find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
