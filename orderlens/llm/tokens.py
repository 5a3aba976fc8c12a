"""Token counts by a compiled finite-state transducer.

It rests on a property of byte-pair encoding: tokens ``t1 .. tn`` are the encoding of their text exactly if the encoding
of every two neighbours is those two tokens. So for each prefix of a text only its last token and its count matter. The
vocabulary is compiled once, on the driver, into arrays (:mod:`orderlens.llm.piecearrays`) that are broadcast; their size
depends on the vocabulary alone.

No piece goes on past a space that follows another character, so a text is counted word by word. The words of many
texts that are not known yet go through the arrays side by side; their counts are kept up to ``MAX_WORDS``. A word of
``LONG`` characters or more is read once, with the last tokens of as many prefixes as the longest piece has
characters (:meth:`Transducer.long`), so a text without spaces takes no more memory than its characters.

A chunk of a text is a map: up to its first word border it is kept as characters, behind its last one too, and in
between as a count. Maps compose associatively (:func:`compose`), so chunks are counted each on its own and combined
in a tree. The few words at their seams go through a small transducer whose states are what the last characters leave
open and whose transitions carry the tokens they emit (below zero where a character lets earlier tokens
merge); its states are built when first needed and dropped together above ``MAX_STATES``.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import id_as_text, id_back, read
from orderlens.llm.piecearrays import PieceArrays

MODEL = "piece_bpe_32k.model"
LIMIT = 4096
MAX_STATES = 20_000
MAX_WORDS = 600_000
MAX_PAIRS = 500_000
CHUNK = 1 << 16
#: characters from which a word is read on its own and its count not kept
LONG = 64
#: characters of texts whose words go through the arrays together
TOGETHER = 1 << 21
GAP = "▁"  # the visible space of the vocabulary


def load_pieces(path: str) -> dict[str, float]:
    """The ordinary pieces of a sentencepiece BPE model and their merge scores."""
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=path)
    return {m.id_to_piece(i): m.get_score(i) for i in range(m.get_piece_size())
            if not (m.is_control(i) or m.is_unknown(i) or m.is_byte(i) or m.is_unused(i))}


class _State:
    __slots__ = ("open", "past", "next")

    def __init__(self, open_: str, past: tuple):
        self.open = open_  # the last characters, as far back as a piece can still begin
        self.past = past  # for each place in them: last token before, count (0 at the end), lone gap first
        self.next: dict[str, tuple[_State, int]] = {}


class Transducer:
    """Counts the tokens of words: gaps, if any, followed by other characters, if any."""

    def __init__(self, pieces: dict[str, float], arrays: PieceArrays | None = None):
        self.pieces, self.arrays = pieces, arrays
        self.prefixes = {p[:k] for p in pieces for k in range(1, len(p))}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.own: dict[str, bool] = {}
        self.words: dict[str, int] = {}
        if any(p.strip(GAP) and GAP in p[1:] for p in pieces):
            raise ValueError("a piece of the vocabulary goes on past a space")
        # gaps merge last and from the left, to the longest piece of gaps and a rest
        self.longest = max((len(p) for p in pieces if not p.strip(GAP)), default=1)
        self.reach = max(map(len, pieces), default=1)
        self.rests = [len(self.merged(GAP * k)) for k in range(self.longest)]
        self.clear()

    def gaps(self, n: int) -> int:
        return n // self.longest + self.rests[n % self.longest]

    def clear(self) -> None:
        self.states: dict[tuple, _State] = {}
        self.start = self._state("", ((None, 0, False),))

    def _state(self, open_: str, past: tuple) -> _State:
        key = (open_, past)
        found = self.states.get(key)
        if found is None:
            found = self.states[key] = _State(open_, past)
        return found

    def merged(self, text: str) -> list[str]:
        """The byte-pair encoding of a short text: best score first, then leftmost."""
        parts = list(text)
        get = self.pieces.get
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                s = get(parts[k] + parts[k + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, k
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _fits(self, left: str | None, piece: str) -> bool:
        if len(piece) > 1:
            ok = self.own.get(piece)
            if ok is None:
                ok = self.own[piece] = piece in self.pieces and self.merged(piece) == [piece]
            if not ok:
                return False
        if left is None:
            return True
        ok = self.pairs.get((left, piece))
        if ok is None:
            # a whole piece that is its own encoding is not two
            ok = self.pairs[left, piece] = not self.own.get(left + piece) and self.merged(left + piece) == [left, piece]
        return ok

    def step(self, state: _State, char: str) -> tuple[_State, int]:
        """The transition of a state for a character, which is kept in the state."""
        text, past = state.open + char, state.past
        for k in range(len(text)):
            piece = text[k:]
            left, n, lone = past[k]
            if self._fits(left, piece):
                # a character outside the vocabulary becomes its bytes
                n += 1 if piece in self.pieces else len(piece.encode("utf-8", "surrogatepass"))
                lone = piece == GAP if left is None else lone
                break
        else:
            raise AssertionError(f"no last token for {text!r}")
        past = (*past, (piece, n, lone))
        k = 0
        while k < len(text) and text[k:] not in self.prefixes:
            k += 1
        new = self._state(text[k:], tuple((t, c - n, one) for t, c, one in past[k:]))
        found = state.next[char] = (new, n)
        return found

    def count(self, word: str) -> int:
        """Tokens of ``word``: gaps, then other characters."""
        found = self.words.get(word)
        if found is not None:
            return found
        body = word.lstrip(GAP)
        gaps = len(word) - len(body)
        if not body:
            n = self.gaps(gaps)
        elif len(word) >= LONG:
            n, lone = self.long(word[max(gaps - 1, 0):])
            n += self._before(gaps, lone)
        else:
            state, n, step = self.start, 0, self.step
            for char in word[max(gaps - 1, 0):]:  # the last gap belongs to the word
                move = state.next.get(char)
                state, more = step(state, char) if move is None else move
                n += more
            n += self._before(gaps, state.past[-1][2])
        if len(self.states) > MAX_STATES:
            self.clear()
        if len(self.words) > MAX_WORDS:
            self.words.clear()
        if len(self.pairs) > MAX_PAIRS:
            self.pairs.clear()
        if len(word) < LONG:
            self.words[word] = n
        return n

    def _before(self, gaps: int, lone: bool) -> int:
        """Tokens of the gaps before a word's last one; a last gap that no piece of the word takes joins them."""
        return 0 if gaps < 2 else self.gaps(gaps) - 1 if lone else self.gaps(gaps - 1)

    def long(self, text: str) -> tuple[int, bool]:
        """Tokens of a word of any length, and whether its first is a lone gap: one reading with the last tokens of the
        last few prefixes."""
        past: deque = deque([(None, 0, False)], maxlen=self.reach)  # as in a state: last token before, count, lone gap first
        for i in range(len(text)):
            for k in range(min(len(past), i + 1), 0, -1):
                piece = text[i + 1 - k:i + 1]
                if k > 1 and piece not in self.pieces:
                    continue
                left, n, lone = past[-k]
                if self._fits(left, piece):
                    n += 1 if piece in self.pieces else len(piece.encode("utf-8", "surrogatepass"))
                    past.append((piece, n, piece == GAP if left is None else lone))
                    break
            else:
                raise AssertionError(f"no last token at {i}")
            if len(self.pairs) > MAX_PAIRS:
                self.pairs.clear()
        return past[-1][1:]

    def learn(self, words: Iterable[str]) -> None:
        """Count words that are not known yet, all together."""
        new = [w for w in words if w not in self.words and len(w) < LONG and w.strip(GAP)]
        if self.arrays is None or not new:
            return
        gaps = [len(w) - len(w.lstrip(GAP)) for w in new]
        counts, lone = self.arrays.count([w[max(g - 1, 0):] for w, g in zip(new, gaps)])
        self.words.update((w, n + self._before(g, one)) for w, g, n, one in zip(new, gaps, counts.tolist(), lone.tolist()))


_WORD = re.compile(f"{GAP}*[^{GAP}]+|{GAP}+")


@dataclass(frozen=True)
class ChunkMap:
    """What a chunk does: ``head`` and ``tail`` are characters that belong to words which may begin before
    or go on behind it. A chunk without a point at which states fall back is all head."""

    head: str
    count: int
    tail: str | None  # None: no such point in the chunk


def chunk_map(t: Transducer, text: str) -> ChunkMap:
    """The map of a chunk of escaped text (its spaces are gaps)."""
    return _map_of(t, _WORD.findall(text))


def _map_of(t: Transducer, words: list[str]) -> ChunkMap:
    if len(words) < 2:
        return ChunkMap("".join(words), 0, None)
    get = t.words.get
    return ChunkMap(words[0], sum(c if (c := get(w)) is not None else t.count(w) for w in words[1:-1]), words[-1])


def compose(t: Transducer, a: ChunkMap, b: ChunkMap) -> ChunkMap:
    """The map of ``a`` followed by ``b``; associative."""
    if a.tail is None or b.tail is None:
        # one of them is part of one word, or of two where a gap begins at the seam
        m = chunk_map(t, (a.head if a.tail is None else a.tail) + b.head)
        if a.tail is None and b.tail is None:
            return m
        if a.tail is None:
            return ChunkMap(m.head, b.count, b.tail) if m.tail is None else ChunkMap(
                m.head, m.count + t.count(m.tail) + b.count, b.tail)
        return ChunkMap(a.head, a.count, m.head) if m.tail is None else ChunkMap(
            a.head, a.count + t.count(m.head) + m.count, m.tail)
    seam = sum(t.count(w) for w in _WORD.findall(a.tail + b.head))
    return ChunkMap(a.head, a.count + seam + b.count, b.tail)


def chunk_words(text: str | None, chunk: int = CHUNK) -> list[list[str]]:
    """The words of every chunk of a text, which begins with a gap."""
    return [_WORD.findall((GAP if at == 0 else "") + text[at:at + chunk].replace(" ", GAP)) for at in range(0, len(text or ""), chunk)]


def combined(t: Transducer, chunks: list[list[str]]) -> int:
    """Tokens of a text by the words of its chunks."""
    if not chunks:
        return 0
    maps = [_map_of(t, words) for words in chunks]
    while len(maps) > 1:  # the scan's tree: neighbours in pairs
        maps = [compose(t, maps[k], maps[k + 1]) if k + 1 < len(maps) else maps[k] for k in range(0, len(maps), 2)]
    m = maps[0]
    return t.count(m.head) + m.count + (t.count(m.tail) if m.tail is not None else 0)


def count_tokens(t: Transducer, text: str | None, chunk: int = CHUNK) -> int:
    """Tokens of a whole text, without begin or end tokens; 0 for NULL and the empty text."""
    return combined(t, chunk_words(text, chunk))


def count_all(t: Transducer, texts: list[str | None]) -> list[int]:
    """Tokens of many texts; the new words of ``TOGETHER`` characters of them are counted at a time."""
    out, at = [], 0
    while at < len(texts):
        chunks, size = [], 0
        while at + len(chunks) < len(texts) and size < TOGETHER:
            text = texts[at + len(chunks)]
            chunks.append(chunk_words(text))
            size += len(text or "")
        if len(t.words) > MAX_WORDS:
            t.words.clear()
        t.learn({w for c in chunks for words in c for w in words})
        out += [combined(t, c) for c in chunks]
        at += len(chunks)
    return out


_COMPILED: dict[str, Transducer] = {}


def with_counts(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """Per document: doc_id, n_bytes, n_tokens, over_limit.

    NULL counts as empty, with 0 tokens; texts of any length are counted whole, in chunks; repeated
    rows each get a row; no rows: no rows. Columns besides doc_id and text are not read. The
    vocabulary at ``path`` (bounded by the model) is read by the driver and broadcast.
    """
    spark = docs.sparkSession
    pieces = load_pieces(path)
    sent = spark.sparkContext.broadcast((path, pieces, PieceArrays(pieces, GAP)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, pieces, arrays = sent.value
        if name not in _COMPILED:
            _COMPILED[name] = Transducer(pieces, arrays)
        t = _COMPILED[name]
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "n_bytes": b["n_bytes"], "n_tokens": count_all(t, b["text"].tolist())})

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    counted = id_back(id_as_text(rows).mapInPandas(run, "doc_id string, n_bytes long, n_tokens long"), kind)
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def op4_tokens(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return with_counts(read(spark, sf_dir, "documents"), str(public_tokenizers.path(MODEL)))
