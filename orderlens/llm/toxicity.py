"""Toxicity by Levenshtein automata on a lexicon trie, with context windows.

The lexicon is learned from labelled documents: words, and beginnings of words, that toxic documents hold
far more often than their share, some of them strong, others weak signs. A text's words run through the intersection of the lexicon's trie with
Levenshtein automata (one edit from five letters on, two from nine; a swap of neighbours is one edit),
which is made deterministic as it is used. Each hit is put in a class: how many edits it needed and whether its
term is weak, whether the words around it mark it as quoted or reported instead of meant, and whether other words of the text are hits
of the same kind. A class's weight is the share of toxic
documents among the labelled ones that show it; a hit that needed edits also counts by the trust in its term, which
falls with every clean labelled document that holds an unknown word near the term. Misspelled toxic documents being rare among
labelled ones, both are also learned from the toxic ones with their terms misspelled. A document scores as its heaviest hit.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from orderlens.llm.common import cut, held_out, read, unit_hash

#: labelled documents, about, that the lexicon and the weights are learned from
SAMPLE_ROWS = 20_000
THRESHOLD = 0.3
PREFIXES = range(4, 9)
#: share of toxic documents among those with a term: to be a term at all, and to be a strong one
MIN_PRECISION = 0.5
STRONG = 0.8
#: documents that the trust in a term's edits starts with
TRUST_ROWS = 4
#: what a toxic document counts for, beside itself, with its terms misspelled
MISSPELLED = 0.1
#: learned terms kept at most, those in the most toxic documents first
MAX_TERMS = 5000
#: words on each side of a hit that are looked at
CONTEXT = 8
MAX_STATES = 200_000
MAX_WORDS = 500_000
# words that report another's words
REPORTED = frozenset(
    "said says called calls quote quoted quotes quoting word words term wrote writes allegedly "
    "sagte sagt nannte zitat wort dit disait appelle citation mot dijo dice llama cita palabra".split())
OPEN, CLOSE = "\"'«„“‘‹", "\"'»“”’›"
# weight of a grade (twice the edits, and one for a weak term) where no labelled document shows it; quoted
# hits a quarter; and how many documents that counts for
PRIOR = {0: 0.9, 1: 0.4, 2: 0.5, 4: 0.35}
PRIOR_ROWS = 4

_LETTERS = re.compile(r"[^\W\d_]+")
_SEAMS = re.compile(r"[-–—/_,.;:|()\[\]]+")
_EDGE = re.compile(r"^\W+|\W+$")


def terms_of(text: str | None) -> set[str]:
    """``w:`` words and ``p:`` beginnings of the longer words of a text."""
    out = set()
    for w in set(_LETTERS.findall((text or "").lower())):
        out.add("w:" + w)
        for k in PREFIXES:
            if len(w) > k:
                out.add("p:" + w[:k])
    return out


def _labelled(docs: DataFrame, labels: DataFrame, sample_rows: int) -> DataFrame:
    """text, toxic, half of about ``sample_rows`` labelled documents outside the held-out fold."""
    known = labels.filter(F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id"))).select("doc_id", "toxic")
    known = known.filter(F.col("doc_id").isNotNull()).distinct()
    n = known.count()
    u = unit_hash(7, F.col("doc_id"))
    known = cut(known.filter(u < sample_rows / max(n, 1)).select(
        F.col("doc_id").alias("_id"), "toxic", (F.floor(u * 2**40) % 2).cast("int").alias("half")))
    if known.count() <= 2 * sample_rows:
        known = F.broadcast(known)
    # an id may have many documents: they are drawn by their texts, equal ones count once
    m = docs.select("doc_id").join(known, F.col("doc_id") == F.col("_id")).count()
    rows = docs.select("doc_id", "text").join(known, F.col("doc_id") == F.col("_id"))
    if m > 2 * sample_rows:
        rows = rows.filter(unit_hash(8, F.col("doc_id"), F.col("text")) < sample_rows / m).dropDuplicates(["doc_id", "text", "toxic"])
    return rows.select("text", "toxic", "half")


def _count_terms(sample: DataFrame) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            n: dict[str, list[int]] = defaultdict(lambda: [0, 0])
            for text, toxic in zip(b["text"], b["toxic"], strict=True):
                for t in terms_of(text):
                    n[t][toxic] += 1
            if n:
                yield pd.DataFrame({"term": list(n), "clean": [v[0] for v in n.values()], "toxic": [v[1] for v in n.values()]})

    rows = sample.select("text", F.col("toxic").cast("int").alias("toxic"))
    return rows.mapInPandas(run, "term string, clean long, toxic long").groupBy("term").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))


def choose_terms(counts: list[tuple[str, int, int]]) -> list[str]:
    """The lexicon out of (term, clean, toxic) counts of significant terms.

    Of a word's beginnings the longest that covers the same documents; none where one word makes up
    nearly all of it; nothing that a chosen beginning covers already. Weak ones get a capital ``W:`` or ``P:``.
    """
    toxic = {t: n for t, _, n in counts}
    best_word: Counter = Counter()
    for t, n in toxic.items():
        if t[0] == "w":
            for k in range(2, len(t) - 1):
                best_word[t[2:2 + k]] = max(best_word[t[2:2 + k]], n)
    chosen: list[str] = []
    stems: set[str] = set()

    def covered(word: str) -> bool:
        return any(word[:k] in stems for k in range(1, len(word) + 1))

    for t in sorted((t for t in toxic if t[0] == "p"), key=lambda t: (len(t), t)):
        stem = t[2:]
        if covered(stem) or best_word[stem] >= 0.9 * toxic[t]:
            continue
        while True:
            longer = [x for x in (f"p:{stem}{c}" for c in {u[2 + len(stem)] for u in toxic if u.startswith("p:" + stem) and len(u) > len(stem) + 2})
                      if toxic.get(x, 0) >= 0.95 * toxic["p:" + stem]]
            if not longer:
                break
            stem = max(longer, key=lambda x: toxic[x])[2:]
        stems.add(stem)
        chosen.append("p:" + stem)
    chosen += [t for t in sorted(toxic) if t[0] == "w" and not covered(t[2:])]
    clean = {t: n for t, n, _ in counts}
    kept = sorted(chosen, key=lambda t: (-toxic[t], t))[:MAX_TERMS]
    return [t if toxic[t] >= STRONG * (toxic[t] + clean[t]) else t[0].upper() + t[1:] for t in kept]


def _prior(c: tuple[int, bool, bool]) -> float:
    return PRIOR[c[0]] / 4 if c[1] else PRIOR[c[0]]


def _edits(term: str) -> int:
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


class Matcher:
    """The least grade (twice the edits, and one for a weak term) from a word to the lexicon, by the trie and the automata, made deterministic lazily.

    A state is a set of (node, edits, awaited): a place in the trie, the edits so far, and after a swapped
    character the one that has to follow.
    """

    def __init__(self, terms: list[str]):
        self.term: dict[int, str] = {}
        self.next: list[dict[str, int]] = [{}]
        self.word, self.stem, self.allowed = [-1], [-1], [0]
        self.weak_word: dict[int, int] = {}
        self.weak_stem: dict[int, int] = {}
        for t in terms:
            node, kind, text = 0, t[0].lower(), t[2:]
            weak = t[0].isupper()
            most = 0 if weak else _edits(text)
            self.allowed[0] = max(self.allowed[0], most)
            for c in text:
                if c not in self.next[node]:
                    self.next[node][c] = len(self.next)
                    self.next.append({})
                    self.word.append(-1)
                    self.stem.append(-1)
                    self.allowed.append(0)
                node = self.next[node][c]
                self.allowed[node] = max(self.allowed[node], most)
            (self.word if kind == "w" else self.stem)[node] = most
            self.term[node] = t
            (self.weak_word if kind == "w" else self.weak_stem)[node] = int(weak)
        self.clear()

    def clear(self) -> None:
        self.states: dict[frozenset, int] = {}
        self.moves: list[dict[str, int]] = []
        self.ends: list[int | None] = []
        self.sets: list[frozenset] = []
        self.stems: list[int | None] = []
        self.start = self._state({(0, 0, "")})

    def _state(self, places: set[tuple[int, int, str]]) -> int:
        todo = list(places)
        while todo:  # leaving out characters of the term
            node, e, wait = todo.pop()
            if not wait:
                for child in self.next[node].values():
                    if e < self.allowed[child] and (child, e + 1, "") not in places:
                        places.add((child, e + 1, ""))
                        todo.append((child, e + 1, ""))
        least: dict[tuple[int, str], int] = {}
        for node, e, wait in places:
            least[node, wait] = min(e, least.get((node, wait), 9))
        key = frozenset((n, e, w) for (n, w), e in least.items())
        found = self.states.get(key)
        if found is None:
            found = self.states[key] = len(self.sets)
            self.sets.append(key)
            self.moves.append({})
            self.ends.append(min((2 * e + self.weak_word[n] for n, e, w in key if not w and self.word[n] >= e), default=None))
            self.stems.append(min((2 * e + self.weak_stem[n] for n, e, w in key if not w and self.stem[n] >= e), default=None))
        return found

    def _move(self, state: int, c: str) -> int:
        places: set[tuple[int, int, str]] = set()
        for node, e, wait in self.sets[state]:
            if wait:
                if c == wait:
                    places.add((node, e, ""))
                continue
            for x, child in self.next[node].items():
                if x == c:
                    places.add((child, e, ""))
                elif e < self.allowed[child]:
                    places.add((child, e + 1, ""))  # another character in its place
                    after = self.next[child].get(c)
                    if after is not None and e < self.allowed[after]:
                        places.add((after, e + 1, x))  # the two are swapped
            if e < self.allowed[node]:
                places.add((node, e + 1, ""))  # one too many
        found = self.moves[state][c] = self._state(places)
        return found

    def near_terms(self, word: str) -> set[str]:
        """The terms that ``word`` comes to by one edit or more."""
        state, out = self.start, set()
        for k, c in enumerate(word):
            to = self.moves[state].get(c)
            state = self._move(state, c) if to is None else to
            last = k == len(word) - 1
            out |= {self.term[n] for n, e, w in self.sets[state]
                    if e and not w and (self.stem[n] >= e or last and self.word[n] >= e)}
        return out

    def grade(self, word: str) -> int | None:
        """The least grade at which ``word`` is a term or begins with a stem; None above the edits that the
        lengths allow."""
        if len(self.sets) > MAX_STATES:
            self.clear()
        state, best = self.start, None
        for c in word:
            to = self.moves[state].get(c)
            state = self._move(state, c) if to is None else to
            if not self.sets[state]:
                return best
            e = self.stems[state]
            if e is not None and (best is None or e < best):
                best = e
                if e == 0:
                    return 0
        e = self.ends[state]
        return e if best is None or e is not None and e < best else best


@dataclass
class Model:
    terms: list[str]
    #: near words that clean documents use: no misspellings
    clean_words: frozenset[str] = frozenset()
    #: by grade, quoted, and whether several words hit
    weights: dict[tuple[int, bool, bool], float] = field(default_factory=dict)
    no_hit: float = 0.0
    #: by term, what a hit by edits counts for; 1 where none is told
    trust: dict[str, float] = field(default_factory=dict)


class Scorer:
    def __init__(self, model: Model):
        self.model = model
        self.matcher = Matcher(model.terms)
        self.known: dict[str, tuple[int, float] | None] = {}

    def near(self, token: str) -> Iterator[tuple[str, int]]:
        """The parts of a lower-cased token that are near the lexicon, with their grades."""
        for part in {token, *_SEAMS.split(token)}:
            word = _EDGE.sub("", part)
            if word and (e := self.matcher.grade(word)) is not None:
                yield word, e

    def fresh(self, token: str) -> Iterator[tuple[str, int]]:
        """Those of :meth:`near` that are no words of clean documents."""
        return ((w, e) for w, e in self.near(token) if e < 2 or w not in self.model.clean_words)

    def _least(self, token: str) -> tuple[int, float] | None:
        """The least grade in a token, and the trust in it."""
        best = min(self.fresh(token), key=lambda x: (x[1], x[0]), default=None)
        found = None
        if best is not None:
            word, e = best
            trust = self.model.trust
            found = e, 1.0 if e < 2 else max((trust.get(t, 1.0) for t in self.matcher.near_terms(word)), default=1.0)
        if len(self.known) > MAX_WORDS:
            self.known.clear()
        if len(token) < 64:
            self.known[token] = found
        return found

    def hits(self, text: str | None) -> dict[tuple[int, bool, bool], float]:
        """The classes (grade, quoted, several words) of the hits in a whole text, each with the greatest trust in one of them."""
        tokens = (text or "").lower().split()
        known, miss = self.known, self._least
        met = []
        for k, t in enumerate(tokens):
            e = known[t] if t in known else miss(t)
            if e is not None:
                met.append((k, *e))
        words: dict[tuple[int, bool], set[str]] = defaultdict(set)
        trusts: dict[tuple[int, bool], float] = defaultdict(float)
        for k, e, trust in met:
            c = e, _quoted(tokens, k)
            words[c].add(_EDGE.sub("", tokens[k]))
            trusts[c] = max(trusts[c], trust)
        return {(*c, len(w) > 1): trusts[c] for c, w in words.items()}

    def misspelled(self, text: str | None) -> str | None:
        """The text with an edit in every strong hit of five letters or more, and without its other hits; None if it has no such hit."""
        out, planted = [], False
        for token in (text or "").lower().split():
            hit = self._least(token)
            word = _EDGE.sub("", token)
            if hit is None:
                out.append(token)
            elif hit[0] == 0 and len(word) >= 5:
                out.append(token.replace(word, one_edit(word), 1))
                planted = True
        return " ".join(out) if planted else None

    def classes(self, text: str | None) -> set[tuple[int, bool, bool]]:
        """The classes of the hits in a whole text."""
        return set(self.hits(text))

    def score(self, text: str | None) -> float:
        return max((self.model.weights.get(c, _prior(c)) * trust for c, trust in self.hits(text).items()), default=self.model.no_hit)


def one_edit(word: str) -> str:
    """A word of five letters or more with one edit among its second to fifth letters, chosen by its hash."""
    h = zlib.crc32(word.encode("utf-8", "surrogatepass"))
    k, kind = 1 + h % 3, h // 3 % 3
    if kind == 0 and word[k] != word[k + 1]:
        return word[:k] + word[k + 1] + word[k] + word[k + 2:]
    return word[:k] + ("" if kind == 1 else "e" if word[k] != "e" else "a") + word[k + 1:]


def _quoted(tokens: list[str], at: int) -> bool:
    """Whether the words around mark a hit as another's: inside quotation marks, or reported just before."""
    before, after = tokens[max(0, at - CONTEXT):at], tokens[at + 1:at + 1 + CONTEXT]
    own = tokens[at]
    opened = own[0] in OPEN
    for t in reversed(before):
        if opened or t[-1] in CLOSE and t[0] not in OPEN:
            break
        opened = t[0] in OPEN and not (len(t) > 1 and t[-1] in CLOSE)
    closed = own.rstrip(".,;:!?")[-1:] in CLOSE if len(own) > 1 else False
    for t in after:
        if closed or t[0] in OPEN and t[-1] not in CLOSE:
            break
        closed = t.rstrip(".,;:!?")[-1:] in CLOSE and t != ""
    if opened and closed:
        return True
    return any(_EDGE.sub("", t) in REPORTED for t in before[-3:])


def learn(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """The lexicon and the weights. No labelled rows: an empty lexicon and score 0.

    Terms are counted on the sample by Spark; only significant ones (a likelihood ratio against the
    share of toxic documents, for as many tests as there are terms) come to the driver. Near words of one
    half's clean documents are excepted, the trust in terms and the weights come from the other half.
    """
    sample = cut(_labelled(docs, labels, sample_rows))
    row = sample.agg(F.count(F.lit(1)), F.sum("toxic")).first()
    n, n_toxic = row[0], int(row[1] or 0)
    if not n_toxic or n_toxic == n:
        return Model([], no_hit=n_toxic / n if n else 0.0)
    base = n_toxic / n
    counts = cut(_count_terms(sample))
    tests = counts.count()
    p = F.col("toxic") / (F.col("toxic") + F.col("clean"))
    kl = p * F.log(p / base) + F.when(p < 1, (1 - p) * F.log((1 - p) / (1 - base))).otherwise(0.0)
    found = counts.filter((F.col("toxic") >= 3) & (p >= MIN_PRECISION)).filter(
        (F.col("toxic") + F.col("clean")) * kl >= math.log(20 * max(tests, 1)))
    # a bounded list: the most frequent terms first
    rows = found.orderBy(F.desc("toxic"), "term").limit(20 * MAX_TERMS).collect()
    terms = choose_terms([(r["term"], r["clean"], r["toxic"]) for r in rows])
    sent = docs.sparkSession.sparkContext.broadcast(terms)

    def near_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        s = Scorer(Model(sent.value))
        for b in batches:
            words = {w for text in b["text"] for t in set((text or "").lower().split()) for w, e in s.near(t) if e > 1}
            if words:
                yield pd.DataFrame({"word": sorted(words)})

    clean = sample.filter((F.col("toxic") == 0) & (F.col("half") == 0)).select("text").mapInPandas(near_words, "word string")
    near = clean.distinct().collect()  # bounded by the sample
    model = Model(terms, frozenset(r["word"] for r in near))
    sent_near = docs.sparkSession.sparkContext.broadcast(model)

    def unknown(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The terms that a document comes to by edits only."""
        s = Scorer(sent_near.value)
        for b in batches:
            out = []
            for text, toxic in zip(b["text"], b["toxic"], strict=True):
                found = {x for t in set((text or "").lower().split()) for x in s.fresh(t)}
                if not toxic or all(e > 1 for _, e in found):
                    out += [(t, toxic, 1.0) for t in sorted({t for w, e in found if e > 1 for t in s.matcher.near_terms(w)})]
                if toxic and (wrong := s.misspelled(text)) is not None:
                    found = {x for t in set(wrong.split()) for x in s.fresh(t)}
                    out += [(t, toxic, MISSPELLED) for t in sorted({t for w, e in found if e > 1 for t in s.matcher.near_terms(w)})]
            yield pd.DataFrame(out, columns=["term", "toxic", "weight"])

    half = sample.filter(F.col("half") == 1).select("text", F.col("toxic").cast("int").alias("toxic"))
    for r in half.mapInPandas(unknown, "term string, toxic int, weight double").groupBy("term").agg(
            F.sum("weight").alias("n"), F.sum(F.col("toxic") * F.col("weight")).alias("toxic")).collect():  # a row for a term
        model.trust[r["term"]] = (r["toxic"] + TRUST_ROWS) / (r["n"] + TRUST_ROWS)
    sent_model = docs.sparkSession.sparkContext.broadcast(model)

    def seen(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        s = Scorer(sent_model.value)
        for b in batches:
            out = []
            for text, toxic in zip(b["text"], b["toxic"], strict=True):
                out.append((*shows(s, text), toxic, 1.0))
                if toxic and (wrong := s.misspelled(text)) is not None and (c := shows(s, wrong))[0] > 1:
                    out.append((*c, toxic, MISSPELLED))
            yield pd.DataFrame(out, columns=["grade", "quoted", "several", "toxic", "weight"])

    def shows(s: Scorer, text: str | None) -> tuple[int, bool, bool]:
        """A class is weighed on documents that show nothing heavier; hits that can't decide by their trust don't weigh."""
        cs = [c for c, trust in s.hits(text).items() if c[0] < 2 or trust * PRIOR[c[0]] >= THRESHOLD]
        return min(cs, key=lambda c: (c[1], c[0])) if cs else (-1, False, False)

    shown = half.mapInPandas(seen, "grade int, quoted boolean, several boolean, toxic int, weight double").groupBy(
        "grade", "quoted", "several").agg(F.sum("weight").alias("n"), F.sum(F.col("toxic") * F.col("weight")).alias("toxic")).collect()
    for r in shown:
        if r["grade"] < 0:
            model.no_hit = (r["toxic"] + base) / (r["n"] + 1)
        else:
            c = (r["grade"], r["quoted"], r["several"])
            model.weights[c] = (r["toxic"] + PRIOR_ROWS * _prior(c)) / (r["n"] + PRIOR_ROWS)
    return model


def scorer(spark, model: Model):
    """A column function: the score of a text. NULL and empty texts score as those without a hit."""
    sent = spark.sparkContext.broadcast(model)

    @pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        s = Scorer(sent.value)
        for part in texts:
            yield pd.Series([s.score(t) for t in part], dtype=float)

    return score


def score_documents(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted.

    NULL and empty texts get the score of texts without a hit; long texts are read whole; repeated rows
    each get a row; no rows: no rows; a NULL doc_id is not held out. Labels other than 0 and 1 are not learned
    from. Columns besides doc_id and text (documents), doc_id and toxic (labels) are not read.
    """
    score = scorer(docs.sparkSession, learn(docs, labels, sample_rows))
    out = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score("text").alias("score"))
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``docs`` without the documents predicted toxic; all columns stay. Edge cases as in
    :func:`score_documents`."""
    score = scorer(docs.sparkSession, learn(docs, labels, sample_rows))
    return docs.filter(score(docs["text"]) < THRESHOLD)


def op3_toxicity(spark, sf_dir: str) -> DataFrame:
    return score_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
