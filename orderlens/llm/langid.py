"""Language identification, words first, then ever shorter character n-grams.

A word that the model knows adds its log frequency in each language. An unknown word is scored by its
character n-grams (with marks at both ends): by the longest length of which the model knows any, from
``MAX_GRAM`` down to single characters. The sum over a text's words decides.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import cut, held_out, id_as_text, id_back, read, unit_hash

#: documents, about, that frequencies are learned from
SAMPLE_ROWS = 20_000
MAX_GRAM = 5
#: known words, and n-grams of each length, at most: the most frequent ones
MAX_WORDS = 60_000
MAX_GRAMS = 30_000
#: share of a language's words that an unseen one is taken to have
SMOOTH = 0.5
UNDETERMINED = "und"
#: unknown words whose scores a task keeps
MAX_KEPT = 400_000

# letters only: digits, and numerals such as the circled two, one half or the Roman eight, are none
_WORD = regex.compile(r"\p{L}+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def grams_of(word: str, n: int) -> list[str]:
    marked = f"^{word}$"
    return [marked[k:k + n] for k in range(len(marked) - n + 1)] if n > 1 else list(word)


@dataclass
class Model:
    langs: list[str]
    #: tables[0]: words, tables[n]: n-grams; log frequencies by language
    tables: list[dict[str, np.ndarray]]


def _counts(sample: DataFrame) -> DataFrame:
    """(n, gram, lang, count): n = 0 for words."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for lang, texts in b.groupby("lang", sort=False)["text"]:
                words: Counter = Counter()
                for t in texts:
                    words.update(words_of(t))
                for n in range(MAX_GRAM + 1):
                    c: Counter = Counter()
                    if n == 0:
                        c = words
                    else:
                        for w, k in words.items():
                            for g in grams_of(w, n):
                                c[g] += k
                    if c:
                        yield pd.DataFrame({"n": n, "gram": list(c), "lang": [lang] * len(c), "count": list(c.values())})

    counts = sample.mapInPandas(run, "n int, gram string, lang string, count long")
    return counts.groupBy("n", "gram", "lang").agg(F.sum("count").alias("count"))


def learn(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model | None:
    """Frequencies from a hash sample of about ``sample_rows`` documents with text and lang outside the
    held-out fold; None if there are none. What comes to the driver is bounded by the tables' sizes."""
    known = docs.select("doc_id", "text", F.col("lang").cast("string").alias("lang")).filter(
        F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    n = known.count()
    # drawn by id and text: rows that share an id, or have none, are drawn one by one
    sample = known.filter(unit_hash(11, F.col("doc_id"), F.col("text")) < sample_rows / max(n, 1)).select("text", "lang")
    counts = cut(_counts(sample))
    totals = {(r["n"], r["lang"]): r["total"] for r in
              counts.groupBy("n", "lang").agg(F.sum("count").alias("total")).collect()}
    langs = sorted({lang for _, lang in totals})
    if not langs:
        return None
    per = counts.groupBy("n", "gram").agg(F.sum("count").alias("all"), *[
        F.coalesce(F.sum(F.when(F.col("lang") == lang, F.col("count"))), F.lit(0)).alias(f"c{k}")
        for k, lang in enumerate(langs)])
    tables: list[dict[str, np.ndarray]] = []
    for k in range(MAX_GRAM + 1):
        most = MAX_WORDS if k == 0 else MAX_GRAMS
        top = per.filter((F.col("n") == k) & (F.col("all") >= 2)).orderBy(F.desc("all"), "gram").limit(most).toArrow()
        c = np.column_stack([top.column(f"c{j}").to_numpy() for j in range(len(langs))]).astype(float)
        n_all = np.array([totals.get((k, lang), 0) for lang in langs], float)
        logs = np.log((c + SMOOTH) / (n_all + SMOOTH * max(len(c), 1)))
        tables.append(dict(zip(top.column("gram").to_pylist(), logs, strict=True)))
    return Model(langs, tables)


class Scorer:
    """Sums of the words' scores; unknown words are scored once and kept, up to ``MAX_KEPT``."""

    def __init__(self, model: Model):
        self.model = model
        self._reset()

    def _reset(self) -> None:
        scorer = self

        class Rows(dict):
            def __missing__(self, word: str) -> int:
                return scorer._add(word)

        self.rows = Rows()
        self.table = np.zeros((1 << 12, len(self.model.langs)))

    def _add(self, word: str) -> int:
        k = len(self.rows)
        if k >= len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        self.table[k] = self.word_score(word)
        self.rows[word] = k
        return k

    def word_score(self, word: str) -> np.ndarray | float:
        words = self.model.tables[0]
        if word in words:
            return words[word]
        for n in range(MAX_GRAM, 0, -1):
            table = self.model.tables[n]
            found = [table[g] for g in grams_of(word, n) if g in table]
            if found:
                return np.mean(found, axis=0)
        return 0.0

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language of a whole text and its posterior share; ``und`` without a letter."""
        words = words_of(text)
        if not words:
            return UNDETERMINED, 0.0
        if len(self.rows) > MAX_KEPT:
            self._reset()
        ids = np.fromiter(map(self.rows.__getitem__, words), np.int64, len(words))
        total = self.table[ids].sum(axis=0)
        best = int(total.argmax())
        return self.model.langs[best], float(1 / np.exp(total - total[best]).sum())


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score.

    NULL and empty texts and texts without a letter are ``und`` with score 0, as is everything where
    nothing could be learned; ties go to the first language by name; long texts are read whole; repeated
    rows each get a row; no rows: no rows; a NULL doc_id is not held out. Only doc_id and text are read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        s = Scorer(sent.value) if sent.value is not None else None
        for b in batches:
            found = [s.predict(t) if s else (UNDETERMINED, 0.0) for t in b["text"]]
            yield pd.DataFrame({"doc_id": b["doc_id"], "held_out": b["held_out"],
                                "lang_pred": [x for x, _ in found], "score": [y for _, y in found]})

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    found = id_as_text(rows).mapInPandas(run, "doc_id string, held_out boolean, lang_pred string, score double")
    return id_back(found, kind)


def op1_langid(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return identify(docs, learn(docs))
