"""Quality rules as a short-circuit cascade, in DataFrame operations only.

Each rule is a Column that is true where a document must go. The cost and the selectivity of every
rule are estimated on a sample; the rules then run in the order of rejection per cost, and a document
that one rule rejects is not looked at by the later ones (``CASE WHEN`` stops at the first hit).
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import SPACE, SPACE_CHARS, cut, read, words_of

#: documents, about, on which cost and selectivity are estimated; only the order depends on them
SAMPLE_ROWS = 2000
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Column


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, also where ``body`` uses it in lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def n_words(text: Column) -> Column:
    return F.size(words_of(text)).cast("long")


def word_chars(text: Column) -> Column:
    return F.length(F.translate(F.coalesce(text, F.lit("")), SPACE_CHARS, "")).cast("long")


def n_symbols(text: Column) -> Column:
    t = F.coalesce(text, F.lit(""))
    return (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long")


def n_dup_lines(text: Column) -> Column:
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return _let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))


def n_repeat_words(text: Column) -> Column:
    """Words inside 3-word windows that occur at least twice in the text.

    Windows are compared by a 64-bit hash. The keys are the hashes with the window's position in
    their low bits, as many as the text needs, so one sort of longs brings equal windows together;
    neighbours are then compared by their words.
    """

    def count(w):
        n = F.size(w) - 2
        low = F.pow(F.lit(2.0), F.ceil(F.log2(n.cast("double") + 1))).cast("long")

        def with_low(low):
            hashes = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.xxhash64(w[i], w[i + 1], w[i + 2]))
            keys = F.transform(hashes, lambda h, i: h - F.pmod(h, low) + i)

            def in_order(s):
                def at(k):
                    return F.pmod(s[k], low).cast("int")

                def same(j, k):
                    return (((s[j] - F.pmod(s[j], low)) == (s[k] - F.pmod(s[k], low)))
                            & (F.slice(w, at(j) + 1, 3) == F.slice(w, at(k) + 1, 3)))

                last = F.size(s) - 1
                twice = F.filter(F.sequence(F.lit(0), last), lambda k: (
                    F.when(k > 0, same(k, k - 1)).otherwise(F.lit(False))
                    | F.when(k < last, same(k, k + 1)).otherwise(F.lit(False))))
                covered = F.flatten(F.transform(twice, lambda k: F.array(at(k), at(k) + 1, at(k) + 2)))
                return F.size(F.array_distinct(covered)).cast("long")

            # no window twice (by hash): nothing to sort
            return _let(keys, lambda s: F.when(F.size(s) == F.size(F.array_distinct(F.transform(
                s, lambda x: x - F.pmod(x, low)))), F.lit(0).cast("long")).otherwise(_let(F.sort_array(s), in_order)))

        return F.when(n < 2, F.lit(0).cast("long")).otherwise(_let(low, with_low))

    return _let(words_of(text), count)


def with_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the base statistics of every text; NULL text counts as empty."""
    t = F.col("text")
    return docs.select("doc_id", n_words(t).alias("n_words"), word_chars(t).alias("word_chars"),
                       n_symbols(t).alias("n_symbols"), n_dup_lines(t).alias("n_dup_lines"),
                       n_repeat_words(t).alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def statistic_rules() -> list[Rule]:
    """The rules on the statistics of :func:`with_statistics`. A text without words fails ``too_short``."""
    c = F.col
    return [
        Rule("too_short", c("n_words") < 50),
        Rule("too_repetitive", 100 * c("n_repeat_words") > 50 * c("n_words")),
        Rule("symbols", 10 * c("n_symbols") > c("n_words")),
        Rule("word_length", (c("word_chars") < 2 * c("n_words")) | (c("word_chars") > 12 * c("n_words"))),
        Rule("dup_lines", 4 * c("n_dup_lines") > c("n_words")),
    ]


def text_rules() -> list[Rule]:
    """The same rules straight from ``text``: what a filter that needs no statistics runs."""
    t = F.col("text")
    n = n_words(t)
    return [
        Rule("too_short", n < 50),
        Rule("too_repetitive", 100 * n_repeat_words(t) > 50 * n),
        Rule("symbols", 10 * n_symbols(t) > n),
        Rule("word_length", (word_chars(t) < 2 * n) | (word_chars(t) > 12 * n)),
        Rule("dup_lines", 4 * n_dup_lines(t) > n),
    ]


def order_rules(docs: DataFrame, rules: Sequence[Rule], sample_rows: int = SAMPLE_ROWS,
                seed: int = 42) -> list[tuple[Rule, float, float]]:
    """(rule, seconds a row, share rejected), best rejection per cost first.

    A sample of about ``sample_rows`` documents is checkpointed; one pass over it for each rule gives
    the rule's time and its share of rejections. Verdicts don't depend on the order, so neither on
    the sample nor on the clock. An empty sample keeps the given order.
    """
    total = docs.count()
    if total == 0:
        return [(r, 0.0, 0.0) for r in rules]
    part = cut(docs.sample(fraction=min(1.0, sample_rows / total), seed=seed))
    part.agg(*[F.count_if(r.rejects) for r in rules]).first()  # compiled and warm
    n = max(1, part.count())
    t0 = time.perf_counter()
    part.agg(F.count(F.lit(1))).first()
    empty = time.perf_counter() - t0
    found = []
    for rule in rules:
        t0 = time.perf_counter()
        hits = part.agg(F.count_if(rule.rejects)).first()[0]
        found.append((rule, max(1e-9, (time.perf_counter() - t0 - empty) / n), hits / n))
    return sorted(found, key=lambda x: -x[2] / x[1])


def cascade(docs: DataFrame, rules: Sequence[Rule]) -> Column:
    """Name of the first rule, in the given order, that rejects the document; NULL if none does."""
    out = F.lit(None).cast("string")
    for rule in reversed(list(rules)):
        out = F.when(rule.rejects, F.lit(rule.name)).otherwise(out)
    return out


def filter_quality(docs: DataFrame, rules: Sequence[Rule] | None = None, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The documents that no rule rejects, with all their columns.

    NULL and empty texts have no words and go as too short; repeated rows are judged alike and all kept
    or all dropped; an empty table gives an empty table; other columns pass through untouched.
    """
    rules = list(text_rules() if rules is None else rules)
    ordered = [r for r, _, _ in order_rules(docs, rules, sample_rows)]
    return docs.filter(cascade(docs, ordered).isNull())


def judge(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Per document: doc_id, the statistics, base_failed, kept and the rule that rejected it."""
    stats = with_statistics(docs)
    rules = statistic_rules()
    ordered = [r for r, _, _ in order_rules(docs, text_rules(), sample_rows)]
    by_name = {r.name: r for r in rules}
    stats = stats.withColumn("rejected_by", cascade(stats, [by_name[r.name] for r in ordered]))
    return stats.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                        base_failed().alias("base_failed"), (~base_failed() & F.col("rejected_by").isNull()).alias("kept"))


def op5_quality(spark, sf_dir: str) -> DataFrame:
    return judge(read(spark, sf_dir, "documents"))


ORACLE = r"""
WITH w AS (
  SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
win AS (
  SELECT k, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS win
  FROM (SELECT k, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
twice AS (SELECT k, i FROM (SELECT k, i, count(*) OVER (PARTITION BY k, win) AS c FROM win) WHERE c > 1),
covered AS (
  SELECT k, count(DISTINCT p) AS n FROM (SELECT k, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY k),
lines AS (
  SELECT k, count(*) - count(DISTINCT line) AS n
  FROM (SELECT k, unnest(string_split(text, chr(10))) AS line FROM w)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY k),
s AS (
  SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(lines.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN lines USING (k) LEFT JOIN covered USING (k)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM s)
SELECT *, NOT base_failed AND NOT (10 * n_symbols > n_words OR word_chars < 2 * n_words OR word_chars > 12 * n_words
          OR 4 * n_dup_lines > n_words) AS kept
FROM b
"""
