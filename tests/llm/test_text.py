"""Tokens, language, toxicity, decontamination, personal data and page text."""

import html
import itertools
import math
import random
import re
import time
import tracemalloc

import numpy as np
import pytest
from awkward import LOREM, SF, awkward, rows, with_clashes
from pyspark.sql import functions as F

from orderlens.llm import decontaminate, langid, pagetext, piecearrays, pii, tokens, toxicity
from orderlens.llm.common import held_out


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet").cache()


# --- tokens
@pytest.fixture(scope="module")
def model_path():
    import public_tokenizers

    return str(public_tokenizers.path(tokens.MODEL))


def test_tokens_equal_the_library(spark, docs, model_path):
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=model_path)
    for df in (docs, with_clashes(awkward(spark))):
        mine = rows(tokens.with_counts(df, model_path))
        want = [(r["doc_id"], len((r["text"] or "").encode()), n := len(lib.encode(r["text"] or "")), n > 4096) for r in df.select("doc_id", "text").collect()]
        assert mine == sorted(want, key=lambda t: tuple((x is None, str(x)) for x in t))
    assert tokens.with_counts(docs.limit(0), model_path).count() == 0


def test_chunk_maps_compose_in_any_way(model_path):
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=model_path)
    t = tokens.Transducer(tokens.load_pieces(model_path))
    rng = random.Random(4)
    for k in range(3000):
        x = "".join(rng.choice(" " * 6 + "abcdethe▁éß漢\r\n\t;(){}<s>0123😀") for _ in range(rng.randint(0, 50)))
        if k % 5 == 0:
            x = x.replace("a", " " * rng.randint(1, 40))
        assert tokens.count_tokens(t, x, rng.choice([1, 3, 7, 20, 1000])) == len(lib.encode(x)), x
        maps = [tokens.chunk_map(t, (tokens.GAP + x.replace(" ", tokens.GAP))[a:a + 4]) for a in range(0, len(x) + 1, 4)][:5]
        if len(maps) == 5:
            a, b, c = maps[:3]
            left, right = tokens.compose(t, tokens.compose(t, a, b), c), tokens.compose(t, a, tokens.compose(t, b, c))
            whole = lambda m: t.count(m.head) + m.count + (t.count(m.tail) if m.tail is not None else 0)
            one = lambda m: whole(m) if m.tail is not None else whole(tokens.chunk_map(t, m.head)) if len(tokens._WORD.findall(m.head)) > 1 else t.count(m.head)
            assert one(left) == one(right)


# --- language
def test_language_of_the_held_out_fold(docs):
    got = langid.identify(docs, langid.learn(docs)).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert len(got) > 150 and sum(r["lang_pred"] == r["lang"] for r in got) >= 0.97 * len(got)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_language_of_awkward_rows(spark, docs):
    df = with_clashes(awkward(spark))
    model = langid.learn(df)
    got = {r["doc_id"]: r["lang_pred"] for r in langid.identify(df, model).collect()}
    assert len(langid.identify(df, model).collect()) == 13
    assert {got[k] for k in (1, 2, 3, 9, 12)} == {"und"} and got[5] in {"en", "de", "fr"}
    assert {r["lang_pred"] for r in langid.identify(df, langid.learn(df.limit(0))).collect()} == {"und"}
    assert langid.identify(df.limit(0), model).count() == 0


def test_unknown_words_back_off_to_shorter_grams():
    m = langid.Model(["a", "b"], [{"tree": np.array([-1.0, -5.0])}, {"q": np.array([-2.0, -1.0])}, {"qu": np.array([-1.0, -3.0])}, {}, {}, {}])
    s = langid.Scorer(m)
    assert s.word_score("tree")[0] == -1.0 and s.word_score("quz")[0] == -1.0 and s.word_score("zq")[0] == -2.0
    assert s.word_score("zz") == 0.0 and s.predict("tree tree")[0] == "a" and s.predict("zq")[0] == "b"


def test_numerals_are_no_letters(spark):
    docs = spark.createDataFrame([(1, "② ½ Ⅷ ٣ 12", None), (2, "ⅷ word", None), *[(k, f"some words {k}", "en") for k in range(10, 40)]],
                                 "doc_id long, text string, lang string")
    got = {r["doc_id"]: r["lang_pred"] for r in langid.identify(docs, langid.learn(docs)).filter("doc_id < 3").collect()}
    assert got == {1: "und", 2: "en"} and langid.words_of("½Tree②top naïve") == ["tree", "top", "naïve"]


def test_language_equals_plain_backoff(docs):
    """Every whole text against a plain word-first backoff, character by character and language by language."""
    model = langid.learn(docs)

    def score(word, j):
        for n in range(langid.MAX_GRAM + 1):
            size = n and langid.MAX_GRAM + 1 - n
            marked = word if size <= 1 else f"^{word}$"
            parts = [word] if size == 0 else [marked[k:k + size] for k in range(len(marked) - size + 1)]
            known = [model.tables[size][x][j] for x in parts if x in model.tables[size]]
            if known:
                return sum(known) / len(known)
        return 0.0

    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.identify(docs, model).collect()}
    kept: dict = {}
    for r in docs.select("doc_id", "text").collect():
        words = "".join(c if c.isalpha() else " " for c in (r["text"] or "").lower()).split()
        for w in set(words) - kept.keys():
            kept[w] = [score(w, j) for j in range(len(model.langs))]
        totals = [sum(kept[w][j] for w in words) for j in range(len(model.langs))]
        pred, share = got[r["doc_id"]]
        if not words:
            assert (pred, share) == ("und", 0.0)
            continue
        best = max(totals)
        assert abs(totals[model.langs.index(pred)] - best) < 1e-6
        assert abs(share - 1 / sum(np.exp(x - best) for x in totals)) < 1e-6


# --- toxicity
def osa(a, b):
    d = [[max(i, j) if not i or not j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i, j in itertools.product(range(1, len(a) + 1), range(1, len(b) + 1)):
        d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
        if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
            d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d


def test_automaton_equals_edit_distances():
    terms = ["w:idiot", "w:disgusting", "w:scum", "p:achlich", "w:trash", "p:vequ", "W:clown"]
    m, rng = toxicity.Matcher(terms), random.Random(1)
    for _ in range(4000):
        w = list(rng.choice(terms)[2:] + rng.choice(["", "xa", "schaft"]))
        for _ in range(rng.randint(0, 3)):
            k = rng.randrange(len(w)) if w else 0
            kind = rng.randrange(4)
            if kind == 0 and w:
                w[k] = rng.choice("abcdeitschl")
            elif kind == 1:
                w.insert(k, rng.choice("abit"))
            elif kind == 2 and w:
                w.pop(k)
            elif len(w) > 1:
                k %= len(w) - 1
                w[k], w[k + 1] = w[k + 1], w[k]
        word, want = "".join(w), None
        for t in terms:
            d = osa(word, t[2:])
            e = d[-1][-1] if t[0] in "wW" else min(row[-1] for row in d)
            most = 0 if t[0].isupper() else 0 if len(t) < 7 else 1 if len(t) < 11 else 2
            if e <= most:
                grade = 2 * e + t[0].isupper()
                want = grade if want is None else min(want, grade)
        assert m.grade(word) == want, word


def test_quotation_weighs_less_than_abuse():
    m = toxicity.Model(["w:idiot"])
    s = toxicity.Scorer(m)
    assert s.score("you are an idiot") > s.score("she said \"you are an idiot\" to him") > s.score("all is well")
    assert s.score("what an idoit") > 0.3 and s.score("he called him an idiot") < 0.3


def test_toxicity_of_the_held_out_fold(spark, docs):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = toxicity.score_documents(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    hit = sum(r["predicted"] == r["toxic"] for r in got)
    assert len(got) > 50 and hit >= 0.93 * len(got)
    kept = toxicity.drop_toxic(with_clashes(docs), labels)
    assert set(docs.columns) < set(kept.columns) and 0.8 * docs.count() < kept.count() < docs.count()


def misspelled(word, rng):
    """One edit inside a word: a swap, another character, one left out, one put in."""
    k, c = rng.randrange(1, len(word) - 1), rng.choice("aeiourstn")
    return rng.choice([word[:k] + word[k + 1] + word[k] + word[k + 2:], word[:k] + c + word[k + 1:], word[:k] + word[k + 1:], word[:k] + c + word[k:]])


def test_misspelled_terms_in_held_out_texts(spark, docs):
    """The toxic texts of the held-out fold with every strong term misspelled by one edit, and all other signs left out."""
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = toxicity.learn(docs, labels)
    s, rng = toxicity.Scorer(model), random.Random(3)
    strong = [t for t in model.terms if t[0].islower() and len(t) > 6]
    held = docs.join(labels, "doc_id").filter((F.col("toxic") == 1) & held_out(F.col("doc_id"))).select("text").collect()
    got = []
    for text, _ in itertools.product([r["text"] or "" for r in held], range(20)):
        tokens, planted = [], 0
        for token in text.lower().split():
            word, hit = token.strip(".,;:!?\"'"), list(s.near(token))
            stems = [t[2:] for t in strong if word == t[2:] or t[0] == "p" and word.startswith(t[2:])]
            if not hit:
                tokens.append(token)
            elif stems:
                stem = max(stems, key=len)
                wrong = misspelled(stem, rng) + word[len(stem):]
                if wrong != word and wrong not in model.clean_words:
                    tokens.append(wrong)
                    planted += 1
        if planted:
            got.append(s.score(" ".join(tokens)) >= toxicity.THRESHOLD)
    assert len(got) >= 100 and sum(got) >= 0.9 * len(got), (len(got), sum(got))


def test_edits_of_a_term_count_less_the_more_clean_texts_hold_words_near_it(spark):
    """Of two terms, the one that unknown words of clean texts come near by chance loses its edits, the other keeps them."""
    clean = [f"day {'abcdefghijklmnopqrst'[k % 20]}umbler{k} of rain" for k in range(40)]
    near = ["stu" + c + "id" for c in "abcdefghijklmnoqrstvwxyz"]
    rows = [f"you are a total scoundrel number {k}" for k in range(200)] + [f"you are a stupid one of {k}" for k in range(200)]
    rows += [f"my {near[k % len(near)]}{chr(97 + k // len(near))} is well" for k in range(600)] + clean * 20
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") < 400).cast("int").alias("toxic"))
    model = toxicity.learn(docs, labels)
    s = toxicity.Scorer(model)
    assert s.score("a scoundrel") >= 0.3 and s.score("so stupid") >= 0.3 and s.score("a scuondrel came") >= 0.3
    assert model.trust.get("w:scoundrel", 1.0) == 1.0 and s.score("all is well") < 0.3


def test_labels_that_repeat_an_id_are_sampled_by_text(spark):
    docs = spark.createDataFrame([(k % 3 or None, f"text {k} {'idiot' if k % 2 else 'fine'}") for k in range(3000)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (None, 1)], "doc_id long, toxic int")
    n = toxicity._labelled(docs, labels, 100).count()
    assert 0 < n < 300


def test_toxicity_of_awkward_rows(spark):
    df = with_clashes(awkward(spark))
    labels = spark.createDataFrame([(k, None, k % 2) for k in range(12)] + [(None, 1, 1), (5, 0, None), (6, 0, 7)], "doc_id long, quality int, toxic int")
    out = toxicity.score_documents(df, labels)
    assert out.count() == 13 and out.filter("score IS NULL OR score < 0 OR score > 1 OR held_out IS NULL").count() == 0
    assert toxicity.score_documents(df, labels.limit(0)).filter("predicted = 1").count() == 0
    assert toxicity.score_documents(df.limit(0), labels).count() == 0


def test_held_out_is_crc32(spark):
    import zlib

    got = spark.range(200).select("id", held_out(F.col("id")).alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 4 == 2) for r in got)


# --- decontamination
ITEMS = [(1, "In the old shop Tom buys 3 apples and 5 pears so Tom has 8 fruits in his bag today"),
         (2, "A train leaves the station at 40 km and reaches the next town after 3 hours of slow travel"), (3, None), (4, ""), (5, "what is it")]


@pytest.fixture(scope="module")
def leaky(spark):
    return spark.createDataFrame([
        (1, "xx. " + ITEMS[0][1] + " yy zz"), (2, "In the old shop Ann buys 4 apples and 6 pears so Ann has 10 fruits in his bag today"),
        (3, "In the old shop Ann buys 4 apples and 6 pears so Sue has 4 fruits in his bag today"), (4, ITEMS[1][1].upper()),
        (5, "What is it"), (6, "what is it then"), (7, None), (8, ""), (9, "A train leaves the station and nothing else happens here at all"),
        (1, "xx. " + ITEMS[0][1] + " yy zz")], "doc_id long, text string")


def test_leaks_by_broadcast_and_by_join(spark, leaky):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    want = [(1, 1, "exact"), (1, 1, "exact"), (2, 1, "reparameterised"), (4, 2, "exact"), (5, 5, "exact")]
    for most in (1000, 0):
        got = decontaminate.find_leaks(with_clashes(leaky.select("*")).drop("item_id"), bench, most)
        assert sorted((r["doc_id"], r["item_id"], r["kind"]) for r in got.collect()) == want
        kept = decontaminate.drop_leaks(with_clashes(leaky), bench, most)
        assert sorted(r["doc_id"] for r in kept.collect()) == [3, 6, 7, 8, 9]
    assert decontaminate.find_leaks(leaky, bench.limit(0)).count() == 0
    assert decontaminate.find_leaks(leaky.limit(0), bench).count() == 0


def test_leaks_equal_brute_force_containment(spark, docs):
    bench = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    words = lambda t: re.findall(r"\w+", (t or "").lower())
    grams = lambda w: {tuple(w[k:k + 5]) for k in range(len(w) - 4)}
    items = {r["item_id"]: grams(words(r["text"])) for r in bench.collect()}
    want = {(r["doc_id"], i) for r in docs.select("doc_id", "text").collect() for g in [grams(words(r["text"]))] for i, s in items.items() if len(g & s) >= 0.8 * len(s)}
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(docs, bench).collect()}
    assert want and got == want


TOM = "Tom has 5 apples. Tom buys 3 more apples at the shop. How many apples does Tom have now?"


def test_names_that_open_sentences(spark):
    """Names behind no word: at the start of a text, sentence, line, quotation or bracket."""
    bench = spark.createDataFrame([(1, TOM), (2, 'Tom said: "Rita sold 7 old books." (Paul bought 2 of them.)\nPaul then gave Rita 1 new book')],
                                  "item_id long, text string")
    other = {"Tom": "Anna", "Rita": "Zoe", "Paul": "Ben"}
    renamed = [re.sub("Tom|Rita|Paul", lambda m: other[m[0]], r["text"]) for r in bench.orderBy("item_id").collect()]
    texts = [TOM, "xx yy. " + renamed[0].replace("5", "8").replace("3", "6") + " zz", "He wrote that " + TOM,
             "Anna has 5 apples. Sue buys 3 more apples at the shop. How many apples does Mia have now?", renamed[1],
             "The dog has 5 legs. Nobody buys it at the shop. How many cats does Tom have now?", TOM.lower().replace("does tom", "does Tom")]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = [(0, 1, "exact"), (1, 1, "reparameterised"), (2, 1, "exact"), (4, 2, "reparameterised"), (6, 1, "exact")]
    for most in (1000, 0):
        got = decontaminate.find_leaks(docs, bench, most).collect()
        assert sorted((r["doc_id"], r["item_id"], r["kind"]) for r in got) == want


def test_a_consistent_copy_behind_a_contradicting_one(spark):
    """A worksheet holds an item's template several times: any copy with consistent values is the leak."""
    item, clash, exact = ITEMS[0][1], "In the old shop Ann buys 4 apples and 6 pears so Sue has 4 fruits in his bag today", ITEMS[0][1]
    renamed = "In the old shop Ann buys 4 apples and 6 pears so Ann has 10 fruits in his bag today"
    longer = renamed.replace("his bag", "his own bag")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    docs = spark.createDataFrame([
        (1, f"{clash}. {exact}."), (2, f"{clash}. Some words between. {renamed}."), (3, f"{clash}. {clash}."), (4, f"{clash}. {clash}. xx {renamed}. {clash}."),
        (5, f"{renamed}. {exact}"), (6, f"{clash}. {LOREM} {longer}")], "doc_id long, text string")
    want = [(1, "exact"), (2, "reparameterised"), (4, "reparameterised"), (5, "exact"), (6, "reparameterised")]
    for most in (1000, 0):
        assert sorted((r["doc_id"], r["kind"]) for r in decontaminate.find_leaks(docs, bench, most).collect()) == want


def test_leaks_go_by_row_not_by_id(spark):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    table = [(None, ITEMS[0][1]), (None, LOREM), (7, ITEMS[1][1]), (7, LOREM), (7, ITEMS[1][1])]
    for most in (1000, 0):
        kept = decontaminate.drop_leaks(with_clashes(spark.createDataFrame(table, "doc_id long, text string")), bench, most)
        assert rows(kept.select("doc_id", "text")) == [(7, LOREM), (None, LOREM)]


def test_tables_of_numbers_are_known_by_their_values(spark):
    rng = random.Random(5)

    def numbers(n):
        return " ".join(str(rng.randrange(10**6)) for _ in range(n))

    tables = [numbers(n) for n in (10, 20, 50, 100)]
    asked = "Find the sum of all of these numbers: 4 5 6 7 8"
    bench = spark.createDataFrame([*enumerate(tables), (9, asked), (10, "7 km 8 km 9 km 10 km 11 km")], "item_id long, text string")
    other = asked.replace("4", "14").replace("7", "17")
    texts = [numbers(200), "1 2 3 4 5 6 7 8", f"{numbers(60)} {tables[1]} {numbers(60)}", f"Here they are: {tables[3]}.", other, asked,
             "17 km 18 km 19 km 20 km 21 km", " ".join(f"{k} km" for k in range(1, 20))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = [(2, 1, "exact"), (3, 3, "exact"), (4, 9, "reparameterised"), (5, 9, "exact"), (7, 10, "exact")]
    for most in (1000, 0):
        got = decontaminate.find_leaks(docs, bench, most).collect()
        assert sorted((r["doc_id"], r["item_id"], r["kind"]) for r in got) == want
    index = decontaminate.Index.of([(1, tables[3])])
    long = numbers(20_000)
    start = time.process_time()
    assert index.leaks(long) == [] and index.leaks(f"{long} {tables[3]}") == [(1, 1.0, "exact")]
    assert time.process_time() - start < 10


# --- personal data
def plain_spans(t):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m.group())
        if 13 <= len(d) <= 19 and pii.luhn(d):
            out.append(("card", *m.span()))
    return out + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15]


def test_patterns_equal_plain_regular_expressions(docs):
    rng = random.Random(2)
    for _ in range(5000):
        t = "".join(rng.choice("0123456789..@+a- ()") for _ in range(40))
        assert pii.base_spans(t) == plain_spans(t), t
    for r in docs.select("text").limit(300).collect():
        assert pii.base_spans(r["text"]) == plain_spans(r["text"])


def test_gradients_and_viterbi():
    rng = np.random.default_rng(1)
    tagger = pii.Tagger.new(rng)
    tagger.weights = {k: v.astype(float) for k, v in tagger.weights.items()}
    ids, tags = pii.examples([], 6, rng)
    _, g = tagger.loss(ids, tags)
    for name in ("emb", "wf", "ub", "bf", "out", "trans", "start"):
        w = tagger.weights[name]
        at = np.unravel_index(np.abs(g[name]).argmax(), w.shape)
        w[at] += 1e-5
        up, _ = tagger.loss(ids, tags)
        w[at] -= 2e-5
        down, _ = tagger.loss(ids, tags)
        w[at] += 1e-5
        assert abs((up - down) / 2e-5 - g[name][at]) < 1e-4 * max(1, abs(g[name][at]))
    e = rng.standard_normal((4, len(pii.TAGS)))
    moves, starts = tagger.moves(), tagger.starts()
    score = lambda p: starts[p[0]] + sum(e[t, x] for t, x in enumerate(p)) + sum(moves[a, b] for a, b in itertools.pairwise(p))
    best = max(itertools.product(range(len(pii.TAGS)), repeat=4), key=score)
    assert tuple(tagger.viterbi(e)) == best


@pytest.fixture(scope="module")
def tagger(docs):
    return pii.train(docs)


def test_tagger_adds_other_spellings_and_leaves_clean_text(spark, docs, tagger):
    rng = np.random.default_rng(77)
    ids, tags = pii.examples([], 300, rng)
    got = np.array([tagger.viterbi(x) for x in tagger.emissions(ids)])
    assert (got == tags).mean() > 0.85
    found = [pii.find_spans(tagger, [t])[0][1] for t in (
        "please call (523) 555-7040 about it", "write to jane.doe [at] example [dot] com please", "card 4111.1111.1111.1111 is mine")]
    assert sum(bool(f) for f in found) >= 2
    clean = [re.sub(r"\S*[0-9@]\S*", "", r["text"]) for r in docs.select("text").limit(200).collect()]
    assert not any(base or more for base, more in pii.find_spans(tagger, clean))


def test_long_addresses_are_read_whole(monkeypatch):
    """With a tagger that knows every rewritten address it sees: none is cut at the edge of a stretch."""
    known = re.compile(r"(?:\w+ dot )*[\w.]* ?\(at\) ?[\w.]*(?: dot \w+)*", re.IGNORECASE)

    def tagged(tagger, parts):
        out = []
        for s in parts:
            tags = np.full(len(s), pii.TAGS.index("O"))
            for m in known.finditer(s):
                tags[m.start():m.end()] = pii.TAGS.index("I-email")
                tags[m.start()] = pii.TAGS.index("B-email")
            out.append(tags)
        return out

    monkeypatch.setattr(pii, "tag_stretches", tagged)
    many = " dot ".join(f"part{chr(97 + k % 26)}" for k in range(40))
    for address in ("joe (at) communications.department.example.org", "joe (AT) example.org", "a.very.long.local.part.of.an.address (at) b.org",
                    "joe (at) averylongdomainnamewithoutanydotinside.example.org", f"joe (at) {many}", f"{many} (at) b.org"):
        text = "x" * 90 + f", {address}; " + "y" * 90
        (base, added), = pii.find_spans(None, [text])
        assert not base and [text[a:b] for _, a, b in added] == [address]
    two = "joe (at) " + many + " ,, ann (at) b.org"
    assert len(pii.find_spans(None, [two])[0][1]) == 2


def test_personal_data_of_awkward_rows(spark, tagger):
    mail = "write to a.b@c-d.org or +1 (523) 555-7040, card 4111111111111111 at 10.0.0.1"
    df = with_clashes(awkward(spark).union(spark.createDataFrame([(77, mail, "en", "a", 1)], awkward(spark).schema)))
    out = {r["doc_id"]: r for r in pii.detect(df, tagger).collect()}
    assert len(out) == 13 and out[1]["spans"] == "" and out[12]["base_sha256"] == out[2]["base_sha256"]
    assert [out[77][f"n_{k}"] for k in pii.KINDS] == [1, 1, 1, 1]
    assert out[77]["spans"].startswith("email:9:20,ip:") and pii.detect(df.limit(0), tagger).count() == 0


def test_redaction(spark):
    mail = "write to a.b@c-d.org or +1 (523) 555-7040, card 4111111111111111 at 10.0.0.1"
    df = with_clashes(awkward(spark).union(spark.createDataFrame([(77, mail, "en", "a", 1)], awkward(spark).schema)))
    out = pii.redact(df)
    assert out.columns == df.columns and out.count() == 14
    got = {r["doc_id"]: r for r in out.collect()}
    assert got[77]["text"] == "write to [EMAIL] or [PHONE], card [CARD] at [IP]" and got[77]["n_chars"] == len(got[77]["text"])
    assert got[1]["text"] is None and got[2]["text"] == "" and "quick brown" in got[5]["text"]


# --- page text
def test_pages_give_their_articles(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    for r in pagetext.extract(pages).join(pages.select("page_id", "html"), "page_id").collect():
        inside = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        lines = (" ".join(html.unescape(re.sub("<[^>]*>", " ", p)).split()) for p in re.split(r"</?(?:p|h1)>", inside))
        assert r["text"] == "\n".join(x for x in lines if x) and r["n_chars"] == len(r["text"])


PAGE = """<html><head><title>T</title></head><body><div id="cookie-notice">We use cookies, ok? yes.</div><header><h1>Site</h1>
<nav><a href=/>Home</a></nav></header><div class="content"><h1>My title</h1><p>First para with some words, and more of them. It goes on<br>
here &amp; there&nbsp;x.</p><ul><li>one item<li>two <b>items</b></ul><h2>Sub</h2><p>Second paragraph is longer, with punctuation; and so on. It
tells a story.</p><form><input><label>Name</label></form><div class="advert">Buy now! Cheap things, here.</div><script>var x="<p>no</p>"</script>
<blockquote><p>Quoted words are here, too.</p></blockquote></div><aside><p>Sidebar text that is long, long, long. And goes on.</p></aside>
<section class="comments"><h3>Comments</h3><p>I agree, this is a great post. Thanks for it!</p></section><footer>(c) 2020.</footer></body></html>"""


def test_other_parts_of_a_page_are_left_out():
    assert pagetext.main_text(PAGE).split("\n") == [
        "My title", "First para with some words, and more of them. It goes on here & there x.", "one item", "two items", "Sub",
        "Second paragraph is longer, with punctuation; and so on. It tells a story.", "Quoted words are here, too."]
    assert pagetext.main_text("<nav><a>x</a></nav>") == "" and pagetext.main_text("just text & more") == "just text & more"
    assert pagetext.main_text("<p>a < b <p>c<!-- x") == "a < b\nc"


PROSE = "The council met again on Tuesday evening, and the members spoke at length about the old bridge near the mill. Nobody agreed. " * 4


@pytest.mark.parametrize("frame", ["<article>{}</article>", "<div class=story>{}</div>", "{}"])
@pytest.mark.parametrize("n", [3, 20])
def test_short_blocks_of_long_articles_stay(frame, n):
    """Sections with headings, lists and tables: how many there are must not decide what stays."""
    sections = "".join(f"<section><h2>Part {k}</h2><p>{PROSE}</p><ul>{'<li>point</li>' * 9}</ul><table>{'<tr><td>cell</td></tr>' * 9}</table></section>" for k in range(n))
    page = f"<html><body><nav><a href=/>Home</a></nav>{frame.format(sections)}<div class=sidebar>other</div><footer>end</footer></body></html>"
    assert pagetext.main_text(page).split("\n") == [x for k in range(n) for x in (f"Part {k}", PROSE.strip(), *["point"] * 9, *["cell"] * 9)]


def test_links_inside_the_article_stay():
    """Linked headings, lists of references and paragraphs that are a link; anchors and links without an end."""
    body = f"<h2><a href=#x>A linked heading</a></h2><p>{PROSE}</p><p><a href=/y>This paragraph is a link.</a></p><p>{PROSE}</p>"
    want = ["A linked heading", PROSE.strip(), "This paragraph is a link.", PROSE.strip()]
    menu = "<ul><li><a href=/>Home</a></li><li><a href=/b>News</a></li></ul>"
    refs = "<ol><li><a href=/r1>First source</a></li><li><a href=/r2>Second source</a></li></ol>"
    text = lambda page: pagetext.main_text(page).split("\n")
    assert text(f"<body>{menu}<article>{body}{refs}</article>{menu}</body>") == [*want, "First source", "Second source"]
    assert text(f"<body><div class=page>{menu}<p>{PROSE}</p>{body}</div>{menu}</body>") == [PROSE.strip(), *want]
    assert text(f"<body><a name=top><div class=page><p>{PROSE}</p><p>{PROSE}</p></div></body>") == [PROSE.strip()] * 2
    assert text(f"<body><div><a href=/>Home</div><div class=page><p>{PROSE}</p><p>{PROSE}</p></div></body>") == [PROSE.strip()] * 2
    assert pagetext.blocks("<p><a href=x>one<p>two")[1].links == 0


@pytest.mark.parametrize("frame", ["article", "main"])
def test_names_that_may_be_topics_lower_the_ratio_only(frame):
    section = lambda name: f'<section class="{name}"><h2>{name}</h2><p>{PROSE}</p></section>'
    topics = ["legal-analysis", "social history", "search-methods"]
    other = '<div class="related-posts"><p>Read more</p></div><div class="share-buttons">Tweet Like</div>'
    page = f"<body><nav>x</nav><{frame}><h1>T</h1><p>{PROSE}</p>{''.join(map(section, topics))}{other}{section('comments-area')}{section('copyright legal')}</{frame}></body>"
    got = pagetext.main_text(page).split("\n")
    assert got == ["T", PROSE.strip(), *[x for n in topics for x in (n, PROSE.strip())]]
    assert pagetext.main_text(f"<body><p>{PROSE}</p>{section('search-methods')}</body>") == PROSE.strip()


def test_hidden_inline_elements_end_at_their_own_tag():
    assert pagetext.main_text("<p>a <span hidden>secret <span>x</span> tail</span> b") == "a b"
    assert pagetext.main_text("<p>a <b style='display:none'>x<i>y</b>z</i></p><p>c <span hidden>d</p><p>e") == "a z\nc\ne"


@pytest.mark.parametrize("piece", ["<div>", "<div><p>some words, here.", "<table><tr><td><ul><li><p>x, y", "<p><span hidden>x", "<x-a><p><section>w"])
def test_deep_and_broken_pages_take_linear_time(piece):
    def seconds(n):
        began = time.process_time()
        pagetext.main_text(piece * n + "the end, here.")
        return time.process_time() - began

    seconds(500)
    assert seconds(40_000) < 20 * max(seconds(5_000), 0.05)  # eight times the page; quadratic would be 64 times


def test_path_ratios_equal_a_plain_computation(spark):
    pages = [r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").select("html").collect()][:40]
    for page in [*pages, PAGE, f"<body><article>{'<section class=x><h2>A, b</h2><p>c. d, e</p></section>' * 7}</article><div class=x><p>f</p></div></body>"]:
        part = [b for b in pagetext.blocks(page) if not b.element.other]

        def path(b):
            labels, e = [], b.element
            while e is not None:
                labels.append(e)
                e = e.parent
            return labels

        # same path number, same tags from the root
        tags = {}
        for b in part:
            seen = tuple(e.tag for e in path(b) if e.tag not in ("html", "body"))
            assert tags.setdefault(b.path, seen) == seen
        score, size = pagetext.ratios(part)
        of = {p: [b for b in part if b.path == p] for p in tags}
        raw = [(math.log1p(sum(len(b.text) for b in of[c.path]) / len(of[c.path])),
                math.log1p(sum(ch in ".,;:!?…。，、；：！？¿¡" for b in of[c.path] for ch in b.text) / len(of[c.path]))) for c in part]

        def smooth(k, j):
            near = [(w, k + d) for d, w in ((-2, .06), (-1, .24), (0, .4), (1, .24), (2, .06)) if 0 <= k + d < len(part)]
            return sum(w * raw[i][j] for w, i in near) / sum(w for w, _ in near)

        for p, blocks in of.items():
            fused = [smooth(k, 0) * (1 + smooth(k, 1)) for k, b in enumerate(part) if b.path == p]
            assert abs(score[p] - sum(fused) / len(fused)) < 1e-9 and size[p] == sum(len(b.text) for b in blocks)


def test_awkward_pages(spark):
    pages = spark.createDataFrame([(1, "u", None), (2, None, ""), (2, None, ""), (None, "v", "<p>Hello there"), (4, "w", "<div>" * 3000 + "deep"),
                                   (5, "x", "<p>" + "long words, " * 50_000)], "page_id long, url string, html string")
    out = pagetext.extract(with_clashes(pages))
    got = rows(out.select("page_id", "url", "n_chars"))
    assert got == [(1, "u", 0), (2, None, 0), (2, None, 0), (4, "w", 4), (5, "x", 599_999), (None, "v", 11)]
    assert pagetext.extract(pages.limit(0)).count() == 0


def test_tokens_of_many_words_at_once(docs, model_path):
    """The arrays against the transducer's scalar steps, and the merges themselves, on real and random words."""
    pieces = tokens.load_pieces(model_path)
    arrays = piecearrays.PieceArrays(pieces, tokens.GAP)
    t = tokens.Transducer(pieces)
    rng = random.Random(8)
    chars = "abcdeéß漢字😀\ud800\t0123'.=" + tokens.GAP
    words = {w for r in docs.limit(60).collect() for w in tokens._WORD.findall(tokens.GAP + (r["text"] or "").replace(" ", tokens.GAP))}
    words |= {tokens.GAP * rng.randrange(2) + "".join(rng.choice(chars[:-1]) for _ in range(rng.randint(1, 40))) for _ in range(500)}
    words |= {c * k for c in "a.=漢" for k in (1, 2, 3, 5, 8, 13, 60)}
    words = [w.lstrip(tokens.GAP) if k % 2 else w for k, w in enumerate(sorted(words)) if w.strip(tokens.GAP) and len(w) - len(w.lstrip(tokens.GAP)) < 2]
    counts, lone = arrays.count(words)
    for w, n, one in zip(words, counts.tolist(), lone.tolist()):
        assert n == sum(1 if p in pieces else len(p.encode("utf-8", "surrogatepass")) for p in t.merged(w)), w
        assert (n, one) == t.long(w) and one == (t.merged(w)[0] == tokens.GAP)
    names = rng.sample(sorted(p for p in pieces if tokens.GAP not in p[1:]), 400)
    number = {p: k for k, p in enumerate(sorted((p for p in pieces if len(p) == 1)) + sorted((p for p in pieces if len(p) > 1), key=lambda p: -pieces[p]))}
    for a, b in zip(names, names[1:]):
        assert bool(arrays.fits(np.array([number[a]]), np.array([number[b]]))[0]) == (t.merged(a + b) == [a, b])


def test_text_without_spaces_takes_little_memory(model_path):
    pieces = tokens.load_pieces(model_path)
    t = tokens.Transducer(pieces, piecearrays.PieceArrays(pieces, tokens.GAP))
    rng = random.Random(9)
    text = "".join(rng.choice("abcdefghij.=é漢") for _ in range(200_000))
    tracemalloc.start()
    n = tokens.count_all(t, [text, None, "", text[:100]])
    assert tracemalloc.get_traced_memory()[1] < 60e6 and len(t.states) < 100
    tracemalloc.stop()
    import sentencepiece
    lib = sentencepiece.SentencePieceProcessor(model_file=model_path)
    assert n == [len(lib.encode(text)), 0, 0, len(lib.encode(text[:100]))]
