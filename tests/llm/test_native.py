"""Mixing and the quality cascade: SQL on the test tables and on awkward rows, and the cascade's order."""

import glob

import pytest
from awkward import SF, awkward, duck, rows, with_clashes
from pyspark.sql import functions as F

from orderlens.llm import mixing, quality
from orderlens.llm.queries import ORACLES, QUERIES
from orderlens.session import scratch_path


@pytest.mark.parametrize("name", ["op5_quality", "op9_mixing"])
@pytest.mark.parametrize("table", ["test", "awkward", "empty"])
def test_equals_sql(spark, name, table):
    sf = SF
    if table != "test":
        sf = scratch_path(spark, "native")
        docs = awkward(spark) if table == "awkward" else awkward(spark).limit(0)
        docs.coalesce(1).write.parquet(f"{sf}/documents.parquet")
    df = QUERIES[name](spark, sf)
    path = f"{SF}/documents.parquet" if table == "test" else sf.removeprefix("file:") + "/documents.parquet/*.parquet"
    assert glob.glob(path)
    found = duck({"documents": path}).execute(ORACLES[name])
    cols = [d[0] for d in found.description]
    assert sorted(df.columns) == sorted(cols)
    assert rows(df.select(*cols)) == sorted(found.fetchall(), key=lambda t: tuple((x is None, str(x)) for x in t))


def test_mix_shares_and_caps(spark):
    docs = spark.createDataFrame([(k, "w " * (1 + k % 7), "big" if k % 3 else ("s1" if k % 2 else "s2")) for k in range(6000)],
                                 "doc_id long, text string, source string")
    out = mixing.mix(with_clashes(docs))
    per = out.join(docs.select("doc_id", "source"), "doc_id").groupBy("source").agg(
        F.sum("size").alias("size"), F.first("target").alias("target"), F.sum("taken").alias("taken")).collect()
    assert abs(sum(r["target"] for r in per) - sum(r["size"] for r in per)) < 1e-6
    for r in per:
        assert r["target"] <= 3 * r["size"] and abs(r["taken"] - r["target"]) <= 0.05 * r["target"]
    assert out.filter("taken > 3 * size").isEmpty()
    copies = {r[0]: r[1] for r in out.select("doc_id", "copies").collect()}
    emitted = {r[0]: r[1] for r in mixing.emit(with_clashes(docs)).groupBy("doc_id").count().collect()}
    assert emitted == {k: n for k, n in copies.items() if n}
    assert rows(out) == rows(mixing.mix(docs.repartition(7)))  # reruns and layouts agree


def test_documents_without_ids_are_drawn_one_by_one(spark):
    table = [(None if k % 2 else k, f"one two {k}", "a" if k % 4 < 2 else "b") for k in range(800)]
    out = mixing.emit(spark.createDataFrame(table, "doc_id long, text string, source string"))
    copies = {r["text"]: r["count"] for r in out.filter("doc_id IS NULL").groupBy("text").count().collect()}
    per = {s: {copies.get(t, 0) for i, t, x in table if i is None and x == s} for s in "ab"}
    assert max(len(x) for x in per.values()) == 2  # some rows of a source are drawn, some not


@pytest.mark.parametrize("kind", ["no ids", "one id", "equal rows"])
def test_targets_hold_without_ids_of_their_own(spark, monkeypatch, kind):
    """Rows that share an id, have none, or are equal in all columns are drawn one by one, alike in every layout."""
    monkeypatch.setattr(mixing, "RUN_ROWS", 100)
    table = [(None if kind == "no ids" else 7, "w " * 4 + ("" if kind == "equal rows" else str(k)), f"s{k % 3}", 1) for k in range(3000)]
    docs = spark.createDataFrame(table, "doc_id long, text string, source string, extra int")
    out = mixing.mix(docs)
    assert out.count() == 3000
    taken = {r[0]: r[1] for r in out.groupBy("target").agg(F.sum("taken")).collect()}
    assert len(taken) == 3 and all(abs(n - t) <= 0.1 * t for t, n in taken.items())
    emitted = mixing.emit(docs)
    assert emitted.columns == [*docs.columns, "copy"] and emitted.count() == out.agg(F.sum("copies")).first()[0]
    assert rows(emitted.groupBy("source", "text", "copy").count()) == rows(
        mixing.emit(docs.repartition(5)).groupBy("source", "text", "copy").count())


def test_mix_stops_at_three_times_the_size(spark):
    docs = spark.createDataFrame([(1, "w " * 10, "a"), (2, "w " * 1000, "b"), (3, "w " * 100, "c")], "doc_id long, text string, source string")
    t = {r["source"]: r["target"] for r in mixing.mix(docs).join(docs.select("doc_id", "source"), "doc_id").collect()}
    assert t["a"] == 30.0 and t["c"] == 300.0 and abs(t["b"] - 780.0) < 1e-9


def test_cascade_order_and_verdict(spark):
    docs = with_clashes(awkward(spark))
    rules = quality.text_rules()
    ordered = quality.order_rules(docs, rules)
    gains = [share / cost for _, cost, share in ordered]
    assert gains == sorted(gains, reverse=True) and {r.name for r, _, _ in ordered} == {r.name for r in rules}
    kept = quality.filter_quality(docs)
    assert kept.columns == docs.columns
    judged = quality.judge(docs)
    assert rows(kept.select("doc_id")) == rows(judged.filter("kept").select("doc_id"))
    # any order of the rules gives the same verdicts
    back = docs.filter(quality.cascade(docs, rules[::-1]).isNull())
    assert rows(back.select("doc_id")) == rows(kept.select("doc_id"))
    assert quality.filter_quality(docs.limit(0)).count() == 0
