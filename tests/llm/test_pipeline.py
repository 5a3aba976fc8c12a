"""Each stage of the pipeline against what its operator says of the stage's own input, and the registration."""

import corpus_pipeline
import pytest
from awkward import awkward

import __spark_entry__ as E
from orderlens.llm import decontaminate, simhash, toxicity
from orderlens.llm.common import stage

SF = "/root/testdata/sf0.001"


def test_every_operator_has_one_query():
    names = [n for n in E.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in E.queries()
    assert {"op5_quality", "op9_mixing", "op12_topk", "op13_turntrie"} <= set(E.oracle_sql())


@pytest.fixture(scope="module")
def steps(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, of in corpus_pipeline.STAGES:
        after = stage(of(spark, docs, SF), f"test-{name}")
        out.append((docs, after))
        docs = after
    return out


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_stages(spark, steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "decontamination", "pii", "mixing"]
    for before, after in steps[:4]:
        assert after.columns == before.columns
    labels, bench = spark.read.parquet(f"{SF}/labels.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    before, after = steps[0]
    assert ids(after) == ids(toxicity.score_documents(before, labels).filter("predicted = 0"))
    before, after = steps[1]
    assert ids(after) == ids(simhash.grouped(before).filter("doc_id = component_id"))
    before, after = steps[2]
    bad = set(ids(decontaminate.find_leaks(before, bench)))
    assert ids(after) == [i for i in ids(before) if i not in bad]
    before, after = steps[3]
    assert ids(after) == ids(before)
    old = {r["doc_id"]: r["text"] for r in before.collect()}
    new = {r["doc_id"]: r["text"] for r in after.collect()}
    from orderlens.llm import pii
    assert all(new[k] == t for k, t in old.items() if not pii.stretches(t))
    assert all(not pii.base_spans(new[k]) for k in old)
    before, after = steps[4]
    per = {r["doc_id"]: r["count"] for r in after.groupBy("doc_id").count().collect()}
    assert set(per) <= set(ids(before)) and max(per.values()) <= 3


def test_stages_take_awkward_and_empty_tables(spark):
    docs = awkward(spark)
    texts = [r["text"] for r in docs.collect()]
    for name, of in corpus_pipeline.STAGES:
        after = of(spark, docs, SF)
        got = [r["text"] for r in after.collect()]
        assert name == "mixing" or after.columns == docs.columns
        if name == "near_dedup":  # one of the three copies stays, and one of the texts without words
            assert [t for t in got if t == texts[4]] == [texts[4]] and sum(not (t or "").strip() for t in got) == 1
            # the long text repeats the same sentence, so its fingerprint is a near copy's; no other text goes
            assert {t for t in texts if t and t.strip()} - set(got) <= {t for t in texts if (t or "").startswith(texts[4][:100])}
        elif name == "mixing":
            assert set(got) <= set(texts) and all(got.count(t) <= 3 * texts.count(t) for t in set(got))
        else:  # nothing here is toxic, leaked or personal
            assert sorted(map(str, got)) == sorted(map(str, texts)), name
        assert of(spark, docs.limit(0), SF).count() == 0, name
