"""Checks taken while tables are written, and key checks from one scan a table."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from orderlens.operators.keyed import duplicate_keys
from orderlens.plans import quality, runner
from orderlens.session import scratch_path
from orderlens.sources.adapter import from_testdata
from orderlens.sources.tables import Layer

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def table(spark):
    rows = [("a", 1, 5.0), ("a", 1, 6.0), ("a", 2, None), (None, 1, 1.0), (None, 1, 2.0), (None, None, 3.0), ("b", None, 4.0)]
    return spark.createDataFrame(rows, "k string, n int, v double")


@pytest.mark.parametrize("n", [7, 0])
def test_key_checks_are_the_single_checks(spark, n):
    df = table(spark).limit(n)
    for keys in (["k"], ["k", "n"]):
        got = quality.key_checks({"x": (df, keys)}).first()
        assert got["total_records"] == df.count() and got["duplicate_keys"] == duplicate_keys(df, keys).count()
        assert got["distinct_pk"] == df.dropna(subset=keys).dropDuplicates(keys).count()


@pytest.mark.parametrize("n", [7, 0])
def test_observed_while_written(spark, n):
    metrics = [F.count(F.lit(1)).alias("n_rows"), F.min("v").alias("least"), *quality.null_metrics(["k", "n"])]
    layer = Layer(spark, scratch_path(spark, "observed"))
    df = table(spark).filter(F.lit(n > 0))
    stored, row = layer.overwrite_observed("x", df, metrics)
    assert row.collect() == df.agg(*metrics).collect() == stored.agg(*metrics).collect()
    assert n == 0 or "Scan parquet" not in plan(row)
    # a second write is observed anew
    _, row = layer.overwrite_observed("x", df.unionByName(df), metrics)
    assert row.first()["n_rows"] == 2 * n


def test_gate_reads_each_staged_table_once_and_its_keys_alone(spark):
    out = scratch_path(spark, "gate")
    dw, mart = Layer(spark, f"{out}/dw"), Layer(spark, f"{out}/mart")
    raw = from_testdata(spark, SF)
    runner.build_warehouse(raw, dw, runner.RunResult())
    m, seen = runner.build_marts(raw, mart)
    checks = runner.quality_checks(dw, m, seen)
    gate = ["fact_profile", "dim_keys", "duplicate_keys", "not_null", "rfm_profile"]
    read = [line for name in gate for line in plan(checks[name]).splitlines() if line.startswith("Location: ") and "testdata" not in line]
    assert len(read) == len(set(read)) == 8  # four dimensions, the fact and three marts
    schemas = [line for name in gate for line in plan(checks[name]).splitlines() if line.startswith("ReadSchema: ")]
    assert all(s.count(":") <= 1 + 2 for s in schemas)
    fact = m["fact_order_items"]
    assert checks["fact_profile"].collect() == quality.fact_profile(fact).collect()
    assert checks["rfm_profile"].collect() == quality.rfm_profile(m["customer_rfm"]).collect()
    assert checks["not_null"].collect() == quality.null_counts({"fact_order_items": (fact, list(runner.FACT_KEY))}).collect()
    quality.gate(checks)
    bad = fact.unionByName(fact.limit(1)).withColumn("order_id", F.when(F.col("order_item_id") != 2, F.col("order_id")))
    m["fact_order_items"], seen["fact_order_items"] = mart.overwrite_observed("fact_bad", bad, runner.observed_of_fact())
    with pytest.raises(ValueError, match="not_null"):
        quality.gate(runner.quality_checks(dw, m, seen))


def test_the_faulty_fact_reads_its_fact_once(spark, tmp_path):
    from orderlens.queries import dirty_fact

    rows = [("a", 1), ("a", 2), ("b", 3), (None, 2), (None, 3), ("c", None), ("d", 4), ("a", 2)]
    spark.createDataFrame(rows, "order_id string, order_item_id int").write.parquet(str(tmp_path / "fact"))
    fact = dirty_fact(spark.read.parquet(str(tmp_path / "fact")))
    twice, lost = [r for r in rows if r[1] == 2], [(None, r[1]) for r in rows if r[1] == 3]
    assert sorted(map(str, map(tuple, fact.collect()))) == sorted(map(str, rows + twice + lost))
    assert fact.columns == ["order_id", "order_item_id"]
    assert fact._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
