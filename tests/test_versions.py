"""Published sets of tables: readers see one run or the other, never parts of both."""

import pytest
from pyspark.sql import functions as F

from orderlens.plans import runner
from orderlens.session import scratch_path
from orderlens.sources.adapter import from_testdata
from orderlens.sources.tables import Layer, Versions, path_exists

SF = "/root/testdata/sf0.001"


def test_manifests_switch_and_old_versions_go(spark):
    v = Versions(spark, scratch_path(spark, "versions"))
    with pytest.raises(FileNotFoundError):
        v.current()
    folders = []
    for k in range(4):
        own = Layer(spark, v.new())
        own.overwrite("t", spark.range(k))
        folders.append(own.root)
        if k < 3:
            assert v.publish({"t": own.path("t"), "fixed": f"{v.root}/dw/fixed"}) == k + 1
            assert spark.read.parquet(v.current()["t"]).count() == k
    # the last run stopped before its manifest; the one before the published one is kept for its readers
    assert spark.read.parquet(v.current()["t"]).count() == 2
    assert [path_exists(spark, f) for f in folders] == [False, True, True, True]


def test_a_run_that_stops_between_two_tables_leaves_the_one_before(spark, monkeypatch):
    """The second run has other orders and stops before its last tables: the views still show the first run, whole."""
    out = scratch_path(spark, "test-versions")
    raw = from_testdata(spark, SF)
    first = runner.run(spark, raw, out, score_date="2024-01-01")
    tables = Versions(spark, out).current()
    assert set(first.tables.items()) == set(tables.items()) and len(tables) == 14
    names = ("v_sla_order_enriched", "sla_wbr_weekly")
    before = {n: sorted(map(str, runner.views(spark, out)[n].collect())) for n in names}

    class Stopped(Exception):
        pass

    whole = Layer.overwrite

    def until(self, name, df):
        if name == "item_facts":
            raise Stopped
        return whole(self, name, df)

    class Fewer:
        def __getattr__(self, name):
            df = getattr(raw, name)
            return df.filter(F.col("order_id").cast("long") % 3 != 0) if name in ("orders", "order_items") else df

    monkeypatch.setattr(Layer, "overwrite", until)
    with pytest.raises(Stopped):
        runner.run(spark, Fewer(), out, score_date="2024-01-01")
    monkeypatch.setattr(Layer, "overwrite", whole)
    assert Versions(spark, out).current() == tables
    assert {n: sorted(map(str, runner.views(spark, out)[n].collect())) for n in names} == before
    runner.run(spark, Fewer(), out, score_date="2024-01-01")
    assert runner.views(spark, out)["v_sla_order_enriched"].count() < len(before["v_sla_order_enriched"])
