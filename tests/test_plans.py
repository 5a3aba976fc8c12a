"""Physical-plan properties that matter at scale, read from explain()."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from orderlens.plans import marts, report
from orderlens.queries import layers
from orderlens.session import scratch_path

SF = "/root/testdata/sf0.001"


@pytest.fixture
def no_broadcast(spark):
    """Plans as for tables that are too large to broadcast."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def plan(df, mode="formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def below_exchanges(p: str) -> list[str]:
    """The operator line under each exchange of a simple plan."""
    lines = p.splitlines()
    return [lines[k + 1] for k, line in enumerate(lines) if re.search(r"\bExchange \w", line)]


def test_rfm_has_no_window(spark):
    rfm_plan = plan(layers(spark, SF).customer_rfm, "simple")
    assert "Window" not in rfm_plan and "SinglePartition" not in rfm_plan.split("Scan ExistingRDD")[0]


@pytest.mark.parametrize("name", ["order_facts", "delivery_review"])
def test_raw_rows_are_aggregated_before_their_only_shuffle(spark, no_broadcast, name):
    p = plan(getattr(layers(spark, SF), name), "simple")
    assert "REPARTITION" not in p and "Window" not in p
    under = below_exchanges(p)
    if name == "order_facts":  # items and payments reduced; the orders themselves are the rows of the result
        assert len(under) == 3 and sum("partial_" in x for x in under) == 2
    else:  # items, orders and reviews reduced
        assert len(under) == 3 and all("partial_" in x for x in under)


def test_days_are_aggregated_before_their_only_shuffle_without_a_sort(spark):
    from orderlens.plans import warehouse
    L = layers(spark, SF)
    for df in (marts.sla_daily(L.sla_orders), warehouse.dim_date(L.raw.orders)):
        p = plan(df, "simple")
        assert "REPARTITION" not in p and "SortAggregate" not in p and "hashpartitioning(order_id" not in p
        assert [("HashAggregate" in x) for x in below_exchanges(p)] == [True]


def test_a_hot_order_meets_in_one_row_per_task(spark):
    """One order holds a third of all items: the shuffle carries at most a row of it from each input file."""
    from helpers import item, order, raw
    n = 3000
    items = [item("hot" if k % 3 == 0 else f"o{k}", k, 1, 1) for k in range(n)]
    r = raw(spark, orders=[order("hot", "2024-01-01 10:00:00", "2024-01-03 10:00:00", "2024-01-10 00:00:00")], order_items=items)
    path = scratch_path(spark, "plans-hot")
    r.order_items.repartition(4).write.parquet(path)
    df = marts.order_facts(r.orders, spark.read.parquet(path), r.order_payments)
    p = plan(df, "simple")
    assert "REPARTITION" not in p and any("partial_count" in x for x in below_exchanges(p))
    assert df.first()["items_cnt"] == n // 3


def test_latest_score_has_no_sort_aggregate(spark):
    assert "SortAggregate" not in plan(report.latest_scores(_store(spark)), "simple")


def test_cohort_prunes_the_item_numbering_window(spark):
    p = plan(layers(spark, SF).cohort)
    assert "Window" not in p  # order_item_id is not read, so the fixture's numbering disappears


def test_filters_and_columns_reach_the_parquet_scan(spark):
    path = scratch_path(spark, "plans-sla")
    layers(spark, SF).sla_orders.write.parquet(path)
    stored = spark.read.parquet(path).filter(F.col("purchase_date") >= F.lit("1998-01-01").cast("date"))
    p = plan(marts.sla_daily(stored))
    assert "PushedFilters: [IsNotNull(purchase_date), GreaterThanOrEqual(purchase_date" in p
    read_schema = [line for line in p.splitlines() if line.startswith("ReadSchema")][0]
    assert "customer_id" not in read_schema and "approved_ts" not in read_schema


def _store(spark):
    return spark.createDataFrame([("1", None, None, None, None)],
                                 "order_id string, score_date date, risk_score decimal(10,6), risk_flag string, "
                                 "model_version string")


def test_weekly_report_drops_the_unused_review_join_on_grouped_plans(spark):
    """delivery_review is a join of two per-order aggregates: Catalyst knows it is unique per order and
    removes the left join when no review column is read."""
    L = layers(spark, SF)
    p = plan(report.wbr_weekly(report.sla_order_scored(L.enriched, _store(spark))))
    assert "review_score" not in p and "lineitem" not in p


def test_weekly_report_without_review_columns_on_stored_marts(spark):
    """Read from Parquet the review mart is not known to be unique, so the report's view leaves it out."""
    path = scratch_path(spark, "plans-marts")
    layers(spark, SF).sla_orders.write.parquet(path + "/sla")
    enriched = marts.sla_order_enriched(spark.read.parquet(path + "/sla"), None)
    p = plan(report.wbr_weekly(report.sla_order_scored(enriched, _store(spark))))
    assert p.count("InMemoryFileIndex") == 1  # only the SLA mart is scanned
