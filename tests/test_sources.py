"""Parquet layers: raw tables round-trip with their declared schemas; full refresh and append."""

from orderlens.schema import RAW_SCHEMAS
from orderlens.session import scratch_path
from orderlens.sources.adapter import from_testdata
from orderlens.sources.tables import Layer, read_raw

SF = "/root/testdata/sf0.001"


def test_raw_round_trip_keeps_declared_schema(spark):
    root = scratch_path(spark, "raw-layer")
    src = from_testdata(spark, SF)
    layer = Layer(spark, root)
    for name in ("orders", "order_items", "order_reviews"):
        layer.overwrite(name, src[name])
    raw = read_raw(spark, root)
    for name in ("orders", "order_items", "order_reviews"):
        df = raw[name]
        assert df.schema.simpleString() == RAW_SCHEMAS[name].simpleString()
        assert df.count() == src[name].count()


def test_ids_and_timestamps_are_stored_without_a_dictionary(spark):
    import glob

    import pyarrow.parquet as pq
    layer = Layer(spark, scratch_path(spark, "plain"))
    rows = spark.range(100).selectExpr("cast(id as string) order_id", "timestamp_ntz '2024-01-01' purchase_ts", "'x' status")
    stored = layer.overwrite("t", rows.coalesce(1))
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, rows.collect()))
    path, = glob.glob(layer.path("t").removeprefix("file:") + "/*.parquet")
    columns = pq.ParquetFile(path).metadata.row_group(0)
    assert {columns.column(k).path_in_schema: columns.column(k).has_dictionary_page for k in range(3)} == {
        "order_id": False, "purchase_ts": False, "status": True}


def test_overwrite_replaces_and_append_adds(spark):
    layer = Layer(spark, scratch_path(spark, "layer"))
    a = spark.createDataFrame([(1,), (2,)], "k int")
    assert not layer.exists("t")
    assert layer.overwrite("t", a).count() == 2
    assert layer.overwrite("t", a.limit(1)).count() == 1
    assert layer.append("t", a).count() == 3
    assert layer.exists("t")
