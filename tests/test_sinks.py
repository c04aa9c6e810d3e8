import glob
import os

from pyspark.sql import functions as F

from chronoroll.operators import stamp
from chronoroll.plans.ingest import read_table, run_ingest, read_ingested
from chronoroll.plans.edge import table
from chronoroll.sinks import (append_table, layout, replace_partitions, write_snapshot_and_latest,
                              write_table)
from chronoroll.spec import Dim, Metric, TableSpec


def _rows(df, cols):
    return sorted(tuple(r) for r in df.select(cols).collect())


def test_replace_partitions_leaves_other_regions(spark, sf_small, tmp_dir):
    ev = table(spark, sf_small, "events").select("event_id", "event_type", "value")
    path = write_table(ev, f"{tmp_dir}/t", ["event_type"])
    replace_partitions(ev.filter("event_type = 'view'").withColumn("value", F.lit(-1.0)),
                       path, ["event_type"])
    out = read_table(spark, path, ["event_type"])
    assert out.count() == ev.count()
    assert out.filter("event_type = 'view'").agg(F.max("value")).collect()[0][0] == -1.0
    assert _rows(out.filter("event_type <> 'view'"), ["event_id", "value"]) == \
        _rows(ev.filter("event_type <> 'view'"), ["event_id", "value"])


def test_same_load_twice_is_same_table(spark, sf_small, tmp_dir):
    spec = TableSpec(name="t", time_column="ts", dimensions=(Dim("event_type"),),
                     metrics=(Metric("count", "count"),), query_granularity="hour",
                     segment_granularity="day", rollup=True, partition_col="event_type")
    ev = table(spark, sf_small, "events")
    run_ingest(spark, spec, ev, f"{tmp_dir}/t")
    first = _rows(read_ingested(spark, spec, f"{tmp_dir}/t"), ["__time", "event_type", "count"])
    run_ingest(spark, spec, ev, f"{tmp_dir}/t")
    assert _rows(read_ingested(spark, spec, f"{tmp_dir}/t"), ["__time", "event_type", "count"]) == first


def test_append_adds_rows(spark, sf_small, tmp_dir):
    ev = table(spark, sf_small, "events").select("event_id", "event_type")
    append_table(ev, f"{tmp_dir}/a", ["event_type"])
    append_table(ev, f"{tmp_dir}/a", ["event_type"])
    assert spark.read.parquet(f"{tmp_dir}/a").count() == 2 * ev.count()


def test_snapshot_and_latest_hold_identical_rows(spark, sf_small, tmp_dir):
    ev = stamp(table(spark, sf_small, "events"), "processing_ts")
    dated, latest = write_snapshot_and_latest(ev, f"{tmp_dir}/snap", f"{tmp_dir}/latest",
                                              "20240101000000", "event_type", fmt="parquet")
    a = spark.read.parquet(dated)
    b = spark.read.parquet(latest)
    cols = ["event_id", "processing_ts", "event_type"]
    assert _rows(a, cols) == _rows(b, cols)
    assert a.select("processing_ts").distinct().count() == 1
    assert os.path.isdir(f"{tmp_dir}/snap/run=20240101000000/event_type=click")


def test_one_file_per_region_when_compact(spark, sf_small, tmp_dir):
    ev = table(spark, sf_small, "events")
    write_table(ev, f"{tmp_dir}/c", ["event_type"], fmt="csv", files_per_partition=1)
    for d in glob.glob(f"{tmp_dir}/c/event_type=*"):
        assert len(glob.glob(f"{d}/*.csv")) == 1


def test_salted_layout_spreads_a_hot_region(spark, sf_small):
    ev = table(spark, sf_small, "events")
    hot = ev.withColumn("event_type", F.lit("hot"))      # one region holds every row
    parts = layout(hot, ["event_type"], files_per_partition=4, num_partitions=16)
    sizes = [n for n in parts.rdd.glom().map(len).collect() if n]
    assert len(sizes) == 4 and max(sizes) < ev.count() * 0.4


def test_max_rows_per_file(spark, sf_small, tmp_dir):
    ev = table(spark, sf_small, "events")
    write_table(ev, f"{tmp_dir}/m", ["event_type"], max_rows_per_file=100)
    per_file = spark.read.parquet(f"{tmp_dir}/m").groupBy(F.col("_metadata.file_path")).count()
    assert per_file.agg(F.max("count")).collect()[0][0] <= 100


def test_chunk_layout_prunes_partitions(spark, sf_small, tmp_dir):
    spec = TableSpec(name="t", time_column="ts", dimensions=(Dim("event_type"),),
                     metrics=(Metric("count", "count"),), query_granularity="hour",
                     segment_granularity="day", rollup=True)
    run_ingest(spark, spec, table(spark, sf_small, "events"), f"{tmp_dir}/p")
    df = read_ingested(spark, spec, f"{tmp_dir}/p").filter(F.col("chunk") == "2024-01-05")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(chunk" in plan
    assert df.count() > 0


def test_rebalance_splits_a_hot_region_by_size(spark, sf_small, tmp_dir):
    ev = table(spark, sf_small, "events")
    # AQE splits a large partition by ranges of map outputs: give it several
    # map tasks (a union of eight scans), as any multi-file input has
    from functools import reduce
    hot = reduce(lambda a, b: a.union(b), [ev] * 8).withColumn("event_type", F.lit("hot"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
    try:
        write_table(hot, f"{tmp_dir}/h", ["event_type"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = glob.glob(f"{tmp_dir}/h/event_type=hot/*.parquet")
    assert len(files) > 1
    assert spark.read.parquet(f"{tmp_dir}/h").count() == 8 * ev.count()


def test_range_read_prunes_chunks(spark, sf_small, tmp_dir):
    from chronoroll.plans.ingest import read_range
    from chronoroll.plans.suite import ORDERS_DAILY
    run_ingest(spark, ORDERS_DAILY, table(spark, sf_small, "orders"), f"{tmp_dir}/o")
    df = read_range(spark, ORDERS_DAILY, f"{tmp_dir}/o", ["1997-03-15/1997-06-01"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(chunk" in plan and "1997-03-01" in plan
    days = [r["__time"] for r in df.collect()]
    assert days and min(days).isoformat() >= "1997-03-15" and max(days).isoformat() < "1997-06-01"


def test_indexed_dimension_sorts_files(spark, sf_small, tmp_dir):
    spec = TableSpec.from_dict({"dataSchema": {
        "timestampSpec": {"column": "ts", "format": "iso"},
        "dimensionsSpec": {"dimensions": ["event_type",
                                          {"type": "long", "name": "user_id", "createBitmapIndex": True}]},
        "metricsSpec": [{"name": "count", "type": "count"}],
        "granularitySpec": {"queryGranularity": "hour", "segmentGranularity": "month", "rollup": True}}})
    assert spec.indexed == ["user_id"]
    run_ingest(spark, spec, table(spark, sf_small, "events"), f"{tmp_dir}/i")
    for f in glob.glob(f"{tmp_dir}/i/chunk=*/*.parquet"):
        ids = [r[0] for r in spark.read.parquet(f).select("user_id").collect()]
        assert ids == sorted(ids)


def test_ingest_with_spaces_in_column_names(spark, sf_small, tmp_dir):
    orders = table(spark, sf_small, "orders")
    df = orders.select(F.col("o_orderdate").cast("string").alias("ordered on"), F.col("o_orderpriority").alias("order priority"),
                       F.col("o_totalprice").cast("string").alias("total price"), F.col("o_orderstatus").alias("order status"))
    df = df.unionByName(df.limit(3).withColumn("ordered on", F.lit("some day")))
    spec = TableSpec(name="t", time_column="ordered on", time_format="yyyy-MM-dd HH:mm:ss", dimensions=(Dim("order priority"),),
                     metrics=(Metric("count", "count"), Metric("price sum", "doubleSum", "total price", scale=2)),
                     query_granularity="month", segment_granularity="year", rollup=True, partition_col="order status")
    res = run_ingest(spark, spec, df, f"{tmp_dir}/t", quarantine_path=f"{tmp_dir}/q")
    from chronoroll.operators import finish
    got = {(r["__time"], r["order priority"], r["order status"]): (r["count"], r["price sum"])
           for r in finish(read_ingested(spark, spec, f"{tmp_dir}/t"), spec).collect()}
    want = orders.groupBy(F.expr("CAST(trunc(o_orderdate, 'month') AS timestamp_ntz)"), "o_orderpriority", "o_orderstatus").agg(
        F.count("*"), F.sum(F.round(F.col("o_totalprice") * 100).cast("long")) / 100).collect()
    assert got == {tuple(r[:3]): tuple(r[3:]) for r in want}
    assert spark.read.parquet(f"{tmp_dir}/q").count() == 3
    assert res.counts.agg(F.sum("rows_in")).first()[0] == orders.count() + 3


def _counted_source(spark, rows, schema):
    """A frame whose every read adds its row count to an accumulator."""
    acc = spark.sparkContext.accumulator(0)

    def tick(r):
        acc.add(1)
        return r
    return spark.createDataFrame(spark.sparkContext.parallelize(rows, 2).map(tick), schema), acc


def test_detail_load_without_bad_rows_reads_its_input_once(spark, tmp_dir):
    rows = [("2020-01-08 14:00:00", "a", 1), ("2020-01-09 01:00:00", "b", 2),
            ("2020-02-01 00:00:00", "a", 3)]
    spec = TableSpec(name="t", time_column="ts", time_format="yyyy-MM-dd HH:mm:ss",
                     dimensions=(Dim("k"), Dim("v", "long")), metrics=(Metric("count", "count"),),
                     query_granularity="none", segment_granularity="month", rollup=False)
    df, acc = _counted_source(spark, rows, "ts string, k string, v long")
    run_ingest(spark, spec, df, f"{tmp_dir}/t", quarantine_path=f"{tmp_dir}/q")
    assert acc.value == len(rows)          # the table write only
    assert read_ingested(spark, spec, f"{tmp_dir}/t").count() == 3
    assert spark.read.parquet(f"{tmp_dir}/q").count() == 0   # empty, schema kept

    # with a bad row, the bad side is written from a second, filtered pass
    df, acc = _counted_source(spark, rows + [("not a time", "c", 4)], "ts string, k string, v long")
    run_ingest(spark, spec, df, f"{tmp_dir}/t2", quarantine_path=f"{tmp_dir}/q2")
    assert acc.value == 2 * (len(rows) + 1)
    bad = spark.read.parquet(f"{tmp_dir}/q2").collect()
    assert [(r["k"], r["_bad_reason"]) for r in bad] == [("c", "unparseable time")]
    assert read_ingested(spark, spec, f"{tmp_dir}/t2").count() == 3


def test_detail_load_of_an_empty_input_with_quarantine(spark, tmp_dir):
    # Spark reports no metric for a plan optimised to nothing: the bad side
    # is then written the ordinary way (a read of nothing)
    spec = TableSpec(name="t", time_column="ts", time_format="yyyy-MM-dd HH:mm:ss",
                     dimensions=(Dim("k"),), metrics=(Metric("count", "count"),),
                     query_granularity="none", segment_granularity="month", rollup=False)
    for i, df in enumerate([spark.createDataFrame([], "ts string, k string"),
                            spark.range(5).selectExpr("cast(id as string) as ts", "'a' as k")
                                 .filter("1 = 0")]):
        run_ingest(spark, spec, df, f"{tmp_dir}/t{i}", quarantine_path=f"{tmp_dir}/q{i}")
        assert spark.read.parquet(f"{tmp_dir}/q{i}").count() == 0
