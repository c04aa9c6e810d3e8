"""States that merge: bitmaps, theta sets, fixed bins; lookups and bounded state in streams."""

import datetime as dt
import json
import os
import time

import pytest
from pyspark.sql import functions as F

from chronoroll import Dim, Metric, TableSpec
from chronoroll.operators import (bitmap_states, count_bitmaps, detail, finish, histogram_bins, merge_bitmaps, reaggregate, rollup,
                                  theta_counts, theta_sets, with_lookups)
from chronoroll.plans import read_ingested, run_ingest
from chronoroll.spec import Lookup
from chronoroll.streaming import (compact_stream_window, purge_window, read_json_stream, read_stream_rollup, read_stream_window, stream_rollup,
                                  stream_window)


def test_bitmaps_merge_exactly(spark):
    rows = [("a", 1, 5), ("a", 1, 5), ("a", 2, 5), ("a", 2, 40_000), ("b", 1, -7), ("b", 1, 2**40), ("b", 2, None), ("c", 1, None), (None, 1, 0)]
    df = spark.createDataFrame(rows, "k string, h int, id long").repartition(3)
    states = bitmap_states(df, ["k", "h"], "id")
    get = lambda x, keys: {tuple(r)[:-1]: r["n"] for r in count_bitmaps(x, keys, "n").collect()}
    assert get(states, ["k", "h"]) == {("a", 1): 1, ("a", 2): 2, ("b", 1): 2, (None, 1): 1}
    assert get(states, ["k"]) == {("a",): 2, ("b",): 2, (None,): 1}
    half = merge_bitmaps(states.where("h = 1"), ["k"]).unionByName(merge_bitmaps(states.where("h = 2"), ["k"]))
    assert get(half, ["k"]) == get(states, ["k"])
    assert count_bitmaps(states.where("k = 'a'"), [], "n").first()["n"] == 2


def test_theta_sets(spark):
    spec = TableSpec(name="t", time_column="at", dimensions=(Dim("kind"),), metrics=(Metric("u", "thetaSketch", "id"),), query_granularity="day", rollup=True)
    rows = [("2024-01-01", "x", i) for i in range(30)] + [("2024-01-01", "y", i) for i in range(20, 40)] + [("2024-01-02", "x", 1), ("2024-01-03", "y", 1)]
    df = spark.createDataFrame(rows, "at string, kind string, id long").withColumn("__time", F.col("at").cast("timestamp_ntz"))
    sets = theta_sets(rollup(df, spec), ["__time"], "u", F.col("kind") == "x", F.col("kind") == "y")
    names = ["a", "b", "both", "common", "only_a"]
    got = {r["__time"].day: tuple(r[c] for c in names) for r in theta_counts(sets, names).collect()}
    assert got == {1: (30, 20, 40, 10, 20), 2: (1, 0, 1, 0, 1), 3: (0, 1, 1, 0, 0)}
    merged = sets.agg(F.theta_union_agg("only_a").alias("s")).select(F.theta_sketch_estimate("s")).first()[0]
    assert merged == 20         # user 1 of the second day is among the first day's


HISTOGRAM = Metric("h", "fixedBucketsHistogram", "v", bins=4, lower=-1.0, upper=1.0)


def test_fixed_histogram(spark, tmp_dir):
    values = ["-1.0", "-0.5", "0.4999", "0.999999999999", "1.0", "-1.0001", "1e300", "-Infinity", "NaN", None, "x", "0"]
    spec = TableSpec(name="t", time_column="at", dimensions=(Dim("k"),), metrics=(HISTOGRAM,), query_granularity="hour", rollup=True)
    df = spark.createDataFrame([(f"2024-01-01T{i % 3:02}:00:00", "a", v) for i, v in enumerate(values)], "at string, k string, v string")
    want = [2, 1, 1, 2, 1, 2, 3]
    run_ingest(spark, spec, df, f"{tmp_dir}/t")
    stored = read_ingested(spark, spec, f"{tmp_dir}/t")
    day = finish(reaggregate(stored, spec, granularity="day"), spec)
    assert stored.count() == 3 and day.first()["h"] == want
    whole = detail(df.withColumn("__time", F.col("at").cast("timestamp_ntz")), spec.with_(rollup=False))
    assert finish(reaggregate(whole, spec, granularity="day"), spec).first()["h"] == want
    bins = {r["bin"]: (r["lower"], r["upper"], r["n"]) for r in histogram_bins(day, HISTOGRAM, ["k"]).collect()}
    assert bins[0] == (None, -1.0, 2) and bins[1] == (-1.0, -0.5, 1) and bins[5] == (1.0, None, 2) and bins[6] == (None, None, 3)
    assert Metric.of({"name": "h", "type": "fixedBucketsHistogram", "fieldName": "v", "numBuckets": 4, "lowerLimit": -1, "upperLimit": 1}) == HISTOGRAM
    with pytest.raises(ValueError):
        Metric("h", "fixedBucketsHistogram", "v", bins=0, lower=0, upper=1)


DDL = "at string, kind string, n string"
SPEC = TableSpec(name="t", time_column="at", dimensions=(Dim("kind"),), metrics=(Metric("c", "count"), Metric("s", "longSum", "n")),
                 query_granularity="day", segment_granularity="month", rollup=True)


def send(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.txt", "w") as f:
        f.writelines(json.dumps(dict(zip(("at", "kind", "n"), r))) + "\n" for r in rows)


def test_late_rows_with_bounded_state(spark, tmp_dir):
    batches = [[("2024-01-01T01:00:00", "a", 1), ("2024-01-02T01:00:00", "a", 2), ("2024-01-02T03:00:00", "b", 3)],
               [("2024-03-01T01:00:00", "a", 4)], [("2024-01-01T09:00:00", "a", 5), ("2024-03-01T02:00:00", "a", 6)]]
    kept = []
    for i, rows in enumerate(batches):
        send(f"{tmp_dir}/in", f"m{i}", rows)
        q = stream_window(read_json_stream(spark, f"{tmp_dir}/in", DDL), SPEC, f"{tmp_dir}/out", f"{tmp_dir}/ck", arrival="1 second")
        q.awaitTermination()
        kept.append(q.lastProgress["stateOperators"][0]["numRowsTotal"])
        time.sleep(1.2)
    assert max(kept[1:]) <= 2          # the groups of the latest stretch, not all that were seen
    want = {("2024-01-01", "a"): (2, 6), ("2024-01-02", "a"): (1, 2), ("2024-01-02", "b"): (1, 3), ("2024-03-01", "a"): (2, 10)}
    read = lambda *base: {(str(r["__time"])[:10], r["kind"]): (r["c"], r["s"]) for r in read_stream_window(spark, SPEC, f"{tmp_dir}/out", *base).collect()}
    assert read() == want
    base = f"{tmp_dir}/base"
    purge_window(spark, f"{tmp_dir}/out", compact_stream_window(spark, SPEC, f"{tmp_dir}/out", base))
    assert read(base) == want
    assert compact_stream_window(spark, SPEC, f"{tmp_dir}/out", base) == -1
    old = os.listdir(f"{base}/chunk=2024-03-01")
    send(f"{tmp_dir}/in", "m3", [("2024-01-01T10:00:00", "a", 7)])
    stream_window(read_json_stream(spark, f"{tmp_dir}/in", DDL), SPEC, f"{tmp_dir}/out", f"{tmp_dir}/ck", arrival="1 second").awaitTermination()
    compact_stream_window(spark, SPEC, f"{tmp_dir}/out", base)
    assert read(base) == {**want, ("2024-01-01", "a"): (3, 13)}
    assert os.listdir(f"{base}/chunk=2024-03-01") == old      # a chunk without news is not rewritten


def test_a_mapping_is_read_anew_by_each_batch(spark, tmp_dir):
    spec = TableSpec.from_dict({"dataSchema": {
        "dataSource": "t", "timestampSpec": {"column": "at", "format": "iso"}, "dimensionsSpec": {"dimensions": ["label"]},
        "metricsSpec": [{"name": "c", "type": "count"}], "granularitySpec": {"queryGranularity": "day", "segmentGranularity": "month", "rollup": True},
        "transformSpec": {"lookups": [{"name": "label", "column": "kind", "path": f"{tmp_dir}/map", "key": "k", "value": "v", "default": "?"}]}}})
    assert spec.input_names == ["at", "kind"]
    for i, mapping in enumerate(([("a", "one")], [("a", "two"), ("a", "three"), ("b", "four")])):
        spark.createDataFrame(mapping, "k string, v string").write.mode("overwrite").parquet(f"{tmp_dir}/map")
        send(f"{tmp_dir}/in", f"m{i}", [("2024-01-01T01:00:00", "a", 1), ("2024-01-01T01:00:00", "b", 1), ("2024-01-01T02:00:00", None, 1)])
        stream_rollup(read_json_stream(spark, f"{tmp_dir}/in", DDL), spec, f"{tmp_dir}/out", f"{tmp_dir}/ck").awaitTermination()
    got = {r["label"]: r["c"] for r in read_stream_rollup(spark, spec, f"{tmp_dir}/out").collect()}
    assert got == {"one": 1, "two": 1, "four": 1, "?": 3}
    batch = spark.createDataFrame([("2024-01-01T01:00:00", "b")], "at string, kind string")
    run_ingest(spark, spec, batch, f"{tmp_dir}/t")
    assert [r["label"] for r in read_ingested(spark, spec, f"{tmp_dir}/t").collect()] == ["four"]
    with pytest.raises(ValueError):
        stream_window(read_json_stream(spark, f"{tmp_dir}/in", DDL), spec, f"{tmp_dir}/w", f"{tmp_dir}/wck")


def test_a_lookup_in_csv(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/m")
    with open(f"{tmp_dir}/m/a.csv", "w") as f:
        f.write("code,name\n1,one\n")
    df = spark.createDataFrame([("1", dt.date(2024, 1, 1)), ("2", None)], "c string, d date")
    out = with_lookups(spark, df, (Lookup("name", "c", f"{tmp_dir}/m", "code", "name", fmt="csv"),))
    assert {r["c"]: r["name"] for r in out.collect()} == {"1": "one", "2": None}
