"""Replacement of a whole scope, malformed records, and values that are no clean numbers."""

import os

import pytest
from pyspark.sql import functions as F

from chronoroll import Dim, Metric, TableSpec
from chronoroll.functions.values import coerce
from chronoroll.operators import detail, finish, reaggregate, rollup
from chronoroll.plans.ingest import (bad_rows, read_ingested, rollup_with_rejects, run_ingest,
                                     split_rollup)
from chronoroll.plans.spec_job import run_spec
from chronoroll.session import scratch_path, shared_dir
from chronoroll.sinks.files import write_snapshot_and_latest
from chronoroll.streaming import read_json_stream, read_stream_rollup, stream_rollup

SPEC = TableSpec(name="t", time_column="at", dimensions=(Dim("kind"),), metrics=(Metric("n", "count"),),
                 query_granularity="day", segment_granularity="day", rollup=True, partition_col="region")


def rows(spark, *items):
    return spark.createDataFrame([(r, at, k) for r, at, k in items], "region string, at string, kind string")


def loaded(spark, spec, path):
    return {(r["region"], r["chunk"]) for r in read_ingested(spark, spec, path).collect()}


FULL = [("north", "2024-01-01T05:00:00", "a"), ("north", "2024-01-02T05:00:00", "a"), ("north", "2024-02-02T05:00:00", "a"),
        ("south", "2024-01-01T05:00:00", "a"), ("south", "2024-01-02T05:00:00", "b"), (None, "2024-01-01T05:00:00", "a"),
        ("", "2024-01-01T06:00:00", "a")]


@pytest.mark.parametrize("rollup_flag", [True, False])
def test_region_reload_replaces_its_scope_only(spark, tmp_dir, rollup_flag):
    spec = SPEC.with_(intervals=("2024-01-01/2024-02-01",), rollup=rollup_flag)
    run_ingest(spark, SPEC.with_(rollup=rollup_flag), rows(spark, *FULL), tmp_dir)
    run_ingest(spark, spec, rows(spark, FULL[1]), tmp_dir, drop_existing=True, regions=["north"])
    assert loaded(spark, spec, tmp_dir) == {
        ("north", "2024-01-02"), ("north", "2024-02-02"), ("south", "2024-01-01"), ("south", "2024-01-02"), (None, "2024-01-01")}


def test_chunks_partly_inside_the_interval_stay(spark, tmp_dir):
    run_ingest(spark, SPEC, rows(spark, *FULL), tmp_dir)
    spec = SPEC.with_(intervals=("2024-01-01T12:00:00/2024-01-02T12:00:00",))
    run_ingest(spark, spec, rows(spark, *FULL).limit(0), tmp_dir, drop_existing=True)
    assert len(loaded(spark, spec, tmp_dir)) == 6
    run_ingest(spark, SPEC.with_(intervals=("2024-01-02/2024-01-03",)), rows(spark, *FULL).limit(0), tmp_dir, drop_existing=True)
    assert {c for _, c in loaded(spark, spec, tmp_dir)} == {"2024-01-01", "2024-02-02"}


def test_without_drop_existing_other_chunks_stay(spark, tmp_dir):
    run_ingest(spark, SPEC, rows(spark, *FULL), tmp_dir)
    run_ingest(spark, SPEC, rows(spark, FULL[1]), tmp_dir)
    assert len(loaded(spark, SPEC, tmp_dir)) == 6


def test_regions_need_a_partition_column(spark, tmp_dir):
    with pytest.raises(ValueError):
        run_ingest(spark, SPEC.with_(partition_col=None), rows(spark, *FULL), tmp_dir, regions=["north"])
    with pytest.raises(ValueError):
        run_spec(spark, {"spec": {"dataSchema": {"timestampSpec": {"column": "at"}}}}, tmp_dir, base_override=tmp_dir, regions=["x"])


def test_blank_and_missing_regions_are_one_group(spark, tmp_dir):
    run_ingest(spark, SPEC, rows(spark, *FULL), tmp_dir)
    got = read_ingested(spark, SPEC, tmp_dir).where("region is null").collect()
    assert len(got) == 1 and got[0]["n"] == 2


def test_latest_drops_a_region_that_left(spark, tmp_dir):
    df = rows(spark, *FULL[:5])
    for run, part in (("1", df), ("2", df.where("region = 'south'"))):
        write_snapshot_and_latest(part, f"{tmp_dir}/snap", f"{tmp_dir}/latest", run, "region")
    assert [x for x in os.listdir(f"{tmp_dir}/latest") if x.startswith("region=")] == ["region=south"]
    assert len(os.listdir(f"{tmp_dir}/snap")) == 2


def test_malformed_messages_are_no_records(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/in")
    with open(f"{tmp_dir}/in/m.txt", "w") as f:
        f.write('{"at": "2024-01-01T00:00:00", "kind": "a"}\n{"kind": "b"}\ngarbage\n[]\n\n{"at": \n')
    spec = SPEC.with_(partition_col=None, missing_time="1999-09-09T09:00:00Z")
    stream = read_json_stream(spark, f"{tmp_dir}/in", "at string, kind string")
    stream_rollup(stream, spec, f"{tmp_dir}/out", f"{tmp_dir}/ck", quarantine_path=f"{tmp_dir}/bad").awaitTermination()
    got = {(str(r["__time"])[:10], r["kind"], r["n"]) for r in read_stream_rollup(spark, spec, f"{tmp_dir}/out").collect()}
    assert got == {("2024-01-01", "a", 1), ("1999-09-09", "b", 1)}
    bad = {(r["_malformed"], r["_bad_reason"]) for r in spark.read.parquet(f"{tmp_dir}/bad").collect()}
    assert bad == {(x, "malformed record") for x in ("garbage", "[]", "", '{"at": ')}


def test_malformed_csv_lines_go_to_the_bad_side(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/raw/north")
    with open(f"{tmp_dir}/raw/north/a.csv", "w") as f:
        f.write("no,at,kind\n1,2024-01-01T00:00:00,a\n2,2024-01-01T00:00:00\n3,2024-01-01T00:00:00,a,extra\n4x,never,a\n")
    spec_json = {"partitionColumn": "region", "dataSchema": {
        "timestampSpec": {"column": "at", "format": "iso", "missingValue": "1999-09-09T09:00:00Z"},
        "dimensionsSpec": {"dimensions": [{"name": "no", "type": "long"}]}, "granularitySpec": {"rollup": False}},
        "ioConfig": {"inputSource": {"baseDir": f"{tmp_dir}/raw", "filter": "*/*.csv"}, "inputFormat": {"type": "csv"}}}
    run_spec(spark, spec_json, f"{tmp_dir}/t", quarantine_path=f"{tmp_dir}/q")
    assert [r["no"] for r in spark.read.parquet(f"{tmp_dir}/t").collect()] == [1]
    bad = {r["no"]: (r["_bad_reason"], r["kind"], r["_malformed"]) for r in spark.read.parquet(f"{tmp_dir}/q").collect()}
    assert bad == {"2": ("malformed record", None, "2,2024-01-01T00:00:00"),
                   "3": ("malformed record", "a", "3,2024-01-01T00:00:00,a,extra"), "4x": ("unparseable time", "a", None)}


def test_bad_rows_keep_every_source_column(spark):
    df = rows(spark, ("north", "never", "a")).withColumn("unlisted", F.lit("12x"))
    assert bad_rows(df, SPEC).first().asDict() == {"region": "north", "at": "never", "kind": "a", "unlisted": "12x",
                                                   "_raw_time": "never", "_bad_reason": "unparseable time"}


def test_counts_beyond_32_bits(spark):
    df = rows(spark, ("north", "never", "a"), ("north", "2024-01-01T00:00:00", "a"))
    agg = rollup_with_rejects(df, SPEC)
    big = agg.withColumn("_bad", F.col("_bad") * 3_000_000_000).withColumn("_n", F.col("_bad") + F.col("_kept"))
    _, counts = split_rollup(big, SPEC)
    assert counts.first().asDict() == {"region": "north", "rows_in": 3_000_000_001, "rows_loaded": 1,
                                       "rows_bad": 3_000_000_000, "rows_outside": 0}


def test_interval_of_a_typed_time_reaches_the_scan(spark, tmp_dir):
    rows(spark, *FULL).withColumn("at", F.col("at").cast("timestamp_ntz")).write.parquet(f"{tmp_dir}/in")
    src = spark.read.parquet(f"{tmp_dir}/in")
    spec = SPEC.with_(intervals=("2024-01-02/2024-01-03",))
    from chronoroll.plans.ingest import clean, prepare
    for s in (spec, spec.with_(missing_time="2024-01-02T09:00:00Z")):
        for plan in (prepare(src, s)[0], rollup_with_rejects(src, s), clean(src, s)[0]):
            text = plan._jdf.queryExecution().toString()
            assert "PushedFilters: [" in text and "GreaterThanOrEqual(at,2024-01-02T00:00" in text
    res = run_ingest(spark, spec, src, f"{tmp_dir}/t", keep_counts=True)
    assert {r["rows_outside"] for r in res.counts.collect()} == {None}
    res = run_ingest(spark, spec, src, f"{tmp_dir}/t", keep_counts=True, count_outside=True)
    assert sum(r["rows_outside"] for r in res.counts.collect()) == 5


def test_values_that_are_no_clean_numbers(spark):
    df = spark.createDataFrame([("1", "400.0"), ("2", "400.5"), ("3", " 7 "), ("4", "1e3"), ("5", "x"), ("6", "9223372036854775808")], "k string, v string")
    got = {r["k"]: r["v"] for r in df.select("k", coerce("v", "long").alias("v")).collect()}
    assert got == {"1": 400, "2": None, "3": 7, "4": 1000, "5": None, "6": None}
    spec = TableSpec(name="t", time_column="at", query_granularity="day", rollup=True,
                     metrics=(Metric("s", "doubleSum", "v", scale=2), Metric("m", "doubleMean", "v", scale=2), Metric("l", "longSum", "w")))
    df = spark.createDataFrame([("1.25", "400.0"), ("NaN", "x"), ("Infinity", "1"), (None, None), ("1e300", "2")], "v string, w string")
    out = finish(rollup(df.withColumn("__time", F.lit("2024-01-01").cast("timestamp_ntz")), spec), spec).first()
    assert (out["s"], out["m"], out["l"]) == (1.25, 1.25, 403)


def test_detail_tables_hold_mergeable_states(spark):
    spec = TableSpec(name="t", time_column="at", query_granularity="day", rollup=False, dimensions=(Dim("k"),),
                     metrics=(Metric("n", "count"), Metric("m", "doubleMean", "v"), Metric("s", "doubleSum", "v", scale=2)))
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", None), ("b", 5.0)], "k string, v double")
    df = df.withColumn("__time", F.lit("2024-01-01").cast("timestamp_ntz"))
    got = {r["k"]: (r["n"], r["m"], r["s"]) for r in finish(reaggregate(detail(df, spec), spec), spec).collect()}
    assert got == {"a": (3, 1.5, 3.0), "b": (1, 5.0, 5.0)}
    with pytest.raises(ValueError):
        detail(df, spec.with_(metrics=(Metric("u", "thetaSketch", "v"),)))


def test_theta_beyond_its_exact_range(spark):
    spec = TableSpec(name="t", time_column="at", query_granularity="all", rollup=True, metrics=(Metric("u", "thetaSketch", "id"),))
    df = spark.range(50_000).withColumn("__time", F.lit("2024-01-01").cast("timestamp_ntz"))
    got = finish(rollup(df, spec), spec).first()["u"]
    assert got != 50_000 and abs(got - 50_000) < 0.05 * 50_000


def test_shared_folder_is_required_on_a_cluster():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError):
        shared_dir(Session())
    with pytest.raises(RuntimeError):
        scratch_path(Session(), "x")
