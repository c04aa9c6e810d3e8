import json

import pytest
from pyspark.sql import functions as F

from chronoroll.operators import lookup, rename_positional, union_by_name, union_by_position
from chronoroll.plans import inventory, load_audit
from chronoroll.plans.audit import make_folder
from chronoroll.plans.edge import raw_events, table, write_region_csv
from chronoroll.sources import jdbc_read_options
from chronoroll.sinks import jdbc_write_options
from chronoroll.spec import JdbcOptions, Metric, TableSpec


def test_inventory_reports_empty_region(spark, sf_small, tmp_dir):
    base = f"{tmp_dir}/raw"
    write_region_csv(raw_events(table(spark, sf_small, "events")), base)
    make_folder(spark, f"{base}/event_type=refund")
    with open(f"{base}/event_type=click/readme.txt", "w") as f:
        f.write("not data")
    inv = {r["region"]: r for r in inventory(spark, base).collect()}
    assert inv["refund"]["has_files"] is False and inv["refund"]["n_files"] == 0
    assert inv["click"]["has_files"] and inv["click"]["n_bytes"] > 0
    assert set(inv) == {"click", "error", "purchase", "signup", "view", "refund"}


def test_audit_flags_lost_rows(spark):
    rows_in = spark.createDataFrame([("a",), ("a",), ("b",)], "region string")
    loaded = spark.createDataFrame([("a", 2), ("b", 0)], "region string, count long")
    bad = spark.createDataFrame([], "region string")
    out = {r["region"]: r["status"] for r in load_audit(rows_in, loaded, bad).collect()}
    assert out == {"a": "SUCCESS", "b": "FAILED"}


def test_lookup_default_and_no_row_growth(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    m = spark.createDataFrame([(1, "x"), (1, "y"), (2, "z")], "k int, v string")
    out = {r["k"]: r["v"] for r in lookup(df, m, "k", "v", default="?").collect()}
    assert out == {1: "y", 2: "z", 3: "?"}
    big = spark.range(2_000_000).select(F.col("id").alias("k"), F.repeat(F.lit("x"), 1000).alias("v"))
    plan = lookup(df, big, "k", "v")._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "BroadcastHashJoin" not in plan


def test_unions(spark):
    a = spark.createDataFrame([(1, "x")], "id long, s string")
    b = spark.createDataFrame([("y", 2)], "s string, id long")
    assert union_by_name([a, b]).collect()[1]["id"] == 2
    c = spark.createDataFrame([(3,)], "id long")
    assert union_by_name([a, c]).collect()[1]["s"] is None
    with pytest.raises(Exception):
        union_by_position([a, c]).collect()


def test_rename_positional(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert rename_positional(df, ["x", "y"]).columns == ["x", "y"]
    with pytest.raises(ValueError):
        rename_positional(df, ["x"])


def test_spec_from_json():
    d = {"dataSchema": {
        "granularitySpec": {"queryGranularity": "six_hour", "segmentGranularity": "quarter",
                            "intervals": ["1995-04-01/1998-07-01"], "rollup": True},
        "metricsSpec": [{"type": "longMax", "name": "largest", "fieldName": "o_custkey"},
                        {"type": "thetaSketch", "name": "buyers", "fieldName": "o_custkey"}],
        "dimensionsSpec": {"dimensions": [{"name": "o_orderkey", "type": "long"}, "o_orderpriority"]},
        "timestampSpec": {"format": "auto", "column": "o_orderdate"},
        "dataSource": "orders_quarters"}}
    s = TableSpec.from_dict(d)
    assert s.dim_names == ["o_orderkey", "o_orderpriority"] and s.dimensions[0].type == "long"
    assert s.query_granularity == "six_hour" and s.intervals == ("1995-04-01/1998-07-01",)
    assert s.missing_time is None and [m.type for m in s.metrics] == ["longMax", "thetaSketch"]
    with pytest.raises(Exception):
        s.name = "other"           # frozen
    with pytest.raises(ValueError):
        Metric("m", "doubleSum")  # needs a field


def test_spec_without_a_rollup_flag_rolls_up(caplog):
    no_flag = {"dataSchema": {"timestampSpec": {"column": "t"}, "granularitySpec": {}}}
    assert TableSpec.from_dict(no_flag).rollup and "distinct rows" in caplog.text


def test_jdbc_options():
    o = JdbcOptions("jdbc:postgresql://h/db", user="u", password="p", driver="org.postgresql.Driver")
    plain = jdbc_read_options(o, query="SELECT 1")
    assert plain["query"] == "SELECT 1" and "dbtable" not in plain
    part = jdbc_read_options(o, query="SELECT * FROM t", partition_column="id", lower_bound=0,
                             upper_bound=100, num_partitions=4)
    assert part["dbtable"] == "(SELECT * FROM t) q" and part["numPartitions"] == "4"
    with pytest.raises(ValueError):
        jdbc_read_options(o, table="t", partition_column="id")
    w = jdbc_write_options(o, "events")
    assert w["truncate"] == "true" and w["dbtable"] == "events"


def test_scale_conf_is_plain_settings():
    from chronoroll.session import scale_conf
    c = scale_conf(4000)
    assert c["spark.sql.shuffle.partitions"] == "16000"
    assert all(isinstance(v, str) for v in c.values())


def test_cli_ingest_and_inventory(spark, sf_small, tmp_dir, capsys):
    from chronoroll.cli import main
    from chronoroll.plans.suite import EVENTS_DETAIL_SPEC_JSON
    base = f"{tmp_dir}/raw"
    write_region_csv(raw_events(table(spark, sf_small, "events")), base)
    spec_path = f"{tmp_dir}/spec.json"
    with open(spec_path, "w") as f:
        json.dump(EVENTS_DETAIL_SPEC_JSON, f)
    assert main(["ingest", "--spec", spec_path, "--table", f"{tmp_dir}/t", "--base", base,
                 "--quarantine", f"{tmp_dir}/q"]) == 0
    assert spark.read.parquet(f"{tmp_dir}/t").count() > 0
    assert spark.read.parquet(f"{tmp_dir}/q").count() > 0
    assert main(["inventory", "--base", base]) == 0
    out = capsys.readouterr().out
    assert "click" in out and "partitions: region, chunk" in out


def test_cli_stream_and_compact(spark, sf_small, tmp_dir, capsys):
    from chronoroll.cli import main
    from chronoroll.plans.edge import publish_events
    from chronoroll.plans.suite import EVENTS_STREAM_SPEC_JSON
    from chronoroll.streaming import read_stream_rollup
    topic = f"{tmp_dir}/topic"
    publish_events(raw_events(table(spark, sf_small, "events")), topic)
    spec_path = f"{tmp_dir}/stream.json"
    with open(spec_path, "w") as f:
        json.dump(EVENTS_STREAM_SPEC_JSON, f)
    out, ck, base = f"{tmp_dir}/out", f"{tmp_dir}/ck", f"{tmp_dir}/base"
    assert main(["stream", "--spec", spec_path, "--out", out, "--checkpoint", ck,
                 "--source", topic]) == 0
    spec = TableSpec.from_dict(EVENTS_STREAM_SPEC_JSON["spec"])
    before = sorted(tuple(r) for r in read_stream_rollup(spark, spec, out).collect())
    assert main(["compact", "--spec", spec_path, "--out", out, "--base", base, "--purge"]) == 0
    after = sorted(tuple(r) for r in read_stream_rollup(spark, spec, out, compacted_path=base).collect())
    assert before == after and before
    assert "base covers batches up to" in capsys.readouterr().out


def test_compare_inventories_statuses(spark, sf_small, tmp_dir):
    from chronoroll.plans.audit import compare_inventories
    raw, out = f"{tmp_dir}/raw", f"{tmp_dir}/out"
    ev = raw_events(table(spark, sf_small, "events"))
    write_region_csv(ev.filter("event_type <> 'view'"), raw)        # view: output only
    write_region_csv(ev.filter("event_type <> 'click'"), out)       # click: input only
    st = {r["region"]: r["status"] for r in compare_inventories(spark, raw, out).collect()}
    assert st["click"] == "MISSING_OUTPUT" and st["view"] == "NO_INPUT" and st["error"] == "OK"


def test_cli_snapshot(spark, sf_small, tmp_dir, capsys):
    from chronoroll.cli import main
    from chronoroll.plans.edge import RAW_EVENT_COLUMNS
    raw = f"{tmp_dir}/raw"
    write_region_csv(raw_events(table(spark, sf_small, "events")), raw)
    code = main(["snapshot", "--raw", raw, "--out", f"{tmp_dir}/snap", "--latest",
                 f"{tmp_dir}/latest", "--columns", ",".join(RAW_EVENT_COLUMNS),
                 "--region-col", "event_type", "--files-per-region", "1"])
    assert code == 0
    out = capsys.readouterr().out
    assert "n_rows" in out and "MISSING_OUTPUT" not in out
    import glob
    for d in glob.glob(f"{tmp_dir}/latest/event_type=*"):
        assert len(glob.glob(f"{d}/*.csv")) == 1
