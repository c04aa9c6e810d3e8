
from pyspark.sql import functions as F

from chronoroll.plans.ingest import read_ingested
from chronoroll.plans.spec_job import (_iso_period, run_spec, source_from_io_config,
                                       topic_options)
from chronoroll.plans.edge import table
from chronoroll.spec import TableSpec


def _parquet_spec(rollup=None):
    gran = {"segmentGranularity": "month", "queryGranularity": "day"}
    if rollup is not None:
        gran["rollup"] = rollup
    return {"type": "index_parallel", "spec": {
        "ioConfig": {"type": "index_parallel",
                     "inputSource": {"type": "local", "baseDir": None, "filter": "orders.parquet"},
                     "inputFormat": {"type": "parquet"}},
        "dataSchema": {"dataSource": "orders_days",
                       "timestampSpec": {"column": "o_orderdate", "format": "iso"},
                       "dimensionsSpec": {"dimensions": ["o_orderstatus", "o_orderpriority"]},
                       "granularitySpec": gran}}}


def test_parquet_spec_distinct_days(spark, sf_small, tmp_dir):
    spec_json = _parquet_spec(rollup=True)
    run_spec(spark, spec_json, f"{tmp_dir}/t", base_override=sf_small)
    spec = TableSpec.from_dict(spec_json["spec"])
    got = read_ingested(spark, spec, f"{tmp_dir}/t")
    o = table(spark, sf_small, "orders")
    want = o.select(F.to_date("o_orderdate"), "o_orderstatus", "o_orderpriority").distinct().count()
    assert got.count() == want
    assert set(got.columns) == {"__time", "o_orderstatus", "o_orderpriority", "chunk"}


def test_json_input_is_read_with_declared_schema(spark, sf_small, tmp_dir):
    ev = table(spark, sf_small, "events").select(F.col("ts").cast("string").alias("ts"),
                                                  "event_type", "value")
    ev.write.mode("overwrite").json(f"{tmp_dir}/in")
    spec = TableSpec.from_dict({"dataSchema": {
        "timestampSpec": {"column": "ts", "format": "iso"},
        "dimensionsSpec": {"dimensions": ["event_type"]},
        "metricsSpec": [{"name": "count", "type": "count"}],
        "granularitySpec": {"queryGranularity": "day", "rollup": True}}})
    io = {"inputSource": {"type": "local", "baseDir": f"{tmp_dir}/in", "filter": "*.json"},
          "inputFormat": {"type": "json"}}
    df = source_from_io_config(spark, io, spec)
    assert dict(df.dtypes) == {"ts": "string", "event_type": "string", "_malformed": "string"}
    assert df.count() == ev.count()


def test_iso_period():
    assert _iso_period("PT10M") == "600 seconds"
    assert _iso_period("PT1H30S") == "3630 seconds"


def test_detail_spec_over_region_folders_with_awkward_names(spark, tmp_dir):
    import os
    cols = ["event no", "seen on", "kind, long", "reading (raw)"]
    lines = {
        "click": ['"event no","seen on","kind, long","reading (raw)"',
                  '7,03/02/2021 04:15:30 PM,"tap, double",12.5', '8,03/02/2021 12:00:00 AM,tap,n/a'],
        "view": ['"event no","seen on","kind, long","reading (raw)"', '9,,scroll,1', '10,31/31/2021 01:00:00 AM,scroll,2'],
    }
    for kind, text in lines.items():
        os.makedirs(f"{tmp_dir}/drop/{kind}")
        with open(f"{tmp_dir}/drop/{kind}/a.csv", "w") as f:
            f.write("\n".join(text) + "\n")
    spec_json = {"spec": {
        "dataSchema": {
            "timestampSpec": {"column": "seen on", "format": "MM/dd/yyyy hh:mm:ss a"},
            "granularitySpec": {"rollup": False, "queryGranularity": "fifteen_minute",
                                "segmentGranularity": "week"},
            "dimensionsSpec": {"dimensionExclusions": ["seen on"],
                               "dimensions": [{"name": "event no", "type": "long"}, "kind, long",
                                              {"name": "reading (raw)", "type": "double"}]},
            "metricsSpec": [{"type": "count", "name": "n"}],
            "dataSource": "readings"},
        "ioConfig": {"inputFormat": {"type": "csv", "columns": cols, "skipHeaderRows": 1,
                                     "findColumnsFromHeader": False},
                     "inputSource": {"type": "local", "filter": "*/*.csv", "baseDir": f"{tmp_dir}/drop"}}}}
    res = run_spec(spark, spec_json, f"{tmp_dir}/t", quarantine_path=f"{tmp_dir}/q")
    spec = TableSpec.from_dict(spec_json["spec"])
    got = {r["event no"]: r for r in read_ingested(spark, spec, f"{tmp_dir}/t").collect()}
    assert set(got) == {7, 8}
    assert str(got[7]["__time"]) == "2021-03-02 16:15:00" and got[7]["kind, long"] == "tap, double"
    assert got[8]["reading (raw)"] is None and got[8]["n"] == 1 and "seen on" not in got[7].asDict()
    bad = {r["event no"]: r["_bad_reason"] for r in spark.read.parquet(f"{tmp_dir}/q").collect()}
    assert bad == {"9": "missing time", "10": "unparseable time"}
    assert res.partition_cols == ("chunk",)


def test_sql_input_source_maps_to_a_jdbc_query(spark, sf_small, monkeypatch):
    """No database is started: the JDBC reader is replaced by a recorder."""
    import chronoroll.plans.spec_job as sj
    calls = []

    def fake_query(spark_, opts, sql, **kw):
        calls.append((opts.as_dict(), sql, kw))
        return table(spark, sf_small, "orders")

    monkeypatch.setattr(sj, "read_jdbc_query", fake_query)
    io = {"inputSource": {
        "type": "sql", "typedTime": True, "partitionColumn": "o_orderkey", "lowerBound": 1,
        "upperBound": 6000, "numPartitions": 8,
        "database": {"connectorConfig": {"connectURI": "jdbc:sqlite:none", "user": "reader"}},
        "sql": "SELECT o_orderkey, o_orderdate FROM orders WHERE o_totalprice > 10"}}
    spec = TableSpec(name="t", time_column="o_orderdate", intervals=("1995-01-01/1996-01-01T12:00:00",))
    df = source_from_io_config(spark, io, spec)
    assert calls == [(
        {"url": "jdbc:sqlite:none", "user": "reader"},
        "SELECT * FROM (SELECT o_orderkey, o_orderdate FROM orders WHERE o_totalprice > 10) i WHERE o_orderdate IS NULL "
        "OR (o_orderdate >= TIMESTAMP '1995-01-01 00:00:00' AND o_orderdate < TIMESTAMP '1996-01-01 12:00:00')",
        {"partition_column": "o_orderkey", "lower_bound": 1, "upper_bound": 6000, "num_partitions": 8})]
    assert df.count() == table(spark, sf_small, "orders").count()


def test_topic_options_follow_the_spec():
    opts = topic_options({"consumerProperties": {"bootstrap.servers": "b:1"}, "useEarliestOffset": True})
    assert opts["startingOffsets"] == "earliest" and opts["kafka.bootstrap.servers"] == "b:1"
    assert topic_options({})["startingOffsets"] == "latest" and int(topic_options({})["maxOffsetsPerTrigger"]) > 0


def test_path_lists_and_parquet_globs(spark, sf_small, tmp_dir):
    o = table(spark, sf_small, "orders")
    o.where("o_orderkey % 2 = 0").write.parquet(f"{tmp_dir}/in/even")
    o.where("o_orderkey % 2 = 1").write.parquet(f"{tmp_dir}/in/odd")
    spec_json = _parquet_spec(rollup=True)
    want = o.select(F.to_date("o_orderdate"), "o_orderstatus", "o_orderpriority").distinct().count()
    for source in ({"baseDir": f"{tmp_dir}/in", "filter": "*/*.parquet"}, {"paths": [f"{tmp_dir}/in/even", f"{tmp_dir}/in/odd"]}):
        spec_json["spec"]["ioConfig"]["inputSource"] = source
        res = run_spec(spark, spec_json, f"{tmp_dir}/t{len(source)}")
        assert spark.read.parquet(res.table).count() == want
    spec = TableSpec.from_dict({**spec_json["spec"], "partitionColumn": "part"})
    io = {"inputSource": {"baseDir": f"{tmp_dir}/in", "filter": "*/*.parquet"}, "inputFormat": {"type": "parquet"}}
    only = source_from_io_config(spark, io, spec, regions=["odd"])
    assert {r[0] for r in only.select("part").distinct().collect()} == {"odd"}


def test_header_of_several_lines(spark, tmp_dir):
    import os
    for k in range(3):
        os.makedirs(f"{tmp_dir}/raw/r{k}")
        with open(f"{tmp_dir}/raw/r{k}/x.csv", "w") as f:
            f.write(f"made by a tool\nno,at,v\n{k},2021-01-0{k + 1}T00:00:00,5\n1{k},2021-01-01T00:00:00\n")
    io = {"inputSource": {"baseDir": f"{tmp_dir}/raw", "filter": "*/*.csv"},
          "inputFormat": {"type": "csv", "skipHeaderRows": 2, "columns": ["no", "at", "v"]}}
    spec = TableSpec(name="t", time_column="at", partition_col="region")
    rows = source_from_io_config(spark, io, spec).collect()
    assert {(r["no"], r["region"], r["_malformed"]) for r in rows} == {
        *[(str(k), f"r{k}", None) for k in range(3)], *[(f"1{k}", f"r{k}", f"1{k},2021-01-01T00:00:00") for k in range(3)]}
