import numpy as np
from pyspark.sql import functions as F

from chronoroll.operators import (detail, exact_distinct, finish, reaggregate, rollup,
                                  sketch_summary, split_bad, with_event_time)
from chronoroll.plans.edge import raw_events, table
from chronoroll.plans.ingest import clean
from chronoroll.spec import Dim, Metric, TableSpec

SPEC = TableSpec(
    name="t", time_column="ts", time_format="MM/dd/yyyy hh:mm:ss a",
    dimensions=(Dim("event_type"), Dim("user_id", "long")),
    metrics=(Metric("count", "count"), Metric("v_sum", "doubleSum", "value", scale=2),
             Metric("v_avg", "doubleMean", "value", scale=2),
             Metric("v_avg_float", "doubleMean", "value"),
             Metric("users", "thetaSketch", "user_id"), Metric("users_hll", "hyperUnique", "user_id"),
             Metric("u_sum", "longSum", "user_id"), Metric("v_max", "doubleMax", "value")),
    query_granularity="hour", rollup=True)


def _raw(spark, sf):
    return raw_events(table(spark, sf, "events"))


def test_sum_of_count_is_rows_minus_quarantined(spark, sf_small):
    raw = _raw(spark, sf_small)
    good, bad = clean(raw, SPEC)
    rolled = rollup(good, SPEC)
    total = rolled.agg(F.sum("count")).collect()[0][0]
    assert total == raw.count() - bad.count()
    assert bad.count() > 0


def test_good_plus_bad_is_input(spark, sf_small):
    raw = _raw(spark, sf_small)
    timed = with_event_time(raw, SPEC)
    good, bad = split_bad(timed)
    assert good.count() + bad.count() == raw.count()


def test_reaggregate_hourly_to_daily_equals_direct(spark, sf_small):
    good, _ = clean(_raw(spark, sf_small), SPEC)
    hourly = rollup(good, SPEC)
    daily_spec = SPEC.with_(query_granularity="day")
    a = finish(reaggregate(hourly, SPEC, dims=["event_type"], granularity="day"), SPEC)
    b_spec = daily_spec.with_(dimensions=(Dim("event_type"),))
    b = finish(rollup(good, b_spec), b_spec)
    cols = ["__time", "event_type", "count", "v_sum", "v_avg", "users", "u_sum", "v_max"]
    ra = sorted(tuple(r) for r in a.select(cols).collect())
    rb = sorted(tuple(r) for r in b.select(cols).collect())
    assert ra == rb


def test_null_dimension_is_a_group(spark):
    df = spark.createDataFrame([("2024-01-01 10:00:00", None, 1.0), ("2024-01-01 10:30:00", None, 2.0),
                                ("2024-01-01 10:40:00", "a", 3.0)], "ts string, d string, value double")
    spec = TableSpec(name="t", time_column="ts", dimensions=(Dim("d"),),
                     metrics=(Metric("count", "count"),), query_granularity="hour", rollup=True)
    good, _ = clean(df, spec)
    out = {r["d"]: r["count"] for r in rollup(good, spec).collect()}
    assert out == {None: 2, "a": 1}


def test_detail_keeps_rows_with_unit_count(spark, sf_small):
    spec = SPEC.with_(rollup=False, metrics=(Metric("count", "count"),))
    good, _ = clean(_raw(spark, sf_small), spec)
    d = detail(good, spec)
    assert d.count() == good.count()
    assert d.agg(F.min("count"), F.max("count")).collect()[0] == (1, 1)


def test_no_metric_rollup_is_distinct_keys(spark, sf_small):
    spec = SPEC.with_(metrics=(), query_granularity="day")
    good, _ = clean(_raw(spark, sf_small), spec)
    r = rollup(good, spec)
    assert r.count() == r.distinct().count()
    assert set(r.columns) == {"__time", "event_type", "user_id"}


def test_hll_within_five_percent(spark, sf_small):
    ev = table(spark, sf_small, "events")
    spec = TableSpec(name="t", time_column="ts", metrics=(Metric("u", "hyperUnique", "event_id"),),
                     query_granularity="all", rollup=True)
    good, _ = clean(ev, spec)
    est = finish(rollup(good, spec), spec).collect()[0]["u"]
    exact = ev.select("event_id").distinct().count()
    assert abs(est - exact) / exact <= 0.05


def test_quantiles_close_to_numpy(spark, sf_small):
    ev = table(spark, sf_small, "events")
    s = sketch_summary(ev, [], "value", probs=(0.5, 0.9)).collect()[0]
    vals = np.array([r[0] for r in ev.select("value").collect()])
    for p, got in ((0.5, s["q50"]), (0.9, s["q90"])):
        # rank error of the sketch, not value error
        rank = (vals <= got).mean()
        assert abs(rank - p) < 0.03
    assert sum(b["y"] for b in s["histogram"]) == len(vals)


def test_exact_multi_distinct_matches_python(spark, sf_small):
    ev = table(spark, sf_small, "events")
    out = exact_distinct(ev, ["event_type"], {"users": "user_id", "days": F.to_date("ts")})
    rows = ev.select("event_type", "user_id", F.to_date("ts").alias("d")).collect()
    for r in out.collect():
        users = {x["user_id"] for x in rows if x["event_type"] == r["event_type"]}
        days = {x["d"] for x in rows if x["event_type"] == r["event_type"]}
        assert (r["users"], r["days"]) == (len(users), len(days))


def test_fixed_point_sum_is_order_independent(spark):
    vals = [0.1] * 10 + [1e6 + 0.01, -1e6]
    df = spark.createDataFrame([("2024-01-01 00:00:00", v) for v in vals], "ts string, value double")
    spec = TableSpec(name="t", time_column="ts", metrics=(Metric("s", "doubleSum", "value", scale=2),),
                     query_granularity="day", rollup=True)
    good, _ = clean(df.repartition(7), spec)
    assert finish(rollup(good, spec), spec).collect()[0]["s"] == 1.01


def test_interval_start_included_end_excluded(spark):
    import datetime as dt
    from chronoroll.operators import filter_intervals
    lo, hi, tick = dt.datetime(2023, 3, 5, 6), dt.datetime(2023, 4, 9), dt.timedelta(microseconds=1)
    df = spark.createDataFrame([(t,) for t in (lo - tick, lo, lo + tick, hi - tick, hi)], "__time timestamp_ntz")
    out = [r[0] for r in filter_intervals(df, ["2023-03-05T06:00:00/2023-04-09"]).orderBy("__time").collect()]
    assert out == [lo, lo + tick, hi - tick]


def test_rollup_intervals_inside_aggregation(spark):
    df = spark.createDataFrame([("2023-03-05T00:00:00", "a"), ("2023-03-05T23:59:59", "a"), ("2023-04-09T00:00:00", "a"),
                                ("2023-04-08T10:00:00", "b"), ("soon", "b")], "ts string, d string")
    spec = TableSpec(name="t", time_column="ts", dimensions=(Dim("d"),),
                     metrics=(Metric("count", "count"),), query_granularity="day", rollup=True,
                     intervals=("2023-03-05/2023-04-09",))
    from chronoroll.plans.ingest import prepare
    rows, bad = prepare(df, spec)
    got = sorted((str(r["__time"]), r["d"], r["count"]) for r in rows.collect())
    assert got == [("2023-03-05 00:00:00", "a", 2), ("2023-04-08 00:00:00", "b", 1)]
    assert bad.count() == 1


def test_run_ingest_counts_and_quarantine_from_one_pass(spark, sf_small, tmp_dir):
    from chronoroll.plans.ingest import run_ingest, read_ingested
    spec = SPEC.with_(partition_col="event_type", dimensions=(Dim("event_type"),),
                      metrics=(Metric("count", "count"),))
    raw = _raw(spark, sf_small)
    res = run_ingest(spark, spec, raw, f"{tmp_dir}/t", quarantine_path=f"{tmp_dir}/q")
    c = res.counts.agg(F.sum("rows_in"), F.sum("rows_loaded"), F.sum("rows_bad")).collect()[0]
    assert c[0] == raw.count()
    assert c[1] == read_ingested(spark, spec, f"{tmp_dir}/t").agg(F.sum("count")).collect()[0][0]
    assert c[2] == spark.read.parquet(f"{tmp_dir}/q").count() and c[0] == c[1] + c[2]


def test_dimension_missing_from_input_is_null(spark):
    df = spark.createDataFrame([("2024-01-01 10:00:00", "a")], "ts string, d string")
    spec = TableSpec(name="t", time_column="ts", dimensions=(Dim("d"), Dim("absent", "long")),
                     metrics=(Metric("count", "count"),), query_granularity="day", rollup=True)
    good, _ = clean(df, spec)
    r = rollup(good, spec).collect()[0]
    assert r["absent"] is None and r["count"] == 1
    assert dict(rollup(good, spec).dtypes)["absent"] == "bigint"


def test_keep_rows_equals_filter_and_parses_once(spark, sf_small):
    from chronoroll.operators import keep_rows
    raw = _raw(spark, sf_small)
    timed = with_event_time(raw, SPEC)
    cond = F.col("__time").isNotNull()
    a = sorted(tuple(r) for r in keep_rows(timed, cond).collect())
    b = sorted(tuple(r) for r in timed.filter(cond).collect())
    assert a == b and len(a) < raw.count()
    good, _ = clean(raw, SPEC)
    plan = good._jdf.queryExecution().executedPlan().toString()
    assert plan.count("gettimestamp") == 1


def test_two_pass_ingest_matches_one_pass(spark, sf_small, tmp_dir):
    from chronoroll.plans.ingest import run_ingest, read_ingested
    spec = SPEC.with_(partition_col="event_type", dimensions=(Dim("event_type"),),
                      metrics=(Metric("count", "count"), Metric("v", "doubleSum", "value", scale=2)))
    raw = _raw(spark, sf_small)
    run_ingest(spark, spec, raw, f"{tmp_dir}/a", quarantine_path=f"{tmp_dir}/qa")
    run_ingest(spark, spec, raw, f"{tmp_dir}/b", quarantine_path=f"{tmp_dir}/qb", one_pass=False)
    cols = ["__time", "event_type", "count", "v__units"]
    a = sorted(tuple(r) for r in read_ingested(spark, spec, f"{tmp_dir}/a").select(cols).collect())
    b = sorted(tuple(r) for r in read_ingested(spark, spec, f"{tmp_dir}/b").select(cols).collect())
    assert a == b
    qa = sorted(r["_raw_time"] or "" for r in spark.read.parquet(f"{tmp_dir}/qa").collect())
    qb = sorted(r["_raw_time"] or "" for r in spark.read.parquet(f"{tmp_dir}/qb").collect())
    assert qa == qb and qa
