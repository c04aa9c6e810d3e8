"""The registered queries: every operator run over the driver's tables.

Each query takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
*whole* input tables (or data Spark derived from all of their rows). Inputs
that the reference reads as text — region folders of CSV files, JSON
messages — are first written by Spark from the full ``events`` / ``orders``
tables below the shared checkpoint folder. ``ORACLE_SQL`` holds, for every
query whose answer is exact, the same result stated in plain SQL over the
driver's tables; approximate sketches have none.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.time import (REFERENCE_TIME_FORMAT, floor_time, format_reference_time, format_run_id,
                              parse_time, run_id, utc_epoch_millis)
from ..functions.values import parse_json, to_csv_line
from ..operators.clean import (BAD_REASON, RAW_TIME, coerce_columns, filter_partition,
                               preview, rename_positional, stamp, tag, with_event_time, with_expr)
from ..operators.lookup import lookup
from ..operators.rollup import (counts_by, detail, distinct_values, exact_distinct, finish,
                                reaggregate, rollup, sketch_summary)
from ..operators.union import union_by_name, union_by_position
from ..session import scratch_path
from ..sinks.files import publish_json, replace_partitions, write_snapshot_and_latest, write_table
from ..sources.files import (from_csv_lines, read_csv, read_csv_positional, read_parquet,
                             read_partitioned_csv)
from ..spec import Dim, Metric, TableSpec
from ..streaming.stream import (compact_stream_rollup, purge_compacted, read_json_stream,
                                read_stream_rollup, read_stream_window, stream_quarantine,
                                stream_rollup, stream_window, compact_stream_window,
                                purge_window)
from .audit import compare_inventories, inventory, load_audit, make_folder
from .catalog import ctas, register
from .edge import (BAD_TIME_MOD, BAD_TIME_TEXT, BAD_USER_MOD, BAD_VALUE_MOD, BAD_VALUE_TEXT, GARBLED_MOD, HOT_MOD,
                   HOT_REGION, MISSING_TIME_MOD, RAW_EVENT_COLUMNS, publish_events, raw_events, table,
                   with_hot_region, write_region_csv)
from .ingest import clean, read_ingested, read_range, read_table, run_ingest
from .snapshot import read_snapshot, snapshot_regions
from .spec_job import run_spec, run_stream_spec

# ---------------------------------------------------------------- table specs

COUNT = Metric("count", "count")
MISSING_TIME = "2019-06-30T12:00:00Z"     # default of the queries for a missing time

EVENTS_HOURLY = TableSpec(
    name="events_hourly", time_column="ts", time_format=REFERENCE_TIME_FORMAT,
    dimensions=(Dim("event_type"),),
    metrics=(COUNT, Metric("value_sum", "doubleSum", "value", scale=2),
             Metric("value_avg", "doubleMean", "value", scale=2),
             Metric("user_sum", "longSum", "user_id")),
    query_granularity="hour", segment_granularity="month", rollup=True,
    partition_col="event_type")

EVENTS_HOURLY_TYPED = TableSpec(
    name="events_hourly_typed", time_column="ts",
    dimensions=(Dim("event_type"),),
    metrics=(COUNT, Metric("value_sum", "doubleSum", "value", scale=2),
             Metric("value_avg", "doubleMean", "value", scale=2),
             Metric("value_min", "doubleMin", "value"), Metric("value_max", "doubleMax", "value"),
             Metric("user_sum", "longSum", "user_id")),
    query_granularity="hour", segment_granularity="day", rollup=True)

ORDERS_DAILY = TableSpec(
    name="orders_daily", time_column="o_orderdate",
    dimensions=(Dim("o_orderstatus"), Dim("o_orderpriority")),
    metrics=(COUNT, Metric("price_sum", "doubleSum", "o_totalprice", scale=2),
             Metric("price_avg", "doubleMean", "o_totalprice", scale=2)),
    query_granularity="day", segment_granularity="month", rollup=True)

# A message stream: text times, a default for a missing time, a daily rollup
# with count, a mean and a long sum, month chunks.
STREAM_DAILY = TableSpec(
    name="events_stream_daily", time_column="ts", time_format=REFERENCE_TIME_FORMAT,
    missing_time=MISSING_TIME,
    dimensions=(Dim("event_type"),),
    metrics=(COUNT, Metric("value_avg", "doubleAvg", "value", scale=2),
             Metric("user_sum", "longSum", "user_id")),
    query_granularity="day", segment_granularity="month", rollup=True)

MESSAGE_DDL = ", ".join(f"{c} STRING" for c in
                        ["event_id", "ts", "user_id", "event_type", "value", "props"])

ORDERS_SPEC_JSON = {
    "dataSchema": {
        "dataSource": "orders_monthly",
        "timestampSpec": {"column": "o_orderdate", "format": "iso",
                          "missingValue": "2000-01-01T00:00:00Z"},
        "dimensionsSpec": {"dimensions": ["o_orderstatus", "o_orderpriority"]},
        "metricsSpec": [
            {"name": "count", "type": "count"},
            {"name": "orders", "type": "thetaSketch", "fieldName": "o_orderkey"},
            {"name": "price_avg", "type": "doubleMean", "fieldName": "o_totalprice", "scale": 2},
        ],
        "granularitySpec": {"segmentGranularity": "year", "queryGranularity": "month",
                            "rollup": True, "intervals": ["1996-01-01/2000-01-01"]},
    }
}

# A detail spec: region folders of CSV files with declared positional columns
# and a discarded header, text times, typed dimensions, half-hour buckets. The
# key names and the time pattern are fixed values of the format.
EVENTS_DETAIL_SPEC_JSON = {"spec": {
    "dataSchema": {
        "dataSource": "event_rows",
        "timestampSpec": {"column": "happened", "format": REFERENCE_TIME_FORMAT},
        "dimensionsSpec": {"dimensions": [{"name": "id", "type": "long"}, {"name": "uid", "type": "long"},
                                          {"name": "amount", "type": "double"}, "payload"]},
        "metricsSpec": [{"name": "n", "type": "count"}],
        "granularitySpec": {"segmentGranularity": "week", "queryGranularity": "thirty_minute", "rollup": False}},
    "ioConfig": {
        "inputSource": {"type": "local", "filter": "*/*.csv"},
        "inputFormat": {"type": "csv", "columns": ["id", "happened", "uid", "amount", "payload"],
                        "findColumnsFromHeader": False, "skipHeaderRows": 1}},
    "tuningConfig": {"maxRowsPerSegment": 250_000, "dropExisting": True},
    "partitionColumn": "region"}}

# A message-topic spec: text times, a default for a missing time, a daily
# rollup in month chunks (the same table as STREAM_DAILY).
EVENTS_STREAM_SPEC_JSON = {"spec": {
    "dataSchema": {
        "dataSource": "event_days",
        "timestampSpec": {"column": "ts", "format": REFERENCE_TIME_FORMAT, "missingValue": MISSING_TIME},
        "dimensionsSpec": {"dimensions": ["event_type"]},
        "metricsSpec": [{"name": "count", "type": "count"},
                        {"name": "value_avg", "type": "doubleMean", "fieldName": "value", "scale": 2},
                        {"name": "user_sum", "type": "longSum", "fieldName": "user_id"}],
        "granularitySpec": {"segmentGranularity": "month", "queryGranularity": "day", "rollup": True}},
    "ioConfig": {"type": "kafka", "topic": "events", "useEarliestOffset": True,
                 "consumerProperties": {"bootstrap.servers": "broker:9092"}},
    "tuningConfig": {"maxRowsPerSegment": 400_000, "intermediatePersistPeriod": "PT2M30S"}}}

HISTOGRAM_BINS = 10
RANGE = ("1997-03-15/1997-06-01", "1999-12-31/2000-01-02")
INTERVALS = ("2024-01-03/2024-01-10", "2024-01-20T12:00:00/2024-01-25")
SNAPSHOT_TS = "2024-02-01T00:00:00"


# ---------------------------------------------------------------- helpers

def _events(spark, sf):
    return table(spark, sf, "events")


def _raw_csv(spark, sf) -> DataFrame:
    """All events written as region folders of CSV text, read back."""
    base = scratch_path(spark, "raw-events")
    write_region_csv(raw_events(_events(spark, sf)), base)
    return read_partitioned_csv(spark, base, columns=RAW_EVENT_COLUMNS, partition_col="event_type")


def _typed_raw(raw: DataFrame) -> DataFrame:
    return coerce_columns(raw, {"event_id": "long", "user_id": "long", "value": "double"})


# ---------------------------------------------------------------- queries

def q_csv_hourly_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship: region CSV → type → parse → quarantine → hourly rollup → month
    chunks → SQL over the stored table (S1 P3 F4 P11 A5 K6 Q1)."""
    raw = _raw_csv(spark, sf)
    out, bad = scratch_path(spark, "events-hourly"), scratch_path(spark, "events-hourly-bad")
    run_ingest(spark, EVENTS_HOURLY, raw, out, quarantine_path=bad)
    register(spark, "events_hourly", finish(read_ingested(spark, EVENTS_HOURLY, out), EVENTS_HOURLY))
    return spark.sql("SELECT __time, event_type, chunk, `count`, value_sum, value_avg, user_sum "
                     "FROM events_hourly")


def q_region_reload(spark, sf):
    """Load every region, then reload one region from a newer raw drop
    (measures doubled): only that region's partitions change (D5 intent)."""
    ev = _events(spark, sf)
    first, second = scratch_path(spark, "raw-events"), scratch_path(spark, "raw-events-2")
    write_region_csv(raw_events(ev), first)
    write_region_csv(raw_events(ev.withColumn("value", F.col("value") * 2)), second)
    out = scratch_path(spark, "events-hourly")
    read = lambda base, regions=None: read_partitioned_csv(
        spark, base, columns=RAW_EVENT_COLUMNS, partition_col="event_type", regions=regions)
    run_ingest(spark, EVENTS_HOURLY, read(first), out)
    run_ingest(spark, EVENTS_HOURLY, read(second, ["click"]), out)
    return finish(read_ingested(spark, EVENTS_HOURLY, out), EVENTS_HOURLY)


def q_skewed_region_rollup(spark, sf):
    """The flagship ingest with a third of all rows in one region: partial
    aggregation before the shuffle and size-sized writer tasks carry it."""
    base = scratch_path(spark, "raw-events-skewed")
    write_region_csv(with_hot_region(raw_events(_events(spark, sf))), base)
    raw = read_partitioned_csv(spark, base, columns=RAW_EVENT_COLUMNS, partition_col="event_type")
    out, bad = scratch_path(spark, "events-hourly-skewed"), scratch_path(spark, "bad-skewed")
    res = run_ingest(spark, EVENTS_HOURLY, raw, out, quarantine_path=bad)
    table_rows = finish(read_ingested(spark, EVENTS_HOURLY, out), EVENTS_HOURLY)
    return table_rows.join(res.counts.select("event_type", "rows_in", "rows_bad"), "event_type")


def q_partitioned_csv_ingest(spark, sf):
    raw = _typed_raw(_raw_csv(spark, sf))
    return raw.select("event_id", parse_time("ts", REFERENCE_TIME_FORMAT).alias("ts"),
                      "user_id", "event_type", "value", "props")


def q_csv_infer_ingest(spark, sf):
    ev = _events(spark, sf).select("event_id", format_reference_time("ts").alias("ts"),
                                    "user_id", "event_type", "value", "props")
    path = write_table(ev, scratch_path(spark, "csv-infer"), fmt="csv")
    df = read_csv(spark, path, infer=True)
    inferred = df.schema["ts"].dataType.simpleString()
    return df.select(F.col("event_id").cast("long").alias("event_id"), "ts",
                     F.col("user_id").cast("long").alias("user_id"), "event_type",
                     F.col("value").cast("double").alias("value"), "props",
                     F.lit(inferred).alias("ts_inferred_type"))


def q_preview_first_rows(spark, sf):
    ev = _events(spark, sf)
    return preview(ev.orderBy("event_id"), 5).select("event_id", "ts", "event_type")


def q_csv_positional_ingest(spark, sf):
    path = write_table(table(spark, sf, "orders"), scratch_path(spark, "orders-csv"), fmt="csv")
    names = ["order_id", "customer_id", "status", "total_price", "order_date", "priority"]
    df = read_csv_positional(spark, path, names)
    df = coerce_columns(df, {"order_id": "long", "customer_id": "long", "total_price": "double"})
    return df.withColumn("order_date", parse_time("order_date", "iso"))


def q_parquet_daily_distinct(spark, sf):
    spec = TableSpec(name="events_daily_keys", time_column="ts",
                     dimensions=(Dim("event_type"), Dim("user_id", "long")),
                     query_granularity="day", segment_granularity="month", rollup=True)
    good, _ = clean(read_parquet(spark, sf, glob="events.parquet"), spec)
    return rollup(good, spec)


def q_csv_lines_column(spark, sf):
    o = table(spark, sf, "orders")
    row = F.struct("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                   F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"), "o_orderpriority")
    lines = o.select(F.to_csv(row).alias("line"))
    return from_csv_lines(lines, "line", "order_id BIGINT, customer_id BIGINT, status STRING, "
                                         "total_price DOUBLE, order_date STRING, priority STRING")


def q_json_props(spark, sf):
    ev = _events(spark, sf)
    return ev.select("event_id", parse_json("props", "k BIGINT").getField("k").alias("k"))


def q_project_exclude(spark, sf):
    spec = TableSpec(name="events_detail", time_column="ts",
                     dimensions=(Dim("event_id", "long"), Dim("event_type"), Dim("user_id", "long")),
                     exclude=("ts",))
    good, _ = clean(_events(spark, sf), spec)
    return good.select("__time", "event_id", "event_type", "user_id")


def q_coerce_types(spark, sf):
    raw = _typed_raw(raw_events(_events(spark, sf)))
    return raw.select("event_id", "user_id", "value", "event_type")


def q_missing_time_default(spark, sf):
    spec = TableSpec(name="t", time_column="ts", time_format=REFERENCE_TIME_FORMAT,
                     missing_time=MISSING_TIME)
    raw = _typed_raw(raw_events(_events(spark, sf)))
    return with_event_time(raw, spec).select("event_id", "__time")


def q_quarantine_bad(spark, sf):
    spec = TableSpec(name="t", time_column="ts", time_format=REFERENCE_TIME_FORMAT,
                     missing_time=MISSING_TIME,
                     dimensions=(Dim("event_id", "long"), Dim("event_type")))
    _, bad = clean(raw_events(_events(spark, sf)), spec)
    return bad.select(F.col("event_id").cast("long").alias("event_id"), F.col(RAW_TIME).alias("raw_time"),
                      F.col(BAD_REASON).alias("reason"))


def q_auto_time(spark, sf):
    ev = _events(spark, sf)
    text = F.when(F.col("event_id") % 2 == 0, F.col("ts").cast("string")) \
            .otherwise(utc_epoch_millis("ts").cast("string"))
    return ev.select("event_id", parse_time(text, "auto").alias("__time"))


def q_interval_filter(spark, sf):
    spec = TableSpec(name="t", time_column="ts",
                     dimensions=(Dim("event_id", "long"), Dim("event_type")), intervals=INTERVALS)
    good, _ = clean(_events(spark, sf), spec)
    return good.select("__time", "event_id", "event_type")


def q_partition_filter(spark, sf):
    path = write_table(_events(spark, sf), scratch_path(spark, "events-by-type"), ["event_type"])
    df = read_table(spark, path, ["event_type"])
    return filter_partition(df, "event_type", "click") \
        .select("event_id", "ts", "user_id", "value", "event_type")


def q_select_star_hour(spark, sf):
    df = with_expr(_events(spark, sf), "hour_time",
                   "CAST(date_trunc('HOUR', ts) AS TIMESTAMP_NTZ)")
    return df.withColumn("run_id", format_run_id("ts"))


def q_rollup_hour(spark, sf):
    good, _ = clean(_events(spark, sf), EVENTS_HOURLY_TYPED)
    return finish(rollup(good, EVENTS_HOURLY_TYPED), EVENTS_HOURLY_TYPED)


def q_rollup_day_month_chunks(spark, sf):
    out = scratch_path(spark, "orders-daily")
    run_ingest(spark, ORDERS_DAILY, table(spark, sf, "orders"), out)
    return finish(read_ingested(spark, ORDERS_DAILY, out), ORDERS_DAILY)


def q_time_range_read(spark, sf):
    out = scratch_path(spark, "orders-daily")
    run_ingest(spark, ORDERS_DAILY, table(spark, sf, "orders"), out)
    return finish(read_range(spark, ORDERS_DAILY, out, RANGE), ORDERS_DAILY)


def q_detail_unit_count(spark, sf):
    spec = TableSpec(name="t", time_column="ts",
                     dimensions=(Dim("event_id", "long"), Dim("event_type")),
                     metrics=(COUNT,), query_granularity="hour", rollup=False)
    good, _ = clean(_events(spark, sf), spec)
    return detail(good, spec)


def q_reaggregate_day(spark, sf):
    spec = TableSpec(name="t", time_column="ts",
                     dimensions=(Dim("event_type"), Dim("user_id", "long")),
                     metrics=(COUNT, Metric("value_sum", "doubleSum", "value", scale=2),
                              Metric("value_avg", "doubleMean", "value", scale=2),
                              Metric("users", "thetaSketch", "user_id")),
                     query_granularity="hour", rollup=True)
    good, _ = clean(_events(spark, sf), spec)
    hourly = rollup(good, spec)
    daily = finish(reaggregate(hourly, spec, dims=["event_type"], granularity="day"), spec)
    exact = rollup(good, spec.with_(dimensions=(Dim("event_type"), Dim("user_id", "long")),
                                    metrics=(), query_granularity="day")).groupBy("__time", "event_type").count()
    return _within(daily, exact, "users")


def _within(estimated: DataFrame, exact: DataFrame, name: str, share: float = 0.05) -> DataFrame:
    """``estimated`` with ``name`` replaced by whether it is within ``share`` of the exact count.

    A sketch is exact only while it is small; what holds at every size is its
    error bound. The exact count is computed here for the check alone.
    """
    keys = [c for c in exact.columns if c != "count"]
    e, x = estimated.alias("e"), exact.alias("x")
    same = [F.col(f"e.`{k}`").eqNullSafe(F.col(f"x.`{k}`")) for k in keys]
    bound = F.greatest(F.lit(share) * F.col("x.count"), F.lit(1.0))
    ok = F.abs(F.col(f"e.`{name}`") - F.col("x.count")) <= bound
    return e.join(x, same).select(*[ok.alias(f"{name}_within") if c == name else F.col(f"e.`{c}`")
                                    for c in estimated.columns])


def q_distinct_regions(spark, sf):
    return distinct_values(_raw_csv(spark, sf), "event_type")


def q_region_counts(spark, sf):
    return counts_by(_raw_csv(spark, sf), "event_type", "n_rows")


def _distinct_spec(kind: str) -> TableSpec:
    return TableSpec(name="t", time_column="ts", dimensions=(Dim("event_type"),),
                     metrics=(Metric("users", kind, "user_id"),),
                     query_granularity="day", rollup=True)


def _approx_distinct(spark, sf, kind: str) -> DataFrame:
    spec = _distinct_spec(kind)
    good, _ = clean(_events(spark, sf), spec)
    exact = (good.groupBy(floor_time("__time", "day").alias("__time"), "event_type")
             .agg(F.count_distinct("user_id").alias("count")))
    return _within(finish(rollup(good, spec), spec), exact, "users")


def q_approx_distinct_theta(spark, sf):
    return _approx_distinct(spark, sf, "thetaSketch")


def q_approx_distinct_hll(spark, sf):
    return _approx_distinct(spark, sf, "hyperUnique")


def q_exact_multi_distinct(spark, sf):
    ev = _events(spark, sf)
    return exact_distinct(ev, ["event_type"], {"users": "user_id", "days": F.to_date("ts"),
                                               "hours": floor_time("ts", "hour")})


def q_quantile_sketch(spark, sf):
    """Rows, extremes, and whether each quantile estimate has about its share of rows below it."""
    ev = _events(spark, sf)
    s = sketch_summary(ev, ["event_type"], "value").select("event_type", "n", "q50", "q90", "q99")
    near = lambda q, share: F.abs(F.avg((F.col("value") <= F.col(q)).cast("double")) - share) <= 0.03
    return (ev.join(s, "event_type").groupBy("event_type").agg(
        F.max("n").alias("n"), F.min("value").alias("value_min"), F.max("value").alias("value_max"),
        near("q50", 0.5).alias("q50_within"), near("q90", 0.9).alias("q90_within"),
        near("q99", 0.99).alias("q99_within")))


def q_value_histogram(spark, sf):
    """What a histogram's bins must add up to, whatever their borders."""
    s = sketch_summary(_events(spark, sf), ["event_type"], "value")
    bins = s.select("event_type", F.explode("histogram").alias("bin"))
    return bins.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n_bins"), F.sum("bin.y").cast("long").alias("n_rows"))


def q_snapshot_latest(spark, sf):
    df = stamp(_events(spark, sf), "processing_ts", SNAPSHOT_TS)
    base, latest = scratch_path(spark, "snapshots"), scratch_path(spark, "latest")
    _, latest = write_snapshot_and_latest(df, base, latest, "20240201000000", "event_type")
    return read_snapshot(spark, latest, df.schema, "event_type")


def q_append_table(spark, sf):
    spec = TableSpec(name="t", time_column="ts",
                     dimensions=(Dim("event_id", "long"), Dim("event_type")),
                     metrics=(COUNT,), segment_granularity="day", rollup=False)
    out = scratch_path(spark, "events-append")
    ev = _events(spark, sf)
    run_ingest(spark, spec, ev, out, mode="append")
    run_ingest(spark, spec, ev, out, mode="append")
    return read_ingested(spark, spec, out).select("__time", "event_id", "event_type", "count")


def q_replace_partitions(spark, sf):
    ev = _events(spark, sf).select("event_id", "event_type", "value")
    path = write_table(ev, scratch_path(spark, "events-replace"), ["event_type"])
    clicks = ev.filter(F.col("event_type") == "click").withColumn("value", F.col("value") * 2)
    reload = tag(clicks.drop("event_type"), "event_type", "click").select(ev.columns)
    replace_partitions(reload, path, ["event_type"])
    return read_table(spark, path, ["event_type"]).select("event_id", "event_type", "value")


def q_max_rows_per_file(spark, sf):
    cap = 500
    path = write_table(_events(spark, sf), scratch_path(spark, "events-capped"), ["event_type"],
                       max_rows_per_file=cap)
    df = read_table(spark, path, ["event_type"])
    per_file = df.groupBy("event_type", F.col("_metadata.file_path").alias("f")) \
                 .agg(F.count(F.lit(1)).alias("n"))
    return per_file.groupBy("event_type").agg(F.sum("n").cast("long").alias("n_rows"),
                                              (F.max("n") <= cap).alias("within_cap"))


def q_union_by_position(spark, sf):
    a = _events(spark, sf).select("event_id", "ts", "event_type")
    b = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority")
    return union_by_position([a, rename_positional(b, a.columns)])


def q_union_by_name(spark, sf):
    a = _events(spark, sf).select("event_id", "event_type", "value")
    b = table(spark, sf, "orders").select(F.col("o_totalprice").alias("value"),
                                           F.col("o_orderkey").alias("event_id"))
    return union_by_name([a, b])


#: Bytes of messages in a micro-batch, whatever the backlog.
STREAM_BATCH_BYTES = 64 << 20


def _stream_source(spark, sf, raw: DataFrame | None = None) -> DataFrame:
    """All events published as JSON messages, streamed as a backlog in micro-batches."""
    topic = scratch_path(spark, "topic")
    publish_events(raw_events(_events(spark, sf)) if raw is None else raw, topic)
    return read_json_stream(spark, topic, MESSAGE_DDL, max_bytes_per_trigger=STREAM_BATCH_BYTES)


def q_stream_rollup_day(spark, sf):
    out, ckpt = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-ckpt")
    q = stream_rollup(_stream_source(spark, sf), STREAM_DAILY, out, ckpt)
    q.awaitTermination()
    return read_stream_rollup(spark, STREAM_DAILY, out).drop("chunk")


def q_stream_compaction(spark, sf):
    """Stream, fold the first micro-batches into the compacted base, purge
    their folders, and read base + newer partials."""
    out, ckpt = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-ckpt")
    base = scratch_path(spark, "stream-base")
    stream_rollup(_stream_source(spark, sf), STREAM_DAILY, out, ckpt).awaitTermination()
    compact_stream_rollup(spark, STREAM_DAILY, out, base, upto_batch=0)
    purge_compacted(spark, out, base)
    return read_stream_rollup(spark, STREAM_DAILY, out, compacted_path=base).drop("chunk")


def q_stream_window_day(spark, sf):
    out, ckpt = scratch_path(spark, "window-out"), scratch_path(spark, "window-ckpt")
    stream_window(_stream_source(spark, sf), STREAM_DAILY, out, ckpt).awaitTermination()
    return read_stream_window(spark, STREAM_DAILY, out).drop("chunk")


def q_stream_window_hour(spark, sf):
    """Hour windows, folded into a base after the stream ended, read by chunk."""
    spec = STREAM_DAILY.with_(query_granularity="hour", segment_granularity="week")
    out, ckpt = scratch_path(spark, "window-out"), scratch_path(spark, "window-ckpt")
    base = scratch_path(spark, "window-base")
    stream_window(_stream_source(spark, sf), spec, out, ckpt).awaitTermination()
    purge_window(spark, out, compact_stream_window(spark, spec, out, base))
    return read_stream_window(spark, spec, out, base)


def q_stream_restart(spark, sf):
    """Half of the messages, then the rest after a restart from the checkpoint (ST3)."""
    raw = raw_events(_events(spark, sf))
    topic, out, ckpt = (scratch_path(spark, x) for x in ("topic", "stream-out", "stream-ckpt"))
    for half, rule in (("a", F.col("event_id").cast("long") % 2 == 0), ("b", F.col("event_id").cast("long") % 2 == 1)):
        publish_events(raw.where(rule), f"{topic}/part={half}")
        src = read_json_stream(spark, f"{topic}/*/*", MESSAGE_DDL, max_bytes_per_trigger=STREAM_BATCH_BYTES)
        stream_rollup(src, STREAM_DAILY, out, ckpt).awaitTermination()
    return read_stream_rollup(spark, STREAM_DAILY, out).drop("chunk")


def q_stream_quarantine(spark, sf):
    """The messages a windowed stream can't load, from a query of their own."""
    out, ckpt = scratch_path(spark, "stream-bad"), scratch_path(spark, "stream-bad-ckpt")
    stream_quarantine(_stream_source(spark, sf), STREAM_DAILY, out, ckpt).awaitTermination()
    return spark.read.parquet(out).select(F.col("event_id").cast("long").alias("event_id"),
                                          F.col(RAW_TIME).alias("raw_time"), F.col(BAD_REASON).alias("reason"))


def _garbled(raw: DataFrame) -> DataFrame:
    """Messages as text, one in GARBLED_MOD cut in the middle, one of these empty."""
    eid = F.col("event_id").cast("long")
    text = F.to_json(F.struct(*raw.columns))
    cut = F.when(eid % (GARBLED_MOD * 2) == 0, F.lit("")).otherwise(F.substring(text, 1, 25))
    return raw.select(F.when(eid % GARBLED_MOD == 0, cut).otherwise(text).alias("value"))


def q_malformed_messages(spark, sf):
    """Garbage on a topic: no records, not even with the default time, but on the bad side."""
    topic, out, ckpt, bad = (scratch_path(spark, x) for x in ("topic", "stream-out", "stream-ckpt", "stream-bad"))
    _garbled(raw_events(_events(spark, sf))).write.text(topic)
    src = read_json_stream(spark, topic, MESSAGE_DDL, max_bytes_per_trigger=STREAM_BATCH_BYTES)
    stream_rollup(src, STREAM_DAILY, out, ckpt, quarantine_path=bad).awaitTermination()
    loaded = (read_stream_rollup(spark, STREAM_DAILY, out).groupBy("event_type")
              .agg(F.sum("count").alias("n_rows")).withColumn("reason", F.lit("loaded")))
    set_aside = (spark.read.parquet(bad).groupBy("event_type", F.col(BAD_REASON).alias("reason"))
                 .agg(F.count(F.lit(1)).alias("n_rows")))
    return loaded.unionByName(set_aside)


def q_malformed_csv_lines(spark, sf):
    """CSV lines with a field too few or too many, set aside with their text; payloads hold commas and quotes."""
    raw = raw_events(_events(spark, sf))
    eid = F.col("event_id").cast("long")
    raw = raw.withColumn("props", F.when(eid % 4 == 0, F.concat(F.lit('say "hi", then '), "props")).otherwise(F.col("props")))
    line = to_csv_line(*RAW_EVENT_COLUMNS)
    short = F.concat_ws(",", "event_id", F.coalesce("ts", F.lit("")))
    line = (F.when(eid % (GARBLED_MOD * 2) == 0, F.concat(line, F.lit(",more")))
            .when(eid % GARBLED_MOD == 0, short).otherwise(line))
    base = scratch_path(spark, "csv-lines")
    raw.select(line.alias("value"), "event_type").write.partitionBy("event_type").text(base)
    out, bad = scratch_path(spark, "events-detail"), scratch_path(spark, "events-bad")
    job = {"spec": {**EVENTS_DETAIL_SPEC_JSON["spec"], "ioConfig": {
        "inputSource": {"baseDir": base, "filter": "*/*.txt"},
        "inputFormat": {"type": "csv", "columns": ["id", "happened", "uid", "amount", "payload"],
                        "findColumnsFromHeader": False, "skipHeaderRows": 0}}}}
    run_spec(spark, job, out, quarantine_path=bad)
    loaded = read_ingested(spark, TableSpec.from_dict(job["spec"]), out)
    n = [F.count(F.lit(1)).alias("n_rows"), F.sum(F.length("payload")).alias("payload_chars")]
    loaded = loaded.groupBy("region").agg(*n).withColumn("reason", F.lit("loaded"))
    set_aside = spark.read.parquet(bad).withColumn("payload", F.when(F.col("_malformed").isNull(), F.col("payload")))
    set_aside = set_aside.groupBy("region", F.col(BAD_REASON).alias("reason")).agg(*n)
    return loaded.unionByName(set_aside)


def q_region_reload_fewer_chunks(spark, sf):
    """A region loaded again with every second day gone: the whole region is replaced."""
    ev = _events(spark, sf)
    spec = EVENTS_HOURLY.with_(segment_granularity="day")
    out, paths = scratch_path(spark, "events-hourly"), [scratch_path(spark, f"raw-events-{k}") for k in (1, 2)]
    for k, path in enumerate(paths):
        write_region_csv(raw_events(ev if k == 0 else ev.where(F.dayofyear("ts") % 2 == 0)), path)
        regions = ["click"] if k else None
        raw = read_partitioned_csv(spark, path, columns=RAW_EVENT_COLUMNS, partition_col="event_type", regions=regions)
        run_ingest(spark, spec, raw, out, drop_existing=True, regions=regions)
    return finish(read_ingested(spark, spec, out), spec).groupBy("event_type", "chunk").agg(F.sum("count").alias("n_rows"))


def q_spec_region_reload(spark, sf):
    """A JSON spec run for all regions, then for one whose input lost its odd records."""
    ev = raw_events(_events(spark, sf))
    out, paths = scratch_path(spark, "events-detail"), [scratch_path(spark, f"raw-events-{k}") for k in (1, 2)]
    write_region_csv(ev, paths[0])
    write_region_csv(ev.where(F.col("event_id").cast("long") % 2 == 0), paths[1])
    run_spec(spark, EVENTS_DETAIL_SPEC_JSON, out, base_override=paths[0])
    run_spec(spark, EVENTS_DETAIL_SPEC_JSON, out, base_override=paths[1], regions=["view"])
    rows = read_ingested(spark, TableSpec.from_dict(EVENTS_DETAIL_SPEC_JSON["spec"]), out)
    return rows.groupBy("region").agg(F.sum("n").alias("n_rows"), F.sum("id").alias("id_sum"))


def q_latest_region_removed(spark, sf):
    """A second snapshot run without one region: ``latest`` holds that run's regions only."""
    ev = _events(spark, sf)
    base, latest = scratch_path(spark, "snapshots"), scratch_path(spark, "latest")
    write_snapshot_and_latest(ev, base, latest, run_id(dt.datetime(2024, 2, 1)), "event_type")
    write_snapshot_and_latest(ev.where("event_type <> 'view'"), base, latest, run_id(dt.datetime(2024, 2, 2)), "event_type")
    return counts_by(read_snapshot(spark, latest, ev.schema, "event_type"), "event_type", "n_rows")


def q_rollup_bad_numbers(spark, sf):
    """Cells that are NaN, infinite or written ``400.0`` among the numbers of a load."""
    eid = F.col("event_id")
    ev = _events(spark, sf).withColumn("value", F.when(eid % BAD_VALUE_MOD == 0, F.lit("NaN"))
                                       .when(eid % BAD_USER_MOD == 0, F.lit("Infinity")).otherwise(F.col("value").cast("string")))
    ev = ev.withColumn("user_id", F.when(eid % MISSING_TIME_MOD == 0, F.concat("user_id", F.lit(".5")))
                       .otherwise(F.concat("user_id", F.lit(".0"))))
    good, _ = clean(ev, EVENTS_HOURLY_TYPED)
    spec = EVENTS_HOURLY_TYPED.with_(metrics=tuple(m for m in EVENTS_HOURLY_TYPED.metrics if "M" not in m.type or "Mean" in m.type))
    return finish(rollup(good, spec), spec)


def q_mean_unscaled(spark, sf):
    """A plain mean and a plain sum, rounded at the end (their last bits depend on the order)."""
    spec = TableSpec(name="t", time_column="ts", dimensions=(Dim("event_type"),), query_granularity="month", rollup=True,
                     metrics=(Metric("value_avg", "doubleMean", "value"), Metric("value_sum", "doubleSum", "value")))
    good, _ = clean(_events(spark, sf), spec)
    out = finish(rollup(good, spec), spec)
    return out.select("__time", "event_type", *[F.round(c, 4).alias(c) for c in ("value_avg", "value_sum")])


def q_spec_job_parquet(spark, sf):
    """The Parquet spec without a rollup flag or metrics: distinct days of each user."""
    out = scratch_path(spark, "event-days")
    run_spec(spark, _parquet_spec("events.parquet"), out, base_override=sf)
    return read_ingested(spark, TableSpec.from_dict(_parquet_spec("")), out).drop("chunk")


def q_spec_job_parquet_region(spark, sf):
    """The same over region folders of Parquet files, for two of the regions."""
    base, out = scratch_path(spark, "events-by-type"), scratch_path(spark, "event-days")
    write_table(_events(spark, sf), base, ["event_type"])
    job = {**_parquet_spec("*/*.parquet"), "partitionColumn": "event_type"}
    run_spec(spark, job, out, base_override=base, regions=["click", "purchase"])
    return read_ingested(spark, TableSpec.from_dict(job), out).drop("chunk")


def _parquet_spec(pattern: str) -> dict:
    return {"dataSchema": {"dataSource": "event_days", "timestampSpec": {"column": "ts"},
                           "dimensionsSpec": {"dimensions": ["event_type", {"name": "user_id", "type": "long"}]},
                           "granularitySpec": {"segmentGranularity": "month", "queryGranularity": "day"}},
            "ioConfig": {"inputSource": {"filter": pattern}, "inputFormat": {"type": "parquet"}}}


def q_json_publish(spark, sf):
    topic = scratch_path(spark, "json-out")
    publish_json(_events(spark, sf), topic)
    msgs = spark.read.format("text").load(topic)
    m = msgs.select(parse_json("value", "event_id BIGINT, ts STRING, user_id BIGINT, "
                                        "event_type STRING, value DOUBLE, props STRING").alias("m"))
    return m.select("m.event_id", parse_time("m.ts", "iso").alias("ts"), "m.user_id",
                    "m.event_type", "m.value", "m.props")


def q_lookup_region(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    c = lookup(c, nation, "c_nationkey", "n_name", out="nation", map_key="n_nationkey",
               default="UNKNOWN")
    c = lookup(c, nation, "c_nationkey", "n_regionkey", out="_rk", map_key="n_nationkey")
    c = lookup(c, region, "_rk", "r_name", out="region", map_key="r_regionkey", default="UNKNOWN")
    return c.select("c_custkey", "c_nationkey", "nation", "region")


def q_inventory(spark, sf):
    """Bytes of cells per region folder: the header line of each file taken off, however many files there are."""
    base = scratch_path(spark, "raw-inventory")
    write_region_csv(raw_events(_events(spark, sf)), base)
    make_folder(spark, f"{base}/event_type=refund")
    header = len(",".join(RAW_EVENT_COLUMNS)) + 1
    return inventory(spark, base, "region").select(
        "region", (F.col("n_bytes") - header * F.col("n_files")).alias("cell_bytes"), "has_files")


def q_load_audit(spark, sf):
    raw = _raw_csv(spark, sf)
    out, bad = scratch_path(spark, "audit-table"), scratch_path(spark, "audit-bad")
    res = run_ingest(spark, EVENTS_HOURLY, raw, out, quarantine_path=bad)
    loaded = read_ingested(spark, EVENTS_HOURLY, out)
    audit = load_audit(res.counts, loaded, read_table(spark, bad, ["event_type"]), "event_type")
    return audit.drop("rows_outside")


def q_spec_job_rollup(spark, sf):
    spec = TableSpec.from_dict(ORDERS_SPEC_JSON)
    out = scratch_path(spark, "orders-monthly")
    o = table(spark, sf, "orders")
    run_ingest(spark, spec, o, out)
    month = floor_time("o_orderdate", "month").alias("__time")
    exact = (o.groupBy(month, "o_orderstatus", "o_orderpriority").agg(F.count_distinct("o_orderkey").alias("count")))
    return _within(finish(read_ingested(spark, spec, out), spec), exact, "orders")


def q_spec_job_csv_detail(spark, sf):
    base = scratch_path(spark, "raw-events")
    write_region_csv(raw_events(_events(spark, sf)), base)
    out = scratch_path(spark, "events-detail")
    run_spec(spark, EVENTS_DETAIL_SPEC_JSON, out, base_override=base)
    spec = TableSpec.from_dict(EVENTS_DETAIL_SPEC_JSON["spec"])
    return read_ingested(spark, spec, out)


def q_spec_job_stream(spark, sf):
    topic = scratch_path(spark, "topic")
    publish_events(raw_events(_events(spark, sf)), topic)
    out, ckpt = scratch_path(spark, "spec-stream-out"), scratch_path(spark, "spec-stream-ckpt")
    q, spec = run_stream_spec(spark, EVENTS_STREAM_SPEC_JSON, out, ckpt, source_override=topic)
    q.awaitTermination()
    return read_stream_rollup(spark, spec, out).drop("chunk")


def q_stream_timed_persist(spark, sf):
    """A stream that persists on the period its spec states (ST2); half of the messages come while it runs."""
    raw = raw_events(_events(spark, sf))
    topic, out, ckpt = (scratch_path(spark, x) for x in ("topic", "timed-out", "timed-ckpt"))
    body = EVENTS_STREAM_SPEC_JSON["spec"]
    timed = {"spec": {**body, "tuningConfig": {**body["tuningConfig"], "intermediatePersistPeriod": "PT1S"}}}
    publish_events(raw.where(F.col("event_id").cast("long") % 2 == 0), f"{topic}/a", key=None)
    q, spec = run_stream_spec(spark, timed, out, ckpt, source_override=f"{topic}/*", trigger="spec")
    try:
        q.processAllAvailable()
        publish_events(raw.where(F.col("event_id").cast("long") % 2 == 1), f"{topic}/b", key=None)
        q.processAllAvailable()
    finally:
        q.stop()
    return read_stream_rollup(spark, spec, out).drop("chunk")


def q_region_snapshot_job(spark, sf):
    """The reference's CSV job: region folders → dated snapshot + latest → rows per region."""
    raw_base = scratch_path(spark, "raw-events")
    write_region_csv(raw_events(_events(spark, sf)), raw_base)
    snap, latest = scratch_path(spark, "snapshots"), scratch_path(spark, "latest")
    res = snapshot_regions(spark, raw_base, snap, latest, columns=RAW_EVENT_COLUMNS,
                           partition_col="event_type", run_ts=dt.datetime(2024, 2, 1))
    latest_rows = read_snapshot(spark, res.latest, res.schema, "event_type")
    return res.counts.join(counts_by(latest_rows, "event_type", "n_latest"), "event_type",
                           "full_outer")


def q_pipeline_check(spark, sf):
    """Raw region folders against the refreshed ``latest`` output, per region."""
    raw_base = scratch_path(spark, "raw-events")
    write_region_csv(raw_events(_events(spark, sf)), raw_base)
    make_folder(spark, f"{raw_base}/event_type=refund")          # announced, no files yet
    snap, latest = scratch_path(spark, "snapshots"), scratch_path(spark, "latest")
    snapshot_regions(spark, raw_base, snap, latest, columns=RAW_EVENT_COLUMNS,
                     partition_col="event_type", run_ts=dt.datetime(2024, 2, 1))
    return compare_inventories(spark, raw_base, latest, "region")


def q_ctas_report(spark, sf):
    register(spark, "events_src", _events(spark, sf))
    sql = ("SELECT event_type, COUNT(*) AS n_events, COUNT(DISTINCT user_id) AS n_users, "
           "CAST(SUM(CAST(round(value * 100) AS BIGINT)) AS DOUBLE) / CAST(100 AS DOUBLE) "
           "AS value_total FROM events_src GROUP BY event_type")
    return ctas(spark, sql, "events_report", scratch_path(spark, "ctas"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "csv_hourly_rollup": q_csv_hourly_rollup,
    "partitioned_csv_ingest": q_partitioned_csv_ingest,
    "region_reload": q_region_reload,
    "skewed_region_rollup": q_skewed_region_rollup,
    "csv_infer_ingest": q_csv_infer_ingest,
    "preview_first_rows": q_preview_first_rows,
    "csv_positional_ingest": q_csv_positional_ingest,
    "parquet_daily_distinct": q_parquet_daily_distinct,
    "csv_lines_column": q_csv_lines_column,
    "json_props": q_json_props,
    "project_exclude": q_project_exclude,
    "coerce_types": q_coerce_types,
    "missing_time_default": q_missing_time_default,
    "quarantine_bad": q_quarantine_bad,
    "auto_time": q_auto_time,
    "interval_filter": q_interval_filter,
    "partition_filter": q_partition_filter,
    "select_star_hour": q_select_star_hour,
    "rollup_hour": q_rollup_hour,
    "rollup_day_month_chunks": q_rollup_day_month_chunks,
    "time_range_read": q_time_range_read,
    "detail_unit_count": q_detail_unit_count,
    "reaggregate_day": q_reaggregate_day,
    "distinct_regions": q_distinct_regions,
    "region_counts": q_region_counts,
    "approx_distinct_theta": q_approx_distinct_theta,
    "approx_distinct_hll": q_approx_distinct_hll,
    "exact_multi_distinct": q_exact_multi_distinct,
    "quantile_sketch": q_quantile_sketch,
    "value_histogram": q_value_histogram,
    "snapshot_latest": q_snapshot_latest,
    "append_table": q_append_table,
    "replace_partitions": q_replace_partitions,
    "max_rows_per_file": q_max_rows_per_file,
    "union_by_position": q_union_by_position,
    "union_by_name": q_union_by_name,
    "stream_rollup_day": q_stream_rollup_day,
    "stream_window_day": q_stream_window_day,
    "stream_compaction": q_stream_compaction,
    "json_publish": q_json_publish,
    "lookup_region": q_lookup_region,
    "inventory": q_inventory,
    "load_audit": q_load_audit,
    "spec_job_rollup": q_spec_job_rollup,
    "ctas_report": q_ctas_report,
    "region_snapshot_job": q_region_snapshot_job,
    "pipeline_check": q_pipeline_check,
    "spec_job_csv_detail": q_spec_job_csv_detail,
    "spec_job_stream": q_spec_job_stream,
    "stream_timed_persist": q_stream_timed_persist,
    "spec_job_parquet_region": q_spec_job_parquet_region,
    "spec_job_parquet": q_spec_job_parquet,
    "mean_unscaled": q_mean_unscaled,
    "rollup_bad_numbers": q_rollup_bad_numbers,
    "latest_region_removed": q_latest_region_removed,
    "spec_region_reload": q_spec_region_reload,
    "region_reload_fewer_chunks": q_region_reload_fewer_chunks,
    "malformed_csv_lines": q_malformed_csv_lines,
    "malformed_messages": q_malformed_messages,
    "stream_quarantine": q_stream_quarantine,
    "stream_restart": q_stream_restart,
    "stream_window_hour": q_stream_window_hour,
}


# ---------------------------------------------------------------- oracle SQL

def _units_sum(x: str, scale: int = 2) -> str:
    u = 10 ** scale
    return (f"CAST(SUM(CAST(round({x} * {u}) AS BIGINT)) AS DOUBLE) / CAST({u} AS DOUBLE)")


def _mean(x: str, scale: int = 2) -> str:
    return (f"CASE WHEN COUNT({x}) > 0 THEN ({_units_sum(x, scale)}) "
            f"/ CAST(COUNT({x}) AS DOUBLE) END")


def _bucket(g: str, x: str) -> str:
    return f"CAST(date_trunc('{g}', {x}) AS TIMESTAMP)"


def _chunk(g: str, x: str) -> str:
    return f"strftime(date_trunc('{g}', {x}), '%Y-%m-%d')"


_BAD_T = f"(event_id % {MISSING_TIME_MOD} = 0 OR event_id % {BAD_TIME_MOD} = 0)"

# the raw events after typing: bad cells null, times at second precision
_CLEAN = f"""(SELECT event_id,
    CASE WHEN {_BAD_T} THEN NULL ELSE {_bucket('second', 'ts')} END AS ts,
    CASE WHEN event_id % {BAD_USER_MOD} = 0 THEN NULL ELSE user_id END AS user_id,
    event_type,
    CASE WHEN event_id % {BAD_VALUE_MOD} = 0 THEN NULL ELSE value END AS value,
    props
  FROM events)"""

# the message stream after parsing: a missing time takes the default
_STREAM = f"""(SELECT event_type,
    CASE WHEN event_id % {MISSING_TIME_MOD} = 0 THEN TIMESTAMP '2019-06-30 12:00:00'
         WHEN event_id % {BAD_TIME_MOD} = 0 THEN NULL ELSE ts END AS t,
    CASE WHEN event_id % {BAD_VALUE_MOD} = 0 THEN NULL ELSE value END AS value,
    CASE WHEN event_id % {BAD_USER_MOD} = 0 THEN NULL ELSE user_id END AS user_id
  FROM events)"""

_STREAM_DAILY_SQL = f"""SELECT {_bucket('day', 't')} AS __time, event_type, COUNT(*) AS "count",
  {_mean('value')} AS value_avg, CAST(SUM(user_id) AS BIGINT) AS user_sum
FROM {_STREAM} s WHERE t IS NOT NULL GROUP BY 1, 2"""

_EV_IN_INTERVALS = " OR ".join(
    f"(ts >= TIMESTAMP '{lo.replace('T', ' ')}' AND ts < TIMESTAMP '{hi.replace('T', ' ')}')"
    for lo, hi in (iv.split("/") for iv in INTERVALS))

ORACLE_SQL: dict[str, str] = {
    "csv_hourly_rollup": f"""SELECT {_bucket('hour', 'ts')} AS __time, event_type,
  {_chunk('month', 'ts')} AS chunk, COUNT(*) AS "count", {_units_sum('value')} AS value_sum,
  {_mean('value')} AS value_avg, CAST(SUM(user_id) AS BIGINT) AS user_sum
FROM {_CLEAN} c WHERE ts IS NOT NULL GROUP BY 1, 2, 3""",
    "partitioned_csv_ingest": f"SELECT event_id, ts, user_id, event_type, value, props FROM {_CLEAN} c",
    "csv_infer_ingest": """SELECT event_id, strftime(ts, '%m/%d/%Y %I:%M:%S %p') AS ts, user_id,
  event_type, value, props, 'string' AS ts_inferred_type FROM events""",
    "preview_first_rows": "SELECT event_id, ts, event_type FROM events ORDER BY event_id LIMIT 5",
    "csv_positional_ingest": """SELECT o_orderkey AS order_id, o_custkey AS customer_id,
  o_orderstatus AS status, o_totalprice AS total_price, o_orderdate AS order_date,
  o_orderpriority AS priority FROM orders""",
    "parquet_daily_distinct": f"""SELECT DISTINCT {_bucket('day', 'ts')} AS __time, event_type,
  user_id FROM events""",
    "csv_lines_column": """SELECT o_orderkey AS order_id, o_custkey AS customer_id,
  o_orderstatus AS status, o_totalprice AS total_price, strftime(o_orderdate, '%Y-%m-%d') AS order_date,
  o_orderpriority AS priority FROM orders""",
    "json_props": """SELECT event_id,
  TRY_CAST(regexp_extract(props, '"k":\\s*(-?[0-9]+)', 1) AS BIGINT) AS k FROM events""",
    "project_exclude": "SELECT ts AS __time, event_id, event_type, user_id FROM events",
    "coerce_types": f"SELECT event_id, user_id, value, event_type FROM {_CLEAN} c",
    "missing_time_default": f"""SELECT event_id,
  CASE WHEN event_id % {MISSING_TIME_MOD} = 0 THEN TIMESTAMP '2019-06-30 12:00:00'
       WHEN event_id % {BAD_TIME_MOD} = 0 THEN NULL ELSE {_bucket('second', 'ts')} END AS __time
FROM events""",
    "quarantine_bad": f"""SELECT event_id, '{BAD_TIME_TEXT}' AS raw_time,
  'unparseable time' AS reason FROM events
WHERE event_id % {BAD_TIME_MOD} = 0 AND event_id % {MISSING_TIME_MOD} <> 0""",
    "auto_time": f"""SELECT event_id, CASE WHEN event_id % 2 = 0 THEN ts
  ELSE {_bucket('millisecond', 'ts')} END AS __time FROM events""",
    "interval_filter": f"""SELECT ts AS __time, event_id, event_type FROM events
WHERE {_EV_IN_INTERVALS}""",
    "partition_filter": """SELECT event_id, ts, user_id, value, event_type FROM events
WHERE event_type = 'click'""",
    "select_star_hour": f"SELECT *, {_bucket('hour', 'ts')} AS hour_time, strftime(ts, '%Y%m%d%H%M%S') AS run_id FROM events",
    "rollup_hour": f"""SELECT {_bucket('hour', 'ts')} AS __time, event_type, COUNT(*) AS "count",
  {_units_sum('value')} AS value_sum, {_mean('value')} AS value_avg, MIN(value) AS value_min,
  MAX(value) AS value_max, CAST(SUM(user_id) AS BIGINT) AS user_sum
FROM events GROUP BY 1, 2""",
    "rollup_day_month_chunks": f"""SELECT {_bucket('day', 'o_orderdate')} AS __time,
  o_orderstatus, o_orderpriority, {_chunk('month', 'o_orderdate')} AS chunk, COUNT(*) AS "count",
  {_units_sum('o_totalprice')} AS price_sum, {_mean('o_totalprice')} AS price_avg
FROM orders GROUP BY 1, 2, 3, 4""",
    "detail_unit_count": f"""SELECT {_bucket('hour', 'ts')} AS __time, event_id, event_type,
  CAST(1 AS BIGINT) AS "count" FROM events""",
    "reaggregate_day": f"""SELECT {_bucket('day', 'ts')} AS __time, event_type, COUNT(*) AS "count",
  {_units_sum('value')} AS value_sum, {_mean('value')} AS value_avg,
  true AS users_within FROM events GROUP BY 1, 2""",
    "distinct_regions": "SELECT DISTINCT event_type FROM events",
    "region_counts": "SELECT event_type, COUNT(*) AS n_rows FROM events GROUP BY 1",
    "approx_distinct_theta": f"""SELECT {_bucket('day', 'ts')} AS __time, event_type,
  true AS users_within FROM events GROUP BY 1, 2""",
    "exact_multi_distinct": """SELECT event_type, COUNT(DISTINCT user_id) AS users,
  COUNT(DISTINCT CAST(ts AS DATE)) AS days, COUNT(DISTINCT date_trunc('hour', ts)) AS hours
FROM events GROUP BY 1""",
    "snapshot_latest": """SELECT event_id, ts, user_id, event_type, value, props,
  TIMESTAMP '2024-02-01 00:00:00' AS processing_ts FROM events""",
    "append_table": """SELECT ts AS __time, event_id, event_type, CAST(1 AS BIGINT) AS "count"
FROM events UNION ALL
SELECT ts AS __time, event_id, event_type, CAST(1 AS BIGINT) AS "count" FROM events""",
    "replace_partitions": """SELECT event_id, event_type,
  CASE WHEN event_type = 'click' THEN value * 2 ELSE value END AS value FROM events""",
    "max_rows_per_file": """SELECT event_type, COUNT(*) AS n_rows, true AS within_cap
FROM events GROUP BY 1""",
    "union_by_position": """SELECT event_id, ts, event_type FROM events
UNION ALL SELECT o_orderkey, o_orderdate, o_orderpriority FROM orders""",
    "union_by_name": """SELECT event_id, event_type, value FROM events
UNION ALL SELECT o_orderkey AS event_id, CAST(NULL AS VARCHAR) AS event_type,
  o_totalprice AS value FROM orders""",
    "stream_rollup_day": _STREAM_DAILY_SQL,
    "stream_window_day": _STREAM_DAILY_SQL,
    "json_publish": "SELECT event_id, ts, user_id, event_type, value, props FROM events",
    "lookup_region": """SELECT c.c_custkey, c.c_nationkey, COALESCE(n.n_name, 'UNKNOWN') AS nation,
  COALESCE(r.r_name, 'UNKNOWN') AS region
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "inventory": f"""SELECT event_type AS region, CAST(SUM(
    length(CAST(event_id AS VARCHAR)) + 5
    + CASE WHEN event_id % {MISSING_TIME_MOD} = 0 THEN 0 WHEN event_id % {BAD_TIME_MOD} = 0 THEN {len(BAD_TIME_TEXT)} ELSE 22 END
    + length(CAST(user_id AS VARCHAR)) + CASE WHEN event_id % {BAD_USER_MOD} = 0 THEN 1 ELSE 0 END
    + CASE WHEN event_id % {BAD_VALUE_MOD} = 0 THEN {len(BAD_VALUE_TEXT)} ELSE length(CAST(value AS VARCHAR)) END
    + length(replace(props, '"', '""')) + 2) AS BIGINT) AS cell_bytes, true AS has_files
FROM events GROUP BY 1
UNION ALL SELECT 'refund', CAST(0 AS BIGINT), false""",
    "load_audit": f"""SELECT event_type, COUNT(*) AS rows_in,
  CAST(SUM(CASE WHEN {_BAD_T} THEN 0 ELSE 1 END) AS BIGINT) AS rows_loaded,
  CAST(SUM(CASE WHEN {_BAD_T} THEN 1 ELSE 0 END) AS BIGINT) AS rows_bad,
  'SUCCESS' AS status FROM events GROUP BY 1""",
    "spec_job_rollup": f"""SELECT {_bucket('month', 'o_orderdate')} AS __time, o_orderstatus,
  o_orderpriority, {_chunk('year', 'o_orderdate')} AS chunk, COUNT(*) AS "count",
  true AS orders_within, {_mean('o_totalprice')} AS price_avg
FROM orders
WHERE o_orderdate >= TIMESTAMP '1996-01-01 00:00:00' AND o_orderdate < TIMESTAMP '2000-01-01 00:00:00'
GROUP BY 1, 2, 3, 4""",
    "ctas_report": f"""SELECT event_type, COUNT(*) AS n_events, COUNT(DISTINCT user_id) AS n_users,
  {_units_sum('value')} AS value_total FROM events GROUP BY event_type""",
}

ORACLE_SQL["spec_job_csv_detail"] = f"""SELECT CAST(time_bucket(INTERVAL '30 minutes', ts) AS TIMESTAMP) AS __time,
  event_id AS id, user_id AS uid, value AS amount, props AS payload, event_type AS region,
  CAST(1 AS BIGINT) AS n, {_chunk('week', 'ts')} AS chunk
FROM {_CLEAN} c WHERE ts IS NOT NULL"""
ORACLE_SQL["spec_job_stream"] = _STREAM_DAILY_SQL
ORACLE_SQL["stream_timed_persist"] = _STREAM_DAILY_SQL
ORACLE_SQL["stream_compaction"] = _STREAM_DAILY_SQL
_RANGE_SQL = " OR ".join(
    f"(o_orderdate >= TIMESTAMP '{lo}' AND o_orderdate < TIMESTAMP '{hi}')"
    for lo, hi in (r.split("/") for r in RANGE))
ORACLE_SQL["time_range_read"] = f"""SELECT {_bucket('day', 'o_orderdate')} AS __time,
  o_orderstatus, o_orderpriority, {_chunk('month', 'o_orderdate')} AS chunk, COUNT(*) AS "count",
  {_units_sum('o_totalprice')} AS price_sum, {_mean('o_totalprice')} AS price_avg
FROM orders WHERE {_RANGE_SQL} GROUP BY 1, 2, 3, 4"""
_RELOADED = f"""(SELECT event_id, ts, user_id, event_type,
    CASE WHEN event_type = 'click' THEN value * 2 ELSE value END AS value FROM {_CLEAN} c)"""
ORACLE_SQL["region_reload"] = f"""SELECT {_bucket('hour', 'ts')} AS __time, event_type,
  {_chunk('month', 'ts')} AS chunk, COUNT(*) AS "count", {_units_sum('value')} AS value_sum,
  {_mean('value')} AS value_avg, CAST(SUM(user_id) AS BIGINT) AS user_sum
FROM {_RELOADED} r WHERE ts IS NOT NULL GROUP BY 1, 2, 3"""
_SKEWED = f"""(SELECT event_id, ts, user_id, value,
    CASE WHEN event_id % {HOT_MOD} = 0 THEN '{HOT_REGION}' ELSE event_type END AS event_type
  FROM {_CLEAN} c)"""
ORACLE_SQL["skewed_region_rollup"] = f"""WITH k AS (SELECT event_type, COUNT(*) AS rows_in,
    CAST(SUM(CASE WHEN ts IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS rows_bad FROM {_SKEWED} a GROUP BY 1),
  r AS (SELECT {_bucket('hour', 'ts')} AS __time, event_type, {_chunk('month', 'ts')} AS chunk,
    COUNT(*) AS "count", {_units_sum('value')} AS value_sum, {_mean('value')} AS value_avg,
    CAST(SUM(user_id) AS BIGINT) AS user_sum FROM {_SKEWED} b WHERE ts IS NOT NULL GROUP BY 1, 2, 3)
SELECT r.*, k.rows_in, k.rows_bad FROM r JOIN k USING (event_type)"""
ORACLE_SQL["pipeline_check"] = """SELECT event_type AS region, true AS raw_has_files,
  true AS out_has_files, 'OK' AS status FROM events GROUP BY 1
UNION ALL SELECT 'refund', false, false, 'EMPTY'"""
ORACLE_SQL["region_snapshot_job"] = """SELECT event_type, COUNT(*) AS n_rows, COUNT(*) AS n_latest
FROM events GROUP BY 1"""

ORACLE_SQL["approx_distinct_hll"] = ORACLE_SQL["approx_distinct_theta"]
ORACLE_SQL["quantile_sketch"] = """SELECT event_type, COUNT(*) AS n, MIN(value) AS value_min, MAX(value) AS value_max,
  true AS q50_within, true AS q90_within, true AS q99_within FROM events GROUP BY 1"""
ORACLE_SQL["value_histogram"] = f"""SELECT event_type, CAST(least({HISTOGRAM_BINS}, COUNT(DISTINCT value)) AS BIGINT) AS n_bins,
  COUNT(*) AS n_rows FROM events GROUP BY 1"""
ORACLE_SQL["stream_restart"] = _STREAM_DAILY_SQL
ORACLE_SQL["stream_window_hour"] = f"""SELECT {_bucket('hour', 't')} AS __time, {_chunk('week', 't')} AS chunk, event_type,
  COUNT(*) AS "count", {_mean('value')} AS value_avg, CAST(SUM(user_id) AS BIGINT) AS user_sum
FROM {_STREAM} s WHERE t IS NOT NULL GROUP BY 1, 2, 3"""
ORACLE_SQL["stream_quarantine"] = ORACLE_SQL["quarantine_bad"]
_BROKEN = f"event_id % {GARBLED_MOD} = 0"
ORACLE_SQL["malformed_messages"] = f"""SELECT CASE WHEN {_BROKEN} THEN NULL ELSE event_type END AS event_type,
  CASE WHEN {_BROKEN} THEN 'malformed record'
       WHEN event_id % {MISSING_TIME_MOD} <> 0 AND event_id % {BAD_TIME_MOD} = 0 THEN 'unparseable time' ELSE 'loaded' END AS reason,
  COUNT(*) AS n_rows FROM events GROUP BY 1, 2"""
_CUT_PAYLOAD = f"CASE WHEN {_BROKEN} THEN 0 ELSE length(props) + CASE WHEN event_id % 4 = 0 THEN length('say \"hi\", then ') ELSE 0 END END"
ORACLE_SQL["malformed_csv_lines"] = f"""SELECT event_type AS region,
  CASE WHEN {_BROKEN} THEN 'malformed record' WHEN event_id % {MISSING_TIME_MOD} = 0 THEN 'missing time'
       WHEN event_id % {BAD_TIME_MOD} = 0 THEN 'unparseable time' ELSE 'loaded' END AS reason,
  COUNT(*) AS n_rows, CAST(nullif(SUM({_CUT_PAYLOAD}), 0) AS BIGINT) AS payload_chars FROM events GROUP BY 1, 2"""
ORACLE_SQL["region_reload_fewer_chunks"] = f"""SELECT event_type, {_chunk('day', 'ts')} AS chunk, COUNT(*) AS n_rows
FROM {_CLEAN} c WHERE ts IS NOT NULL AND (event_type <> 'click' OR dayofyear(ts) % 2 = 0) GROUP BY 1, 2"""
ORACLE_SQL["spec_region_reload"] = f"""SELECT event_type AS region, COUNT(*) AS n_rows, CAST(SUM(event_id) AS BIGINT) AS id_sum
FROM {_CLEAN} c WHERE ts IS NOT NULL AND (event_type <> 'view' OR event_id % 2 = 0) GROUP BY 1"""
ORACLE_SQL["latest_region_removed"] = """SELECT event_type, COUNT(*) AS n_rows FROM events
WHERE event_type <> 'view' GROUP BY 1"""
_ODD_VALUE = f"CASE WHEN event_id % {BAD_VALUE_MOD} = 0 OR event_id % {BAD_USER_MOD} = 0 THEN NULL ELSE value END"
ORACLE_SQL["rollup_bad_numbers"] = f"""SELECT {_bucket('hour', 'ts')} AS __time, event_type, COUNT(*) AS "count",
  {_units_sum('v')} AS value_sum, {_mean('v')} AS value_avg,
  CAST(SUM(CASE WHEN event_id % {MISSING_TIME_MOD} = 0 THEN NULL ELSE user_id END) AS BIGINT) AS user_sum
FROM (SELECT *, {_ODD_VALUE} AS v FROM events) e GROUP BY 1, 2"""
ORACLE_SQL["mean_unscaled"] = f"""SELECT {_bucket('month', 'ts')} AS __time, event_type, round(AVG(value), 4) AS value_avg,
  round(SUM(value), 4) AS value_sum FROM events GROUP BY 1, 2"""
ORACLE_SQL["spec_job_parquet"] = ORACLE_SQL["parquet_daily_distinct"]
ORACLE_SQL["spec_job_parquet_region"] = ORACLE_SQL["parquet_daily_distinct"] + " WHERE event_type IN ('click', 'purchase')"
