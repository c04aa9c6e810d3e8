"""More registered queries: CSV as exported, repairs after a load, late rows, mergeable states.

Like ``suite``: every query runs over the whole input tables, ``ORACLE_SQL``
states the same result in SQL.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.time import REFERENCE_TIME_FORMAT, floor_time, format_reference_time, parse_time
from ..operators.clean import RAW_TIME, coerce_columns
from ..operators.distinct import bitmap_states, count_bitmaps, theta_counts, theta_sets
from ..operators.rollup import finish, histogram_bins, reaggregate
from ..session import scratch_path
from ..sinks.files import replace_partitions, write_table
from ..sinks.journal import announce, partition_folders, staging_path
from ..sources.census import read_csv_census
from ..sources.files import read_partitioned_csv
from ..spec import Dim, Lookup, Metric, TableSpec
from ..streaming.stream import read_json_stream, read_stream_rollup, read_stream_window, stream_rollup, stream_window
from .audit import content_audit
from .edge import RAW_EVENT_COLUMNS, publish_events, raw_events, table, write_region_csv
from .ingest import partition_cols, prepare, read_ingested, read_range, run_ingest
from .replay import replay
from .suite import (_BAD_T, _CLEAN, _STREAM, _STREAM_DAILY_SQL, COUNT, EVENTS_HOURLY, MESSAGE_DDL, ORACLE_SQL as _SQL,
                    STREAM_BATCH_BYTES, STREAM_DAILY, _bucket, _events)

# A detail table of the raw events: all cells kept, month chunks by region.
EVENTS_DETAIL = TableSpec(
    name="events_detail", time_column="ts", time_format=REFERENCE_TIME_FORMAT,
    dimensions=(Dim("event_id", "long"), Dim("user_id", "long"), Dim("value", "double"), Dim("props")),
    metrics=(COUNT,), query_granularity="second", segment_granularity="month", rollup=False, partition_col="event_type")

HISTOGRAM = Metric("value_bins", "fixedBucketsHistogram", "value", bins=20, lower=10.0, upper=90.0)
RANGE_DAYS = ("2024-01-05T06:00:00/2024-01-08", "2024-02-29/2024-03-02")


def _region_csv(spark: SparkSession, raw: DataFrame) -> DataFrame:
    base = scratch_path(spark, "raw-events")
    write_region_csv(raw, base)
    return read_partitioned_csv(spark, base, columns=RAW_EVENT_COLUMNS, partition_col="event_type")


def q_csv_quoted_cells(spark, sf):
    """Cells with quotes, commas, backslashes, white space at the ends and line breaks, written and read."""
    k = F.col("event_id") % 6
    cell = (F.when(k == 0, F.lit('say ""hi"", then "go"')).when(k == 1, F.concat("props", F.lit('\nsecond "line", end')))
            .when(k == 2, F.lit('"')).when(k == 3, F.lit("  lead, \\ and trail\\ ")).when(k == 4, F.lit('a\\"b,"c"')).otherwise(F.col("props")))
    base = scratch_path(spark, "csv-quoted")
    raw = _events(spark, sf).withColumn("ts", format_reference_time("ts")).withColumn("props", cell)
    write_region_csv(raw.select(*RAW_EVENT_COLUMNS, "event_type"), base)
    back = read_partitioned_csv(spark, base, columns=RAW_EVENT_COLUMNS, partition_col="event_type", options={"multiLine": "true"})
    typed = coerce_columns(back, {"event_id": "long", "user_id": "long", "value": "double"})
    return typed.withColumn("ts", parse_time("ts", REFERENCE_TIME_FORMAT))


def q_csv_header_census(spark, sf):
    """Files of three headers in each region folder: as declared, in another order with a column more, one column less."""
    raw = raw_events(_events(spark, sf)).withColumn("device", F.concat(F.lit("d"), F.col("event_id").cast("long") % 7))
    base = scratch_path(spark, "csv-headers")
    for k, columns in enumerate((RAW_EVENT_COLUMNS, ["device", "props", "value", "ts", "event_id", "user_id"], RAW_EVENT_COLUMNS[:-1])):
        part = raw.where(F.col("event_id").cast("long") % 3 == k).select(*columns, "event_type")
        write_table(part, base, ["event_type"], mode="append", fmt="csv")
    back = read_csv_census(spark, base, partition_col="event_type")
    typed = coerce_columns(back, {"event_id": "long", "user_id": "long", "value": "double"})
    return typed.withColumn("ts", parse_time("ts", REFERENCE_TIME_FORMAT))


def q_replay_quarantine(spark, sf):
    """Rows set aside, corrected and replayed: some, then all, then all again. The table is that of a clean load."""
    ev = _events(spark, sf)
    out, bad = scratch_path(spark, "events-hourly"), scratch_path(spark, "events-bad")
    run_ingest(spark, EVENTS_HOURLY, _region_csv(spark, raw_events(ev)), out, quarantine_path=bad)
    times = ev.select(F.col("event_id").cast("string").alias("event_id"), format_reference_time("ts").alias("right"))
    corrected = spark.read.parquet(bad).join(times, "event_id").withColumn("ts", F.col("right")).drop("right", RAW_TIME)
    for part in (corrected.where(F.col("event_id").cast("long") % 2 == 0), corrected, corrected):
        replay(spark, EVENTS_HOURLY, part, out, bad)
    return finish(read_ingested(spark, EVENTS_HOURLY, out), EVENTS_HOURLY)


def q_load_fingerprint(spark, sf):
    """Content audit of a load in which two cells of one row of one region were swapped afterwards."""
    source = _region_csv(spark, raw_events(_events(spark, sf)))
    out, bad = scratch_path(spark, "events-detail"), scratch_path(spark, "events-bad")
    run_ingest(spark, EVENTS_DETAIL, source, out, quarantine_path=bad)
    rows = read_ingested(spark, EVENTS_DETAIL, out).where("event_type = 'click'")
    one = rows.where("event_id <> user_id").agg(F.min("event_id")).first()[0]
    swap = F.col("event_id") == one
    # the table is read and changed: cut the lineage first
    swapped = rows.select("*", swap.alias("s")).select(
        *[F.when(F.col("s"), F.col({"event_id": "user_id", "user_id": "event_id"}.get(c, c))).otherwise(F.col(c)).alias(c)
          if c in ("event_id", "user_id") else F.col(c) for c in rows.columns]).checkpoint()
    replace_partitions(swapped, out, partition_cols(EVENTS_DETAIL))
    return content_audit(spark, EVENTS_DETAIL, source, out, bad)


def q_reload_after_crash(spark, sf):
    """A region's reload that died once its journal was written: the next load of the table finishes it."""
    ev = _events(spark, sf)
    out, parts = scratch_path(spark, "events-hourly"), partition_cols(EVENTS_HOURLY)
    spec = EVENTS_HOURLY.with_(segment_granularity="day")
    run_ingest(spark, spec, _region_csv(spark, raw_events(ev)), out)
    fewer = _region_csv(spark, raw_events(ev.where("event_type = 'click' AND dayofyear(ts) % 2 = 0")))
    staged = staging_path(out)
    write_table(prepare(fewer, spec)[0], staged, parts, dynamic=False)
    new = list(partition_folders(spark, staged, parts))
    old = [f for f, v in partition_folders(spark, out, parts).items() if v["event_type"] == "click"]
    announce(spark, out, staged, replace=new, remove=sorted(set(old) - set(new)))       # and nothing more: a crash
    run_ingest(spark, spec, _region_csv(spark, raw_events(ev.where("event_type = 'view'"))), out, drop_existing=True, regions=["view"])
    return finish(read_ingested(spark, spec, out), spec).groupBy("event_type", "chunk").agg(F.sum("count").alias("n_rows"))


def q_append_new_column(spark, sf):
    """A later load with a column more: all rows are read by the new spec, the column null in the earlier ones."""
    ev = _events(spark, sf)
    wide = TableSpec(name="t", time_column="ts", dimensions=(Dim("event_id", "long"), Dim("props")), metrics=(COUNT,),
                     segment_granularity="day", rollup=False, partition_col="event_type")
    narrow = wide.with_(dimensions=(Dim("event_id", "long"),))
    out = scratch_path(spark, "events-wider")
    run_ingest(spark, narrow, ev.where("event_id % 2 = 0"), out, mode="append")
    run_ingest(spark, wide, ev.where("event_id % 2 = 1"), out, mode="append")
    return read_ingested(spark, wide, out).drop("chunk")


def q_range_listing(spark, sf):
    """Rows of two ranges of a table in day chunks; only the folders of those days are listed."""
    spec = TableSpec(name="t", time_column="ts", dimensions=(Dim("event_id", "long"),), metrics=(COUNT,),
                     segment_granularity="day", rollup=False, partition_col="event_type")
    out = scratch_path(spark, "events-days")
    run_ingest(spark, spec, _events(spark, sf), out)
    rows = read_range(spark, spec, out, RANGE_DAYS)
    listed = {f.split("chunk=")[1].split("/")[0] for f in rows.inputFiles()}
    days = {"2024-01-05", "2024-01-06", "2024-01-07", "2024-01-08", "2024-02-29", "2024-03-01", "2024-03-02"}
    return rows.select("__time", "event_id", "event_type", F.lit(listed <= days).alias("only_its_days"))


def q_stream_window_late(spark, sf):
    """Half of the messages, then, when the first half's state is gone, the rest for the same windows."""
    raw = raw_events(_events(spark, sf))
    topic, out, ckpt = (scratch_path(spark, x) for x in ("topic", "window-out", "window-ckpt"))
    for k in (0, 1):
        publish_events(raw.where(F.col("event_id").cast("long") % 2 == k), f"{topic}/part={k}")
        src = read_json_stream(spark, f"{topic}/*/*", MESSAGE_DDL, max_bytes_per_trigger=STREAM_BATCH_BYTES)
        stream_window(src, STREAM_DAILY, out, ckpt, arrival="1 second").awaitTermination()
        time.sleep(1.1 * (1 - k))        # the first stretch of arrival is over
    return read_stream_window(spark, STREAM_DAILY, out).drop("chunk")


def q_stream_lookup(spark, sf):
    """A dimension looked up in a mapping that changes between two batches: each batch takes it as it was."""
    raw = raw_events(_events(spark, sf))
    topic, out, ckpt, names = (scratch_path(spark, x) for x in ("topic", "stream-out", "stream-ckpt", "names"))
    spec = STREAM_DAILY.with_(dimensions=(Dim("label"),), lookups=(Lookup("label", "event_type", names, "kind", "label", "other"),))
    kinds = _events(spark, sf).where("event_type <> 'view'").select(F.col("event_type").alias("kind")).distinct()
    for k, label in enumerate((F.upper("kind"), F.concat(F.lit("new "), "kind"))):
        kinds.withColumn("label", label).write.mode("overwrite").parquet(names)
        publish_events(raw.where(F.col("event_id").cast("long") % 2 == k), f"{topic}/part={k}")
        src = read_json_stream(spark, f"{topic}/*/*", MESSAGE_DDL, max_bytes_per_trigger=STREAM_BATCH_BYTES)
        stream_rollup(src, spec, out, ckpt).awaitTermination()
    return read_stream_rollup(spark, spec, out).drop("chunk")


def q_reaggregate_exact_distinct(spark, sf):
    """Users per hour and kind stored as bitmaps, merged to days and to months of all kinds."""
    keys = ["__time", "event_type"]
    ev = _events(spark, sf)
    hourly = bitmap_states(ev.withColumn("__time", floor_time("ts", "hour")), keys, "user_id")
    path = write_table(hourly, scratch_path(spark, "user-bitmaps"))
    stored = spark.read.parquet(path)
    days = count_bitmaps(stored.withColumn("__time", floor_time("__time", "day")), keys, "users")
    months = count_bitmaps(stored.withColumn("__time", floor_time("__time", "month")).withColumn("event_type", F.lit("all")), keys, "users")
    return days.withColumn("span", F.lit("day")).unionByName(months.withColumn("span", F.lit("month")))


def q_theta_overlap(spark, sf):
    """Users of clicks and purchases, and of clicks only, per month, from sketches stored per day and kind."""
    ev = _events(spark, sf)
    spec = TableSpec(name="t", time_column="ts", dimensions=(Dim("event_type"),), metrics=(Metric("users", "thetaSketch", "user_id"),),
                     query_granularity="day", segment_granularity="month", rollup=True)
    out = scratch_path(spark, "user-sketches")
    run_ingest(spark, spec, ev, out)
    states = read_ingested(spark, spec, out).withColumn("__time", floor_time("__time", "month"))
    kind = F.col("event_type")
    names = ["both", "common", "only_a"]
    est = theta_counts(theta_sets(states, ["__time"], "users", kind == "click", kind == "purchase"), names).drop("a", "b")
    users = ev.groupBy(floor_time("ts", "month").alias("__time"), "user_id").agg(
        F.bool_or(kind == "click").alias("c"), F.bool_or(kind == "purchase").alias("p"))
    exact = users.groupBy("__time").agg(F.count_if(F.col("c") | F.col("p")).alias("both_x"), F.count_if(F.col("c") & F.col("p")).alias("common_x"),
                                        F.count_if(F.col("c") & ~F.col("p")).alias("only_a_x"))
    # errors of set expressions are in proportion to the union
    bound = F.greatest(F.lit(1.0), 0.05 * F.col("both_x"))
    return est.join(exact, "__time").select("__time", F.col("both_x").alias("n_both"), F.col("common_x").alias("n_common"),
                                            *[(F.abs(F.col(c) - F.col(f"{c}_x")) <= bound).alias(f"{c}_within") for c in names])


def q_fixed_histogram_day(spark, sf):
    """A histogram stored with an hourly rollup, merged to days: the bins that hold a value."""
    spec = EVENTS_HOURLY.with_(metrics=(COUNT, HISTOGRAM))
    out = scratch_path(spark, "events-bins")
    run_ingest(spark, spec, _region_csv(spark, raw_events(_events(spark, sf))), out)
    days = finish(reaggregate(read_ingested(spark, spec, out), spec, dims=["event_type"], granularity="day"), spec)
    return histogram_bins(days, HISTOGRAM, ["__time", "event_type"]).where("n > 0").select("__time", "event_type", "bin", "n")


def q_one_file_per_region(spark, sf):
    """Suppliers by nation, a small region each, one file a region."""
    out = write_table(table(spark, sf, "supplier"), scratch_path(spark, "suppliers"), ["s_nationkey"], files_per_partition=1)
    rows = spark.read.parquet(out).groupBy("s_nationkey", F.col("_metadata.file_path").alias("f")).count()
    return rows.groupBy("s_nationkey").agg(F.count(F.lit(1)).alias("n_files"), F.sum("count").alias("n_rows"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "csv_quoted_cells": q_csv_quoted_cells,
    "csv_header_census": q_csv_header_census,
    "replay_quarantine": q_replay_quarantine,
    "load_fingerprint": q_load_fingerprint,
    "reload_after_crash": q_reload_after_crash,
    "append_new_column": q_append_new_column,
    "range_listing": q_range_listing,
    "stream_window_late": q_stream_window_late,
    "stream_lookup": q_stream_lookup,
    "reaggregate_exact_distinct": q_reaggregate_exact_distinct,
    "theta_overlap": q_theta_overlap,
    "fixed_histogram_day": q_fixed_histogram_day,
    "one_file_per_region": q_one_file_per_region,
}

_SECOND = _bucket("second", "ts")
_IN_DAYS = " OR ".join(f"(ts >= TIMESTAMP '{lo.replace('T', ' ')}' AND ts < TIMESTAMP '{hi}')" for lo, hi in (r.split("/") for r in RANGE_DAYS))
_LABEL = """CASE WHEN event_type = 'view' THEN 'other' WHEN event_id % 2 = 0 THEN upper(event_type) ELSE 'new ' || event_type END"""
_BIN = f"""CASE WHEN value IS NULL THEN {HISTOGRAM.bins + 2} WHEN value < {HISTOGRAM.lower} THEN 0 WHEN value >= {HISTOGRAM.upper} THEN {HISTOGRAM.bins + 1}
    ELSE CAST(floor((value - {HISTOGRAM.lower}) * {HISTOGRAM.bins} / {HISTOGRAM.upper - HISTOGRAM.lower}) AS INTEGER) + 1 END"""

ORACLE_SQL: dict[str, str] = {
    "csv_quoted_cells": f"""SELECT event_id, {_SECOND} AS ts, user_id, event_type, value,
  CASE event_id % 6 WHEN 0 THEN 'say ""hi"", then "go"' WHEN 1 THEN props || chr(10) || 'second "line", end' WHEN 2 THEN '"'
    WHEN 3 THEN '  lead, \\ and trail\\ ' WHEN 4 THEN 'a\\"b,"c"' ELSE props END AS props FROM events""",
    "csv_header_census": f"""SELECT event_id, ts, user_id, event_type, value, CASE WHEN event_id % 3 <> 2 THEN props END AS props,
  CASE WHEN event_id % 3 = 1 THEN 'd' || (event_id % 7) END AS device FROM {_CLEAN} c""",
    "replay_quarantine": _SQL["csv_hourly_rollup"].replace(_CLEAN, f"(SELECT * REPLACE ({_SECOND} AS ts) FROM "
                         + _CLEAN.replace(f"CASE WHEN {_BAD_T} THEN NULL ELSE {_SECOND} END AS ts", "ts") + " r)"),
    "load_fingerprint": f"""SELECT event_type, COUNT(*) FILTER (NOT {_BAD_T}) AS rows_expected, COUNT(*) FILTER (NOT {_BAD_T}) AS rows_found,
  COUNT(*) FILTER ({_BAD_T}) AS bad_expected, COUNT(*) FILTER ({_BAD_T}) AS bad_found, true AS rows_match,
  event_type <> 'click' AS content_match, CASE WHEN event_type = 'click' THEN 'FAILED' ELSE 'SUCCESS' END AS status
FROM events GROUP BY event_type""",
    "reload_after_crash": _SQL["region_reload_fewer_chunks"],
    "append_new_column": """SELECT ts AS __time, event_id, CASE WHEN event_id % 2 = 1 THEN props END AS props, CAST(1 AS BIGINT) AS "count",
  event_type FROM events""",
    "range_listing": f"SELECT ts AS __time, event_id, event_type, true AS only_its_days FROM events WHERE {_IN_DAYS}",
    "stream_window_late": _STREAM_DAILY_SQL,
    "stream_lookup": _STREAM_DAILY_SQL.replace("event_type", "label").replace(
        _STREAM.replace("event_type", "label"), _STREAM.replace("SELECT event_type", f"SELECT {_LABEL} AS label")),
    "reaggregate_exact_distinct": f"""SELECT {_bucket('day', 'ts')} AS __time, event_type, COUNT(DISTINCT user_id) AS users, 'day' AS span
FROM events GROUP BY 1, 2
UNION ALL SELECT {_bucket('month', 'ts')}, 'all', COUNT(DISTINCT user_id), 'month' FROM events GROUP BY 1""",
    "theta_overlap": f"""SELECT __time, COUNT(*) FILTER (c OR p) AS n_both, COUNT(*) FILTER (c AND p) AS n_common,
  true AS both_within, true AS common_within, true AS only_a_within
FROM (SELECT {_bucket('month', 'ts')} AS __time, user_id, bool_or(event_type = 'click') AS c, bool_or(event_type = 'purchase') AS p
  FROM events GROUP BY 1, 2) u GROUP BY 1""",
    "one_file_per_region": "SELECT s_nationkey, CAST(1 AS BIGINT) AS n_files, COUNT(*) AS n_rows FROM supplier GROUP BY 1",
    "fixed_histogram_day": f"""SELECT {_bucket('day', 'ts')} AS __time, event_type, {_BIN} AS bin, COUNT(*) AS n
FROM {_CLEAN} c WHERE ts IS NOT NULL GROUP BY 1, 2, 3""",
}
