from pyspark.sql import functions as F

from chronoroll.plans.edge import publish_events, raw_events, table
from chronoroll.plans.ingest import clean
from chronoroll.plans.suite import MESSAGE_DDL, STREAM_DAILY
from chronoroll.operators import finish, rollup
from chronoroll.sinks import publish_json
from chronoroll.streaming import (read_json_stream, read_stream_rollup, read_stream_window,
                                  stream_rollup, stream_window)

COLS = ["__time", "event_type", "count", "value_avg", "user_sum"]


def _batch_answer(spark, sf):
    good, _ = clean(raw_events(table(spark, sf, "events")), STREAM_DAILY)
    return sorted(tuple(r) for r in finish(rollup(good, STREAM_DAILY), STREAM_DAILY).select(COLS).collect())


def test_stream_equals_batch_and_restart_adds_nothing(spark, sf_small, tmp_dir):
    topic = f"{tmp_dir}/topic"
    publish_events(raw_events(table(spark, sf_small, "events")).repartition(3, "event_id"), topic)
    src = read_json_stream(spark, topic, MESSAGE_DDL, max_files_per_trigger=1)
    stream_rollup(src, STREAM_DAILY, f"{tmp_dir}/out", f"{tmp_dir}/ck").awaitTermination()
    got = sorted(tuple(r) for r in read_stream_rollup(spark, STREAM_DAILY, f"{tmp_dir}/out")
                 .select(COLS).collect())
    assert got == _batch_answer(spark, sf_small)
    batches = spark.read.parquet(f"{tmp_dir}/out").select("batch_id").distinct().count()
    assert batches >= 3
    # restart from the checkpoint: nothing new, nothing counted twice
    src = read_json_stream(spark, topic, MESSAGE_DDL, max_files_per_trigger=1)
    stream_rollup(src, STREAM_DAILY, f"{tmp_dir}/out", f"{tmp_dir}/ck").awaitTermination()
    again = sorted(tuple(r) for r in read_stream_rollup(spark, STREAM_DAILY, f"{tmp_dir}/out")
                   .select(COLS).collect())
    assert again == got


def test_late_record_for_written_day_is_accepted(spark, tmp_dir):
    topic = f"{tmp_dir}/late"
    early = spark.createDataFrame(
        [("1", "01/05/2024 10:00:00 AM", "7", "click", "1.50", "{}")], MESSAGE_DDL)
    publish_json(early, f"{topic}/a")
    src = read_json_stream(spark, f"{topic}/*", MESSAGE_DDL)
    stream_rollup(src, STREAM_DAILY, f"{tmp_dir}/o", f"{tmp_dir}/c").awaitTermination()
    late = spark.createDataFrame(
        [("2", "01/05/2024 11:00:00 PM", "8", "click", "2.50", "{}")], MESSAGE_DDL)
    publish_json(late, f"{topic}/b")
    src = read_json_stream(spark, f"{topic}/*", MESSAGE_DDL)
    stream_rollup(src, STREAM_DAILY, f"{tmp_dir}/o", f"{tmp_dir}/c").awaitTermination()
    r = read_stream_rollup(spark, STREAM_DAILY, f"{tmp_dir}/o").collect()
    assert len(r) == 1 and r[0]["count"] == 2 and r[0]["value_avg"] == 2.0 and r[0]["user_sum"] == 15


def test_window_stream_equals_batch(spark, sf_small, tmp_dir):
    topic = f"{tmp_dir}/topic"
    publish_events(raw_events(table(spark, sf_small, "events")).repartition(2, "event_id"), topic)
    src = read_json_stream(spark, topic, MESSAGE_DDL, max_files_per_trigger=1)
    stream_window(src, STREAM_DAILY, f"{tmp_dir}/w", f"{tmp_dir}/wc").awaitTermination()
    got = sorted(tuple(r) for r in read_stream_window(spark, STREAM_DAILY, f"{tmp_dir}/w")
                 .select(COLS).collect())
    assert got == _batch_answer(spark, sf_small)


def test_window_reader_keeps_the_newest_of_several_versions(spark, sf_small, tmp_dir):
    # two files that each hold every (day, type) group: every group is
    # updated, and written, in both micro-batches
    publish_json(raw_events(table(spark, sf_small, "events")).repartition(2, "event_id"),
                 f"{tmp_dir}/topic")
    src = read_json_stream(spark, f"{tmp_dir}/topic", MESSAGE_DDL, max_files_per_trigger=1)
    stream_window(src, STREAM_DAILY, f"{tmp_dir}/w", f"{tmp_dir}/wc").awaitTermination()
    got = sorted(tuple(r) for r in read_stream_window(spark, STREAM_DAILY, f"{tmp_dir}/w")
                 .select(COLS).collect())
    assert got == _batch_answer(spark, sf_small)
    assert spark.read.parquet(f"{tmp_dir}/w").count() > len(got)


def test_watermark_drops_rows_behind_it(spark, tmp_dir):
    topic = f"{tmp_dir}/wm"
    first = spark.createDataFrame(
        [("1", "01/05/2024 10:00:00 AM", "1", "click", "1.00", "{}"),
         ("2", "01/09/2024 10:00:00 AM", "1", "click", "1.00", "{}")], MESSAGE_DDL)
    publish_json(first, f"{topic}/a")
    src = read_json_stream(spark, f"{topic}/*", MESSAGE_DDL)
    stream_window(src, STREAM_DAILY, f"{tmp_dir}/w", f"{tmp_dir}/c",
                  watermark="1 day").awaitTermination()
    late = spark.createDataFrame(
        [("3", "01/05/2024 11:00:00 AM", "1", "click", "1.00", "{}")], MESSAGE_DDL)
    publish_json(late, f"{topic}/b")
    src = read_json_stream(spark, f"{topic}/*", MESSAGE_DDL)
    stream_window(src, STREAM_DAILY, f"{tmp_dir}/w", f"{tmp_dir}/c",
                  watermark="1 day").awaitTermination()
    got = {str(r["__time"])[:10]: r["count"] for r in
           read_stream_window(spark, STREAM_DAILY, f"{tmp_dir}/w").collect()}
    assert got == {"2024-01-05": 1, "2024-01-09": 1}


def test_compaction_keeps_answer_while_stream_continues(spark, sf_small, tmp_dir):
    from chronoroll.streaming import compact_stream_rollup, purge_compacted
    import glob
    ev = raw_events(table(spark, sf_small, "events"))
    topic, out, ck, base = (f"{tmp_dir}/{x}" for x in ("topic", "out", "ck", "base"))
    first = ev.filter(F.col("event_id").cast("long") < 500)
    publish_json(first.repartition(2, "event_id"), f"{topic}/a")
    src = read_json_stream(spark, f"{topic}/*", MESSAGE_DDL, max_files_per_trigger=1)
    stream_rollup(src, STREAM_DAILY, out, ck).awaitTermination()
    assert compact_stream_rollup(spark, STREAM_DAILY, out, base) == 1
    # more messages arrive after the compaction
    publish_json(ev.filter(F.col("event_id").cast("long") >= 500).repartition(2, "event_id"),
                 f"{topic}/b")
    src = read_json_stream(spark, f"{topic}/*", MESSAGE_DDL, max_files_per_trigger=1)
    stream_rollup(src, STREAM_DAILY, out, ck).awaitTermination()
    read = lambda: sorted(tuple(r) for r in read_stream_rollup(
        spark, STREAM_DAILY, out, compacted_path=base).select(COLS).collect())
    want = _batch_answer(spark, sf_small)
    assert read() == want
    assert purge_compacted(spark, out, base) > 0
    assert read() == want
    assert compact_stream_rollup(spark, STREAM_DAILY, out, base) == 3
    assert purge_compacted(spark, out, base) > 0
    assert not glob.glob(f"{out}/chunk=*/batch_id=*/*.parquet")
    assert read() == want


def test_stream_quarantine_holds_bad_messages(spark, sf_small, tmp_dir):
    from chronoroll.streaming import bad_messages
    raw = raw_events(table(spark, sf_small, "events"))
    publish_json(raw.repartition(2, "event_id"), f"{tmp_dir}/t")
    src = read_json_stream(spark, f"{tmp_dir}/t", MESSAGE_DDL, max_files_per_trigger=1)
    stream_rollup(src, STREAM_DAILY, f"{tmp_dir}/o", f"{tmp_dir}/c",
                  quarantine_path=f"{tmp_dir}/q").awaitTermination()
    _, bad = clean(raw, STREAM_DAILY)
    got = sorted(r["_raw_time"] for r in bad_messages(spark, f"{tmp_dir}/q").collect())
    assert got == sorted(r["_raw_time"] for r in bad.collect()) and got
    total = read_stream_rollup(spark, STREAM_DAILY, f"{tmp_dir}/o").agg(F.sum("count")).collect()[0][0]
    assert total + len(got) == raw.count()


def test_repeated_compaction_without_purge_does_not_double_count(spark, sf_small, tmp_dir):
    from chronoroll.streaming import compact_stream_rollup
    ev = raw_events(table(spark, sf_small, "events"))
    topic, out, ck, base = (f"{tmp_dir}/{x}" for x in ("topic", "out", "ck", "base"))
    publish_json(ev.filter(F.col("event_id").cast("long") < 500).repartition(2, "event_id"),
                 f"{topic}/a")
    src = read_json_stream(spark, f"{topic}/*", MESSAGE_DDL, max_files_per_trigger=1)
    stream_rollup(src, STREAM_DAILY, out, ck).awaitTermination()
    compact_stream_rollup(spark, STREAM_DAILY, out, base)
    compact_stream_rollup(spark, STREAM_DAILY, out, base)          # nothing new: no change
    publish_json(ev.filter(F.col("event_id").cast("long") >= 500).repartition(2, "event_id"),
                 f"{topic}/b")
    src = read_json_stream(spark, f"{topic}/*", MESSAGE_DDL, max_files_per_trigger=1)
    stream_rollup(src, STREAM_DAILY, out, ck).awaitTermination()
    compact_stream_rollup(spark, STREAM_DAILY, out, base)          # old partials still on disk
    got = sorted(tuple(r) for r in read_stream_rollup(
        spark, STREAM_DAILY, out, compacted_path=base).select(COLS).collect())
    assert got == _batch_answer(spark, sf_small)


def test_detail_stream_quarantine_with_bad_row_count(spark, sf_small, tmp_dir):
    """Detail micro-batches count bad rows while writing; the quarantine
    gets exactly the bad messages whether or not a batch has any."""
    from chronoroll.streaming import bad_messages
    raw = raw_events(table(spark, sf_small, "events"))
    good_only = raw.filter(F.col("ts").rlike("^[0-9]{2}/[0-9]{2}/[0-9]{4} [0-9]{2}:[0-9]{2}:[0-9]{2} [AP]M$"))
    publish_json(good_only.repartition(1), f"{tmp_dir}/t/a")
    publish_json(raw.repartition(1), f"{tmp_dir}/t/b")
    spec = STREAM_DAILY.with_(rollup=False)
    src = read_json_stream(spark, f"{tmp_dir}/t/*", MESSAGE_DDL, max_files_per_trigger=1)
    stream_rollup(src, spec, f"{tmp_dir}/o", f"{tmp_dir}/c",
                  quarantine_path=f"{tmp_dir}/q").awaitTermination()
    _, bad = clean(raw, spec)
    want_bad = sorted(r["_raw_time"] for r in bad.collect())
    got = sorted(r["_raw_time"] for r in bad_messages(spark, f"{tmp_dir}/q").collect())
    assert got == want_bad and got
    n_good_only = good_only.count()
    assert n_good_only > 0
    loaded = spark.read.parquet(f"{tmp_dir}/o").count()
    assert loaded == n_good_only + raw.count() - len(want_bad)


def _two_batches(spark, sf, tmp_dir):
    """A stream's output after two micro-batches, with its checkpoint and the batch answer."""
    topic, out, ck = (f"{tmp_dir}/{x}" for x in ("topic", "out", "ck"))
    publish_json(raw_events(table(spark, sf, "events")).repartition(2, "event_id"), topic)
    src = read_json_stream(spark, topic, MESSAGE_DDL, max_files_per_trigger=1)
    stream_rollup(src, STREAM_DAILY, out, ck).awaitTermination()
    return out, ck, _batch_answer(spark, sf)


def test_base_says_what_it_covers_by_its_folders(spark, sf_small, tmp_dir):
    import glob
    import os
    from chronoroll.streaming import compact_stream_rollup, purge_compacted
    out, _, want = _two_batches(spark, sf_small, tmp_dir)
    base = f"{tmp_dir}/base"
    read = lambda: read_stream_rollup(spark, STREAM_DAILY, out, compacted_path=base).select(COLS)
    assert compact_stream_rollup(spark, STREAM_DAILY, out, base, upto_batch=0) == 0
    assert {os.path.basename(f) for f in glob.glob(f"{base}/chunk=*/*")} == {"upto_batch=0"}
    assert sorted(tuple(r) for r in read().collect()) == want
    # covered partials are left out by a partition filter: no join with the base, no file of theirs is read
    plan = read()._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "PartitionFilters: [" in plan
    assert compact_stream_rollup(spark, STREAM_DAILY, out, base) == 1
    assert {os.path.basename(f) for f in glob.glob(f"{base}/chunk=*/*")} == {"upto_batch=1"}
    assert purge_compacted(spark, out, base) > 0
    assert sorted(tuple(r) for r in read().collect()) == want


def test_compaction_that_died_is_finished_by_the_next(spark, sf_small, tmp_dir, monkeypatch):
    import glob
    from chronoroll.sinks import journal
    from chronoroll.streaming import compact_stream_rollup
    out, _, want = _two_batches(spark, sf_small, tmp_dir)
    base = f"{tmp_dir}/base"
    read = lambda: sorted(tuple(r) for r in read_stream_rollup(
        spark, STREAM_DAILY, out, compacted_path=base).select(COLS).collect())
    compact_stream_rollup(spark, STREAM_DAILY, out, base, upto_batch=0)
    real = journal.delete_path

    def dies(spark, path):
        if "upto_batch=0" in path:
            raise OSError("killed")
        real(spark, path)
    # new versions are in place, the old ones not yet removed
    monkeypatch.setattr(journal, "delete_path", dies)
    try:
        compact_stream_rollup(spark, STREAM_DAILY, out, base)
    except OSError:
        pass
    monkeypatch.undo()
    assert glob.glob(f"{base}/chunk=*/upto_batch=0") and glob.glob(f"{base}/chunk=*/upto_batch=1")
    assert read() == want
    compact_stream_rollup(spark, STREAM_DAILY, out, base)
    assert not glob.glob(f"{base}/chunk=*/upto_batch=0") and read() == want


def test_compaction_takes_committed_batches_only(spark, sf_small, tmp_dir):
    import os
    import pytest
    from chronoroll.streaming import compact_stream_rollup, last_committed
    out, ck, want = _two_batches(spark, sf_small, tmp_dir)
    assert last_committed(spark, ck) == 1 and last_committed(spark, f"{tmp_dir}/none") == -1
    os.remove(f"{ck}/commits/1")                       # as while batch 1 is being written
    base = f"{tmp_dir}/base"
    assert compact_stream_rollup(spark, STREAM_DAILY, out, base, checkpoint=ck) == 0
    assert sorted(tuple(r) for r in read_stream_rollup(
        spark, STREAM_DAILY, out, compacted_path=base).select(COLS).collect()) == want
    assert compact_stream_rollup(spark, STREAM_DAILY, f"{tmp_dir}/none", f"{tmp_dir}/b2") == -1
    with pytest.raises(ValueError):                    # a folder that is no base is not taken for an empty one
        read_stream_rollup(spark, STREAM_DAILY, out, compacted_path=out)


def test_spec_period_is_the_trigger(spark, sf_small, tmp_dir):
    import datetime as dt
    from chronoroll.plans.spec_job import run_stream_spec
    from chronoroll.plans.suite import EVENTS_STREAM_SPEC_JSON
    body = EVENTS_STREAM_SPEC_JSON["spec"]
    timed = {"spec": {**body, "tuningConfig": {"intermediatePersistPeriod": "PT3S"}}}
    raw = raw_events(table(spark, sf_small, "events"))
    topic = f"{tmp_dir}/topic"
    publish_json(raw.filter(F.col("event_id").cast("long") % 2 == 0), f"{topic}/a")
    q, spec = run_stream_spec(spark, timed, f"{tmp_dir}/o", f"{tmp_dir}/c", source_override=f"{topic}/*", trigger="spec")
    try:
        q.processAllAvailable()
        assert q.isActive                               # it goes on until it is stopped
        publish_json(raw.filter(F.col("event_id").cast("long") % 2 == 1), f"{topic}/b")
        q.processAllAvailable()
        starts = [dt.datetime.fromisoformat(p["timestamp"].replace("Z", "+00:00")) for p in q.recentProgress if p["numInputRows"] > 0]
    finally:
        q.stop()
    assert len(starts) >= 2
    # after the first one, batches start on the period
    assert all(s.timestamp() % 3 < 1.5 for s in starts[1:])
    got = sorted(tuple(r) for r in read_stream_rollup(spark, spec, f"{tmp_dir}/o").select(COLS).collect())
    assert got == _batch_answer(spark, sf_small)
