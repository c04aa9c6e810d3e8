"""Crashes inside a replacement, replay of corrected rows, audits of content, headers that differ, tables that grow columns."""

import itertools
import os

import pytest
from pyspark.sql import functions as F

from chronoroll import Dim, Metric, TableSpec
from chronoroll.operators import finish
from chronoroll.plans import content_audit, fingerprint, load_audit, open_rows, read_ingested, read_range, read_table, replay, run_ingest
from chronoroll.plans.spec_job import run_spec
from chronoroll.sinks import journal, recover, write_snapshot_and_latest, write_table
from chronoroll.sources import read_csv_census, read_partitioned_csv

SPEC = TableSpec(name="t", time_column="at", dimensions=(Dim("kind"), Dim("no", "long")), metrics=(Metric("n", "count"),),
                 query_granularity="day", segment_granularity="day", rollup=False, partition_col="region")
ROLLED = SPEC.with_(dimensions=(Dim("kind"),), metrics=(Metric("n", "count"), Metric("s", "longSum", "no")), rollup=True)
SCHEMA = "region string, at string, kind string, no string"
ROWS = [("north", "2024-01-01T05:00:00", "a", "1"), ("north", "2024-01-02T05:00:00", "a", "2"), ("south sea", "2024-01-02T05:00:00", "b", "3"),
        ("south sea", "2024-01-03T05:00:00", None, None), (None, "2024-01-01T05:00:00", "a", "5")]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def content(spark, spec, path):
    return sorted((tuple(r) for r in finish(read_ingested(spark, spec, path), spec).collect()), key=repr)


class Crash(Exception):
    pass


@pytest.mark.parametrize("step", range(7))
def test_a_crash_in_a_replacement_is_finished_by_the_next_load(spark, tmp_dir, monkeypatch, step):
    run_ingest(spark, SPEC, frame(spark, ROWS), f"{tmp_dir}/t")
    run_ingest(spark, SPEC, frame(spark, [ROWS[0], ROWS[2], ROWS[4]]), f"{tmp_dir}/clean", drop_existing=True)
    count = itertools.count()

    def failing(f):
        def call(*args):
            if next(count) == step:
                raise Crash
            return f(*args)
        return call

    for name in ("move_path", "delete_path"):
        monkeypatch.setattr(journal, name, failing(getattr(journal, name)))
    before = content(spark, SPEC, f"{tmp_dir}/t")
    crashed = False
    try:
        run_ingest(spark, SPEC, frame(spark, [ROWS[0], ROWS[2], ROWS[4]]), f"{tmp_dir}/t", drop_existing=True)
    except Crash:
        crashed = True
    monkeypatch.undo()
    assert crashed
    announced = any(f.endswith(".json") for f in os.listdir(f"{tmp_dir}/t/_journal")) if os.path.isdir(f"{tmp_dir}/t/_journal") else False
    assert recover(spark, f"{tmp_dir}/t") == int(announced)
    want = content(spark, SPEC, f"{tmp_dir}/clean") if announced else before
    assert content(spark, SPEC, f"{tmp_dir}/t") == want
    assert not os.path.exists(f"{tmp_dir}/t/_journal") and not os.path.exists(f"{tmp_dir}/t/_staged")
    assert recover(spark, f"{tmp_dir}/t") == 0


def test_latest_after_a_crash(spark, tmp_dir, monkeypatch):
    write_snapshot_and_latest(frame(spark, ROWS), f"{tmp_dir}/snap", f"{tmp_dir}/latest", "1", "region")
    monkeypatch.setattr(journal, "_carry_out", lambda *a: (_ for _ in ()).throw(Crash))
    with pytest.raises(Crash):
        write_snapshot_and_latest(frame(spark, ROWS[2:4]), f"{tmp_dir}/snap", f"{tmp_dir}/latest", "2", "region")
    monkeypatch.undo()
    assert len([x for x in os.listdir(f"{tmp_dir}/latest") if x.startswith("region=")]) == 3
    write_snapshot_and_latest(frame(spark, ROWS[2:4]), f"{tmp_dir}/snap", f"{tmp_dir}/latest", "3", "region")
    assert [x for x in os.listdir(f"{tmp_dir}/latest") if x.startswith("region=")] == ["region=south sea"]


BAD = [("north", "never", "a", "7"), ("north", "never", "a", "7"), ("south sea", None, "b", "8"), ("north", "later", "c", "9")]


@pytest.mark.parametrize("spec", [SPEC, ROLLED])
@pytest.mark.parametrize("crash", [False, True])
def test_replay_loads_each_corrected_row_once(spark, tmp_dir, monkeypatch, spec, crash):
    t, q = f"{tmp_dir}/t", f"{tmp_dir}/q"
    res = run_ingest(spark, spec, frame(spark, ROWS + BAD), t, quarantine_path=q)
    held = spark.read.parquet(q)
    assert held.select("_row_id").distinct().count() == 4          # equal rows too
    right = held.withColumn("at", F.when(F.col("kind") != "c", F.lit("2024-01-02T09:00:00")).otherwise(F.col("at")))
    extra = right.limit(1).withColumn("_row_id", F.lit("unknown"))
    twice = right.unionByName(extra).unionByName(right.where("kind = 'b'"))
    if crash:
        monkeypatch.setattr(journal, "_carry_out", lambda *a: (_ for _ in ()).throw(Crash))
        with pytest.raises(Crash):
            replay(spark, spec, twice, t, q)
        monkeypatch.undo()
        assert (replay(spark, spec, twice, t, q).rows_settled, open_rows(spark, spec, t, q).count()) == (0, 1)
    else:
        got = replay(spark, spec, twice, t, q)
        assert (got.rows_settled, got.rows_before, got.rows_bad) == (3, 0, 1)
    again = replay(spark, spec, right, t, q)
    assert (again.rows_settled, again.rows_before, again.rows_bad) == (0, 3, 1)
    clean = frame(spark, ROWS + [(r, "2024-01-02T09:00:00", k, n) for r, _, k, n in BAD[:3]])
    run_ingest(spark, spec, clean, f"{tmp_dir}/clean")
    assert content(spark, spec, t) == content(spark, spec, f"{tmp_dir}/clean")
    left = open_rows(spark, spec, t, q)
    assert [r["no"] for r in left.collect()] == ["9"]
    counts = res.counts if res.counts is not None else frame(spark, ROWS + BAD)
    audit = load_audit(counts, read_ingested(spark, spec, t), left, "region", "n").where("region is not null")
    assert {r["status"] for r in audit.collect()} == {"SUCCESS"}


def test_fingerprint_is_of_the_multiset(spark):
    rows = [("x", None, "a"), ("x", "a", None), ("x", "a", "b"), ("x", "a", "b"), (None, "1", "2")]
    get = lambda rs: {r["k"]: tuple(r)[1:] for r in fingerprint(spark.createDataFrame(rs, "k string, a string, b string").repartition(3), ["k"]).collect()}
    whole = get(rows)
    assert get(rows[::-1]) == whole and whole["x"][0] == 4
    for other in (rows[:2] + [rows[2], rows[0]] + rows[4:], rows[:1] * 2 + rows[2:], [("x", "b", "a")] + rows[1:]):
        assert get(other)["x"] != whole["x"] and get(other)[None] == whole[None]


@pytest.mark.parametrize("spec", [SPEC, ROLLED])
def test_content_audit(spark, tmp_dir, spec):
    t, q = f"{tmp_dir}/t", f"{tmp_dir}/q"
    source = frame(spark, ROWS + BAD)
    run_ingest(spark, spec, source, t, quarantine_path=q)
    assert {r["status"] for r in content_audit(spark, spec, source, t, q).collect()} == {"SUCCESS"}
    moved = [("north", a, "b" if k == "a" else k, n) if r == "north" else (r, a, k, n) for r, a, k, n in ROWS]
    got = {r["region"]: (r["rows_match"], r["content_match"], r["status"]) for r in content_audit(spark, spec, frame(spark, moved + BAD), t, q).collect()}
    assert got == {"north": (True, False, "FAILED"), "south sea": (True, True, "SUCCESS"), None: (True, True, "SUCCESS")}
    fewer = {r["region"]: r["rows_match"] for r in content_audit(spark, spec, frame(spark, ROWS[:2]), t).collect()}
    assert fewer == {"north": True, "south sea": False, None: False}
    bad = {r["region"]: (r["bad_expected"], r["bad_found"], r["status"]) for r in content_audit(spark, spec, frame(spark, ROWS + BAD[1:]), t, q).collect()}
    assert bad["north"] == (2, 3, "FAILED")


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as f:
        f.write(text)


def test_header_census(spark, tmp_dir):
    write(f"{tmp_dir}/raw/north/a.csv", '﻿id,"what, name"\r\n1,"x ""y"""\r\n')
    write(f"{tmp_dir}/raw/north/b [1].csv", '"what, name",more,id\nz,m,2\nw,3\n')
    write(f"{tmp_dir}/raw/city=south sea/c.csv", "id,\n3,blank\n")
    write(f"{tmp_dir}/raw/city=south sea/empty.csv", "")
    write(f"{tmp_dir}/raw/city=south sea/only.csv", "id\n")
    df = read_csv_census(spark, f"{tmp_dir}/raw", partition_col="city", malformed=True)
    assert set(df.columns) == {"id", "what, name", "more", "_c1", "_malformed", "city"}
    got = {r["id"] or r["_malformed"]: (r["what, name"], r["more"], r["_c1"], r["city"]) for r in df.collect()}
    assert got == {"1": ('x "y"', None, None, "north"), "2": ("z", "m", None, "north"), "w,3": ("w", "3", None, "north"), "3": (None, None, "blank", "south sea")}
    assert read_csv_census(spark, f"{tmp_dir}/raw", columns=["more", "id", "none"], partition_col="city", regions=["north"]).columns == ["more", "id", "none", "city"]
    write(f"{tmp_dir}/raw/north/twice.csv", "id,id\n1,2\n")
    with pytest.raises(ValueError):
        read_csv_census(spark, f"{tmp_dir}/raw", partition_col="city")
    write(f"{tmp_dir}/none/x/e.csv", "")
    assert read_csv_census(spark, f"{tmp_dir}/none", columns=["id"], partition_col="city").collect() == []


def test_spec_with_a_dialect_and_a_census(spark, tmp_dir):
    write(f"{tmp_dir}/raw/north/a.csv", "no;at;kind\n1;2024-01-01T00:00:00;'it\\'s; a'\n")
    write(f"{tmp_dir}/raw/north/b.csv", "kind;extra;at;no\nb;e;2024-01-01T00:00:00;2\n")
    job = {"partitionColumn": "region", "dataSchema": {
        "timestampSpec": {"column": "at", "format": "iso"}, "granularitySpec": {"rollup": False},
        "dimensionsSpec": {"dimensions": [{"name": "no", "type": "long"}, "kind"]}},
        "ioConfig": {"inputSource": {"baseDir": f"{tmp_dir}/raw", "filter": "*/*.csv"},
                     "inputFormat": {"type": "csv", "headerCensus": True, "delimiter": ";", "quote": "'", "escape": "\\"}}}
    run_spec(spark, job, f"{tmp_dir}/t")
    got = {(r["no"], r["kind"], r["region"]) for r in spark.read.parquet(f"{tmp_dir}/t").collect()}
    assert got == {(1, "it's; a", "north"), (2, "b", "north")}


def test_quoted_cells(spark, tmp_dir):
    write(f"{tmp_dir}/raw/north/a.csv", 'no,p,q\n1,"say ""hi"", then go",x\n2,"a\nb\\",y\n')
    read = lambda **o: read_partitioned_csv(spark, f"{tmp_dir}/raw", columns=["no", "p", "q"], options=o)
    rows = {r["no"]: (r["p"], r["q"]) for r in read(multiLine="true").collect()}
    assert rows == {"1": ('say "hi", then go', "x"), "2": ("a\nb\\", "y")}
    assert read(escape="\\").where("no = '1'").first()["p"] != 'say "hi", then go'
    out = write_table(read(multiLine="true"), f"{tmp_dir}/out", ["region"], fmt="csv")
    back = read_partitioned_csv(spark, out, columns=["no", "p", "q"], options={"multiLine": "true"})
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, read(multiLine="true").collect()))


def test_a_later_load_adds_a_column(spark, tmp_dir):
    narrow = SPEC.with_(dimensions=(Dim("kind"),))
    run_ingest(spark, narrow, frame(spark, ROWS[:2]), tmp_dir)
    run_ingest(spark, SPEC, frame(spark, ROWS[2:4]), tmp_dir)
    assert sorted((r["no"] for r in read_ingested(spark, SPEC, tmp_dir).collect()), key=repr) == [3, None, None, None]
    assert "no" not in read_ingested(spark, narrow, tmp_dir).columns
    merged = read_table(spark, tmp_dir, ["region", "chunk"])
    assert "no" in merged.columns and merged.where("no = 3").count() == 1 and merged.schema["chunk"].dataType.simpleString() == "string"


@pytest.mark.parametrize("granularity,days", [("hour", 1), ("day", 2), ("week", 7), ("month", 31), ("quarter", 92), ("year", 366), ("all", 9999)])
def test_a_range_lists_its_chunks_only(spark, tmp_dir, granularity, days):
    spec = SPEC.with_(segment_granularity=granularity, query_granularity="none")
    times = [f"{y}-{m:02}-{d:02}T{h:02}:30:00" for y in (2023, 2024) for m in (1, 2, 7) for d in (1, 9, 28) for h in (0, 13)]
    run_ingest(spark, spec, frame(spark, [("north", t, "a", "1") for t in times]), tmp_dir)
    for lo, hi in (("2024-01-09T13:00:00", "2024-01-09T14:00:00"), ("2024-01-28", "2024-02-01T01:00:00"), ("2024-01-10", "2024-01-11"), ("2030-01-01", "2031-01-01")):
        rows = read_range(spark, spec, tmp_dir, [f"{lo}/{hi}"])
        got = sorted(r["__time"].isoformat() for r in rows.collect())
        assert got == sorted(t for t in times if lo <= t < hi)
        if granularity != "all":
            assert len(rows.inputFiles()) <= len([t for t in times if abs(int(t[:4]) - int(lo[:4])) < 1]) and len(rows.inputFiles()) < 36
    assert read_range(spark, spec, tmp_dir, ["0001-01-01/9000-01-01"]).count() == len(times)
    assert read_range(spark, spec, tmp_dir, None).count() == len(times)
