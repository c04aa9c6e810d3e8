"""WARC files written, read and audited against a plain comparison of their records."""

import collections
import os
import random

import pytest
from pyspark.sql import functions as F

from chronoroll.llm import warc

from .test_corpus import prose


def archive(spark, rows, path):
    df = spark.createDataFrame(rows, "file string, order long, id string, uri string, payload string")
    text = warc.record(F.col("id"), F.col("uri"), F.col("payload"))
    warc.write(df.select("file", "order", text.alias("record")), path)
    return path


def pages(n=120):
    rng = random.Random(4)
    rows = [(f"f{i % 3}", i, f"urn:page:{i}", f"http://h/{i}", prose(rng, rng.randrange(1, 900))) for i in range(n)]
    rows += [("f0", 500, "urn:page:500", None, None), ("f0", 501, "urn:page:501", "http://h/a\r\nb", ""),
             ("f1", 502, "urn:page:502", "http://h/é", "ends\r\n\r\n"), ("f1", 503, "urn:page:503", "u", "é𝒳\n" * 50),
             ("f2", 504, "urn:page:1", "u", "same id"), ("f2", 505, "urn:page:1", "u", "same id again"), ("f2", 506, "urn:page:506", "u", "end\r\n\r\n")]
    return rows


def expected(a, b):
    """(record id, status) by comparing the payloads of the nth record of each id and file."""
    def by_key(rows):
        seen, out = collections.Counter(), {}
        for f, _, i, u, p in sorted(rows, key=lambda r: (r[0], r[1])):
            out[(f, i, seen[(f, i)])] = (u or "", p or "")
            seen[(f, i)] += 1
        return out
    x, y = by_key(a), by_key(b)
    return collections.Counter((i, "missing" if (f, i, n) not in y else "extra" if (f, i, n) not in x else "changed")
                               for f, i, n in x.keys() | y.keys() if x.get((f, i, n)) != y.get((f, i, n)))


def found(df):
    return collections.Counter((r["record_id"], r["status"]) for r in df.collect())


def test_files_are_warc_and_read_back(spark, tmp_dir):
    rows = pages()
    read = warc.read(spark, archive(spark, rows, f"{tmp_dir}/a")).collect()
    assert len(read) == len(rows) and not any(r["torn"] for r in read)
    for name in ("f0", "f1", "f2"):
        (part,) = [x for x in os.listdir(f"{tmp_dir}/a/file={name}") if x.startswith("part-")]
        with open(f"{tmp_dir}/a/file={name}/{part}", "rb") as f:
            raw = f.read()
        for r in (r for r in read if r["file"] == name):
            record = raw[r["offset"]:r["offset"] + r["length"]]
            assert record.startswith(b"WARC/1.0\r\n") and f"<{r['record_id']}>".encode() in record
            assert raw[r["offset"] + r["length"]:][:4] == b"\r\n\r\n"


def test_audit_finds_exactly_the_differences(spark, tmp_dir):
    a = pages()
    b = [r for r in a if r[1] not in (3, 77)] + [("f1", 900, "urn:page:900", "u", "new"), ("f2", 507, "urn:page:1", "u", "third")]
    b = [(f, o, i, u, (p or "") + "x" if o in (10, 11, 500) else "y" + p[1:] if o == 44 else p) for f, o, i, u, p in b]
    x, y = (warc.read(spark, archive(spark, rows, f"{tmp_dir}/{k}")) for k, rows in (("a", a), ("b", b)))
    assert found(warc.audit(x, y)) == expected(a, b)
    assert found(warc.audit(x, x)) == {}


@pytest.mark.parametrize("size", [64, 1 << 12])
def test_small_ranges_make_deep_trees(spark, tmp_dir, monkeypatch, size):
    monkeypatch.setattr(warc, "RANGE", size)
    monkeypatch.setattr(warc, "FANOUT", 2)
    a = pages(60)
    b = [(f, o, i, u, "z" + p[1:] if o in (5, 59) else p) for f, o, i, u, p in a]
    x, y = (warc.read(spark, archive(spark, rows, f"{tmp_dir}/{k}")) for k, rows in (("a", a), ("b", b)))
    assert found(warc.audit(x, y)) == expected(a, b) and expected(a, b)


def test_lost_files_empty_archives_and_torn_records(spark, tmp_dir):
    a = pages(30)
    x = warc.read(spark, archive(spark, a, f"{tmp_dir}/a"))
    assert found(warc.audit(x, x.where("file <> 'f1'"))) == expected(a, [r for r in a if r[0] != "f1"])
    assert found(warc.audit(x.limit(0), x.limit(0))) == {} and sum(found(warc.audit(x.limit(0), x)).values()) == len(a)
    archive(spark, a, f"{tmp_dir}/b")
    (part,) = [x for x in os.listdir(f"{tmp_dir}/b/file=f0") if x.startswith("part-")]
    os.remove(f"{tmp_dir}/b/file=f0/.{part}.crc")
    with open(f"{tmp_dir}/b/file=f0/{part}", "r+b") as f:
        f.truncate(os.path.getsize(f.name) - 12)
    torn = found(warc.audit(x, warc.read(spark, f"{tmp_dir}/b")))
    last = max((r for r in a if r[0] == "f0"), key=lambda r: r[1])
    assert torn == {(last[2], "torn"): 1}
