"""The corpus pipeline stage by stage against brute force, and queries with SQL against DuckDB."""

import collections
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from chronoroll.llm import quality
from chronoroll.llm.queries import ORACLE_SQL, QUERIES

from .test_corpus import base_spans, ids_of, measured


@pytest.fixture(scope="module")
def stages(spark, sf_small, tmp_path_factory):
    """Input and output rows of every stage over the small documents and a few odd ones."""
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    odd = spark.createDataFrame([(10_000, None, None, None, None), (10_001, "", "en", "s", 0), (None, "word " * 3, "en", "s", 1),
                                 (10_002, " ".join(f"w{i}" for i in range(40)) + " password=hunter2222", "en", "s", 5)], docs.schema)
    docs = docs.unionByName(odd).withColumn("n_words", F.lit("mine")).withColumn("kept", F.lit(1))
    out = []
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, sf_small).write.parquet(path)
        result = spark.read.parquet(path)
        out.append((docs.collect(), result.collect(), docs.columns, result.columns))
        docs = result
    return out


def test_stages_keep_the_columns(stages):
    for before, _, columns, result in stages[:-1]:
        assert result == columns and before
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "near_duplicates", "decontamination", "secret_scan", "best_fit_packing"]


def test_quality_stage(spark, stages):
    before, after, *_ = stages[0]
    failed = {r["doc_id"] for r in before if (m := measured(r["text"]))[0] < 10 or 100 * m[4] > 20 * m[0]}
    kept = collections.Counter((r["doc_id"], r["text"]) for r in after)
    assert not kept - collections.Counter((r["doc_id"], r["text"]) for r in before)
    assert not failed & {i for i, _ in kept}
    df = spark.createDataFrame([(r["doc_id"], r["text"]) for r in before], "doc_id long, text string")
    counts = [(r["votes"], r["count"]) for r in quality.with_votes(quality.measures(df)).groupBy("votes").count().collect()]
    *_, good = quality.fit(counts)
    votes = {r["doc_id"]: r["votes"] for r in quality.with_votes(quality.measures(df)).collect()}
    assert {i for i, _ in kept} == {i for i, v in votes.items() if good[v] >= 0.5 and i not in failed}


def five_word_sets(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[k:k + 5]) for k in range(len(words) - 4)} or ({tuple(words)} if words else set())


def test_near_duplicate_stage(stages):
    before, after, *_ = stages[1]
    sets = {r["doc_id"]: five_word_sets(r["text"]) for r in before}
    first = {i: i for i in sets}

    def root(i):
        while first[i] != i:
            i = first[i]
        return i

    holders = collections.defaultdict(list)
    for i, s in sets.items():
        for shingle in s:
            holders[shingle].append(i)
    for i, s in sets.items():
        for j in {j for shingle in s for j in holders[shingle] if j < i}:
            same = len(s & sets[j])
            if 100 * same >= 80 * (len(s) + len(sets[j]) - same):
                a, b = root(i), root(j)
                first[max(a, b)] = min(a, b)
    want = {i for i in sets if root(i) == i}
    assert len(want) < len(sets) and {r["doc_id"] for r in after} == want


def test_decontamination_stage(spark, sf_small, stages):
    before, after, *_ = stages[2]
    plain = lambda t: " ".join(re.findall(r"\w+", (t or "").lower()))
    items = [p for r in spark.read.parquet(f"{sf_small}/benchmark.parquet").collect() if len((p := plain(r["text"])).split()) >= 8]
    leaked = {r["doc_id"] for r in before if any(f" {p} " in f" {plain(r['text'])} " for p in items)}
    assert leaked and {r["doc_id"] for r in after} == {r["doc_id"] for r in before} - leaked


def test_secret_stage(stages):
    before, after, *_ = stages[3]
    texts = {r["doc_id"]: r["text"] for r in after}
    assert len(after) == len(before) and any("[REDACTED]" in t for t in texts.values())
    for r in before:
        text, at, want = r["text"], 0, ""
        spans = sorted((a, b) for _, a, b in base_spans(text))
        for a, b in spans:
            if a >= at:
                want += text[at:a] + "[REDACTED]"
            at = max(at, b)
        assert texts[r["doc_id"]] == want + text[at:]
    assert all(r["n_chars"] == len(r["text"]) for r in after)


def test_packing_stage(stages):
    before, after, *_ = stages[4]
    total = collections.Counter()
    used = collections.Counter()
    for r, ids in zip(before, ids_of([r["text"] or "" for r in before]), strict=True):
        cut = len(ids) % 1024 or 1024
        for k, (a, b) in enumerate([(0, cut), *[(x, x + 1024) for x in range(cut, len(ids), 1024)]]):
            total[(r["doc_id"], k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))] += 1
    assert collections.Counter(tuple(r)[:5] for r in after) == total
    for r in after:
        used[r["sequence_id"]] += r["length"]
    assert max(used.values()) <= 1024


def test_run_is_the_stages_in_order(spark, sf_small):
    rows = corpus_pipeline.run(spark, sf_small).collect()
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_small)
    assert collections.Counter(tuple(r)[:5] for r in rows) == collections.Counter(tuple(r)[:5] for r in docs.collect())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_queries_with_sql(spark, sf_small, name):
    con = duckdb.connect()
    for t in ("pages", "documents"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    found = con.execute(ORACLE_SQL[name])
    columns = [d[0] for d in found.description]
    rows = collections.Counter(found.fetchall())
    assert collections.Counter(tuple(r[c] for c in columns) for r in QUERIES[name](spark, sf_small).collect()) == rows
