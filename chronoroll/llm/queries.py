"""Queries of this subpackage over the given tables, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import align, extract, nearby, packing, periodic, pieces, quality, secret_scan, semantic, substring, toxicity, urls, warc
from . import words as W


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rules of the URL query: fixed values of its contract.
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
             ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return semantic.leaks(docs, _table(spark, sf_dir, "benchmark"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring.dedup(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return nearby.groups(docs, size=2)


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract.extract(pages, extract.learn(pages)).select("page_id", "url", "text", "n_chars")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as P
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    special = packing.special_tokens(P.path("byte_bpe_50k.json"))
    pieces = W.checkpointed(packing.tokenize(docs, P.path("byte_bpe_50k.tiktoken"), P.PATTERN, special=special).drop("ids"))
    return packing.pack(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.judge(pages, rules).select("page_id", "host", "path", "rule", "verdict")


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = secret_scan.scan(docs)
    base = F.col("base_spans")
    return rows.select(
        "doc_id", *[secret_scan.count(base, k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(secret_scan.listed(base).cast("binary"), 256).alias("base_sha256"),
        secret_scan.listed(F.col("spans")).alias("spans"))


#: Pages whose record is damaged or lost in the second replica: (modulus, remainder).
DAMAGED, LOST = (1009, 7), (2003, 11)


def op8_warc_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as two WARC replicas, the second with damaged and lost records, and audited.

    A file of an archive holds the pages of one split of the table.
    """
    split = F.xxhash64("_metadata.file_name", "_metadata.file_block_start").alias("file")
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html", split)
    page, html = F.col("page_id"), F.coalesce("html", F.lit(""))
    damaged = F.when(page % DAMAGED[0] == DAMAGED[1], F.concat(F.lit("?"), F.substr(html, F.lit(2)))).otherwise(html)

    def replica(rows: DataFrame, payload: Column) -> DataFrame:
        text = warc.record(F.concat(F.lit("urn:page:"), page.cast("string")), F.col("url"), payload)
        named = rows.select("file", page.alias("order"), text.alias("record"))
        return warc.read(spark, warc.write(named, scratch_path(spark, "warc"), gather=False, compression="gzip"))

    found = warc.audit(replica(pages, html), replica(pages.where(~F.coalesce(page % LOST[0] == LOST[1], F.lit(False))), damaged))
    return found.select(F.regexp_extract("record_id", r"(\d+)$", 1).cast("long").alias("page_id"), F.col("uri").alias("url"), "status")


def _fold(c: str) -> Column:
    """crc32 of the id as text, modulo 4: rows of remainder 2 are held out."""
    return F.pmod(F.crc32(F.col(c).cast("string").cast("binary")), F.lit(4))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _table(spark, sf_dir, "labels").select("doc_id", "toxic")
    train = toxicity.training_rows(docs, labels, _fold("doc_id") != 2)
    model = toxicity.Model(train, _fold("id") == 3)
    return model.score(docs).select(
        "doc_id", F.coalesce(_fold("doc_id") == 2, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    voted = W.checkpointed(quality.with_votes(quality.measures(docs)).drop("text"))
    return (quality.score(voted).withColumn("base_failed", quality.base_failed())
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    "base_failed", (~F.col("base_failed") & F.col("good")).alias("kept"), "p_good"))


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as P
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return pieces.encode(docs, P.path("piece_bpe_32k.model")).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"), F.sha2("spans", 256).alias("spans_sha256"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as P
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = align.align(docs, P.path("byte_bpe_50k.tiktoken"), P.PATTERN, P.path("piece_bpe_32k.model"))
    return rows.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
        F.when(F.col("n_a") > 0, F.sha2(F.col("groups").cast("binary"), 256)).otherwise("").alias("groups_sha256"))


def repeated_tails(docs: DataFrame) -> DataFrame:
    """The contract's texts: for a tenth of the ids, the words from a place on repeat the first of them.

    The words of a changed text are joined by one space; the others stay.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = docs.select("doc_id", "text", h.alias("h")).withColumn(
        "w", F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))))
    sized = chosen.withColumn("n", F.size("w")).withColumn("g", F.floor(F.col("h") / 10))
    placed = sized.withColumn("a", F.expr("CAST(g % nullif(n, 0) AS int)")).withColumn(
        "p", F.expr("CAST(1 + (n - a) div (3 + g % 8) AS int)"))
    tail = F.expr("slice(flatten(array_repeat(slice(w, a + 1, p), CAST((n - a) div p + 1 AS int))), 1, n - a)")
    return placed.select("doc_id", F.when(F.col("n") > 0, F.concat_ws(" ", F.expr("slice(w, 1, a)"), tail)).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = periodic.find(repeated_tails(_table(spark, sf_dir, "documents").select("doc_id", "text")))
    best = F.expr("array_sort(runs, (x, y) -> CASE WHEN x.length <> y.length THEN IF(x.length > y.length, -1, 1) "
                  "WHEN x.start <> y.start THEN IF(x.start < y.start, -1, 1) ELSE IF(x.period < y.period, -1, 1) END)")
    top = F.get(best, F.lit(0))
    listed = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    return (rows.withColumn("top", top).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "top.start", "top.length", "top.period",
        F.expr("top.length * 1000 div top.period").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_near_duplicates": op3_near_duplicates,
    "op4_html_extraction": op4_html_extraction,
    "op5_packing": op5_packing,
    "op6_url_filter": op6_url_filter,
    "op7_secret_scan": op7_secret_scan,
    "op8_warc_audit": op8_warc_audit,
    "op9_toxicity": op9_toxicity,
    "op10_quality_rules": op10_quality_rules,
    "op11_sentencepiece": op11_sentencepiece,
    "op12_token_alignment": op12_token_alignment,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLE_SQL: dict[str, str] = {
    "op6_url_filter": """
        WITH parts AS (
            SELECT page_id,
                   translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
            FROM pages)
        SELECT page_id, host, path,
               CASE WHEN org AND starts_with(path, '/en/1') AND sub THEN 'example.org/en/1'
                    WHEN org AND starts_with(path, '/es/') AND sub THEN 'example.org/es/'
                    WHEN org AND starts_with(path, '/') THEN 'org/'
                    WHEN com AND starts_with(path, '/fr/') THEN 'com/fr/'
                    WHEN com AND starts_with(path, '/de/') THEN 'com/de/' END AS rule,
               CASE WHEN org AND sub AND (starts_with(path, '/en/1') OR starts_with(path, '/es/')) THEN 'block'
                    WHEN com AND starts_with(path, '/de/') THEN 'block' ELSE 'allow' END AS verdict
        FROM (SELECT *, (host = 'org' OR host LIKE '%.org') AS org, (host = 'com' OR host LIKE '%.com') AS com,
                     (host = 'example.org' OR host LIKE '%.example.org') AS sub FROM parts)""",
    "op8_warc_audit": f"""
        SELECT page_id, coalesce(url, '') AS url, CASE WHEN page_id % {LOST[0]} = {LOST[1]} THEN 'missing' ELSE 'changed' END AS status
        FROM pages WHERE page_id % {LOST[0]} = {LOST[1]}
            OR page_id % {DAMAGED[0]} = {DAMAGED[1]} AND coalesce(html, '') NOT LIKE '?%'""",
}
