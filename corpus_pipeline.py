"""Training-data pipeline over ``documents``: rules, near-duplicates, decontamination, secrets, packing.

Every stage takes what its predecessor kept. All but the last return the
columns of their input; the last returns the pieces of the packed sequences.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoroll.llm import nearby, packing, quality, secret_scan, semantic
from chronoroll.llm import words as W
from chronoroll.session import scratch_path


def _all(docs: DataFrame) -> list:
    return [F.col(W.quoted(c)) for c in docs.columns]


def _packed(docs: DataFrame) -> DataFrame:
    """``docs`` as its text and a struct of the other columns, whose names then clash with nothing."""
    rest = [F.col(W.quoted(c)).alias(f"c{i}") for i, c in enumerate(docs.columns) if c != "text"]
    return docs.select(F.struct(*rest).alias("doc"), "text")


def _unpacked(rows: DataFrame, docs: DataFrame) -> DataFrame:
    return rows.select(*[F.col("text") if c == "text" else F.col(f"doc.c{i}").alias(c) for i, c in enumerate(docs.columns)])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and that the weighed rules call good."""
    judged = quality.judge(_packed(docs))
    return _unpacked(judged.where(~quality.base_failed() & F.col("good")), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles), the one with the smallest id."""
    dropped = nearby.groups(docs.select("doc_id", "text")).where(~F.col("kept")).select("doc_id").distinct()
    return docs.join(dropped, "doc_id", "left_anti").select(*_all(docs))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    leaks = semantic.leaks(docs.select("doc_id", "text"), benchmark).select("doc_id").distinct()
    return docs.join(leaks, "doc_id", "left_anti").select(*_all(docs))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every secret replaced by a mark; ``n_chars`` follows the text."""
    found = secret_scan.scan(_packed(docs)).withColumn("text", secret_scan.redacted(F.col("text"), F.col("spans")))
    out = _unpacked(found, docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text")).cast(docs.schema["n_chars"].dataType))
    return out


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, packed into sequences of at most 1024 tokens."""
    import public_tokenizers as P
    special = packing.special_tokens(P.path("byte_bpe_50k.json"))
    pieces = W.checkpointed(packing.tokenize(docs.select("doc_id", "text"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN, special=special).drop("ids"))
    return packing.pack(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secret_scan", secrets),
    ("best_fit_packing", best_fit_packing),
]

#: SQL can't express the signatures, the latent space or the packing: tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over ``documents``, each result but the last written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
