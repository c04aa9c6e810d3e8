"""SQL over ingested tables (Q1) and create-table-as-select."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def register(spark: SparkSession, name: str, source: str | DataFrame,
             fmt: str = "parquet") -> DataFrame:
    """Expose a table (path or frame) to ``spark.sql`` under ``name``."""
    df = spark.read.format(fmt).load(source) if isinstance(source, str) else source
    df.createOrReplaceTempView(name)
    return df


def ctas(spark: SparkSession, sql: str, name: str, path: str, fmt: str = "parquet",
         partition_cols: list[str] | None = None) -> DataFrame:
    """Run ``sql`` and store the whole result as table ``name`` at ``path``.

    No row limit is applied: the result is written by the executors and
    never passes through the driver.
    """
    w = spark.sql(sql).write.mode("overwrite").format(fmt).option("path", path)
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.saveAsTable(name)
    return spark.table(name)
