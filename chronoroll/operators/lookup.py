"""Lookup of one value per key from a mapping table.

Spark picks the join: a mapping whose size statistics or measured shuffle
size are below the broadcast threshold is broadcast, a larger one is
shuffled, and a key that holds a large share of the rows is split by AQE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..spec import Lookup


def lookup(df: DataFrame, mapping: DataFrame, key: str, value: str, out: str | None = None,
           map_key: str | None = None, default=None) -> DataFrame:
    """Add ``out`` = mapping[value] for df[key]; unmatched keys get ``default``.

    One value per key is kept (the largest, so the result is deterministic),
    so a lookup never multiplies the rows of ``df``.
    """
    out = out or value
    m = (mapping.groupBy(F.col(map_key or key).alias("_lk"))
                .agg(F.max(F.col(value)).alias("_lv")))
    joined = df.join(m, df[key] == m["_lk"], "left")
    v = F.col("_lv") if default is None else F.coalesce(F.col("_lv"), F.lit(default))
    return joined.withColumn(out, v).drop("_lk", "_lv")


def with_lookups(spark: SparkSession, df: DataFrame, lookups: tuple[Lookup, ...]) -> DataFrame:
    """Add the dimension of every lookup; each mapping is read now, as its files are at this moment."""
    for x in lookups:
        r = spark.read.format(x.fmt)
        mapping = (r.option("header", "true") if x.fmt == "csv" else r).load(x.path)
        df = lookup(df, mapping, x.column, x.value, out=x.name, map_key=x.key, default=x.default)
    return df
