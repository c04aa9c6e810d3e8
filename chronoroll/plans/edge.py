"""Edge-format inputs made from the driver tables by Spark.

The reference ingests per-region CSV text with ``MM/dd/yyyy hh:mm:ss a``
times, untyped cells and JSON messages. The driver provides typed Parquet
tables instead, so these helpers turn the *whole* ``events`` table into that
edge form — every row, nothing sampled — and write it where the cluster's
shared folder says. Missing and malformed cells are made by a fixed rule on
the record id, so the SQL oracle can state the same rule.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.time import format_reference_time
from ..sinks.files import publish_json, write_table

# Record-id rules that make missing and malformed cells, and
# the share of rows moved into one hot region for skew runs.
HOT_REGION = "hot"
HOT_MOD = 3                # every third record belongs to the hot region
MISSING_TIME_MOD = 97      # time text left empty
BAD_TIME_MOD = 101         # time text that is not a time
BAD_USER_MOD = 71          # user id with a letter in it
BAD_VALUE_MOD = 53         # measure that is not a number
GARBLED_MOD = 89           # message or line that is broken
BAD_TIME_TEXT = "not a time"
BAD_VALUE_TEXT = "n/a"

RAW_EVENT_COLUMNS = ["event_id", "ts", "user_id", "value", "props"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_events(events: DataFrame) -> DataFrame:
    """``events`` as untyped text cells, as a CSV or message would carry them."""
    eid = F.col("event_id")
    ts = (F.when(eid % MISSING_TIME_MOD == 0, F.lit(None).cast("string"))
           .when(eid % BAD_TIME_MOD == 0, F.lit(BAD_TIME_TEXT))
           .otherwise(format_reference_time("ts")))
    user = F.col("user_id").cast("string")
    user = F.when(eid % BAD_USER_MOD == 0, F.concat(F.lit("u"), user)).otherwise(user)
    value = F.col("value").cast("string")
    value = F.when(eid % BAD_VALUE_MOD == 0, F.lit(BAD_VALUE_TEXT)).otherwise(value)
    return events.select(eid.cast("string").alias("event_id"), ts.alias("ts"),
                         user.alias("user_id"), "event_type", value.alias("value"), "props")


def with_hot_region(raw: DataFrame, region_col: str = "event_type") -> DataFrame:
    """The same rows with a third of them moved into one region (skew)."""
    hot = F.col("event_id").cast("long") % HOT_MOD == 0
    return raw.withColumn(region_col, F.when(hot, F.lit(HOT_REGION)).otherwise(F.col(region_col)))


def write_region_csv(raw: DataFrame, base: str, region_col: str = "event_type",
                     files_per_region: int | None = None) -> str:
    """One folder per region holding CSV files with a header row.

    Files are sized by AQE (a large region gets many files), as any
    region's raw drop would be split over many files at scale."""
    return write_table(raw, base, [region_col], mode="overwrite", fmt="csv",
                       files_per_partition=files_per_region)


def publish_events(raw: DataFrame, topic_dir: str, key: str | None = "event_type") -> str:
    """Every raw event as one JSON message line, keyed (foldered) by region."""
    publish_json(raw, topic_dir, partition_cols=[key] if key else None)
    return topic_dir
