"""chronoroll — time-bucketed ingest and rollup on Spark.

Load event records from partitioned CSV, Parquet, JDBC or JSON streams into
typed DataFrames; parse and default event times; set malformed rows aside;
roll rows up by time bucket and dimensions with mergeable metrics; write
tables laid out by region and time chunk with partition-level replacement;
keep the rollups current with Structured Streaming; audit every load.
"""

from .session import build_session, scratch_path, shared_dir
from .spec import Dim, JdbcOptions, Metric, TableSpec

__all__ = ["build_session", "scratch_path", "shared_dir", "Dim", "JdbcOptions", "Metric",
           "TableSpec"]
