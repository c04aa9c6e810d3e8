"""Sources: files (CSV, Parquet, CSV lines) and JDBC."""

from .census import headers, read_csv_census
from .files import (from_csv_lines, read_csv, read_csv_positional, read_parquet,
                    read_partitioned_csv)
from .jdbc import jdbc_read_options, read_jdbc_query, read_jdbc_table

__all__ = ["from_csv_lines", "read_csv", "read_csv_positional", "read_parquet",
           "read_partitioned_csv", "headers", "read_csv_census", "jdbc_read_options", "read_jdbc_query", "read_jdbc_table"]
