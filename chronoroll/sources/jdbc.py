"""Relational sources over JDBC: whole table (S6) or a SQL query.

Reads are split into ``num_partitions`` range scans on a numeric, date or
timestamp column when one is given; without it a JDBC read is a single task,
which is only right for small tables. Nothing is hard-coded: the caller
passes the URL, credentials and driver class.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..spec import JdbcOptions


def jdbc_read_options(opts: JdbcOptions, table: str | None = None, query: str | None = None,
                      partition_column: str | None = None, lower_bound=None,
                      upper_bound=None, num_partitions: int | None = None,
                      fetch_size: int = 10_000) -> dict[str, str]:
    """Options for ``spark.read.format("jdbc")``.

    A query source is sent as ``query`` when unpartitioned; Spark rejects
    ``query`` together with ``partitionColumn``, so a partitioned query
    source is wrapped as a derived table in ``dbtable``.
    """
    if (table is None) == (query is None):
        raise ValueError("give exactly one of table or query")
    out = opts.as_dict()
    out["fetchsize"] = str(fetch_size)
    if partition_column:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("partitioned read needs lower_bound, upper_bound, num_partitions")
        out.update(partitionColumn=partition_column, lowerBound=str(lower_bound),
                   upperBound=str(upper_bound), numPartitions=str(num_partitions))
        out["dbtable"] = table if table is not None else f"({query}) q"
    elif table is not None:
        out["dbtable"] = table
    else:
        out["query"] = query
    return out


def read_jdbc_table(spark: SparkSession, opts: JdbcOptions, table: str, **kw) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_read_options(opts, table=table, **kw)).load()


def read_jdbc_query(spark: SparkSession, opts: JdbcOptions, sql: str, **kw) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_read_options(opts, query=sql, **kw)).load()
