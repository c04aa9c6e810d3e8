"""File sinks: snapshots, the ``latest`` copy, appends, partition replacement.

Layout rule for every partitioned write: before writing, rows are clustered
on the partition columns with Spark's ``REBALANCE`` hint. Adaptive query
execution then sizes the writer tasks from the real shuffle sizes: small
partition values are packed into one task, and a value holding a third of
all rows is split over as many tasks as its bytes need (advisory partition
size), so no writer task grows with the data and no partition folder
collects one file per upstream task. Fixed salting (``files_per_partition``
> 1) and one file per value (``= 1``, the reference's per-region output)
are available when a caller needs a fixed file count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.time import chunk_label
from ..functions.values import CSV_DIALECT, CSV_WRITER
from .journal import commit, partition_folders, recover, staging_path

CHUNK = "chunk"
# How CSV files written here are read back: cells may hold line breaks, so a
# file (sized by its writer) is one task.
SNAPSHOT_CSV = {**CSV_DIALECT, "header": "true", "multiLine": "true"}

# Text formats of timestamps in CSV and JSON files we write and read.
TEXT_TIME_OPTIONS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
                     "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def with_chunk(df: DataFrame, time_col: str, granularity: str, name: str = CHUNK) -> DataFrame:
    """Add the time-chunk (segment) label used as a partition folder (K6)."""
    return df.withColumn(name, chunk_label(time_col, granularity))


def layout(df: DataFrame, partition_cols: list[str], files_per_partition: int | None = None,
           num_partitions: int | None = None) -> DataFrame:
    """Cluster rows on the partition columns before a partitioned write.

    ``None`` (default): ``REBALANCE`` — AQE merges small and splits large
    partition values by size. ``1``: one writer task, hence one file, per
    partition value (K8; only for values known to be small). ``n > 1``:
    each value spread over ``n`` tasks by a hash of the row (a retried task
    routes every row as the first attempt did). ``0``: keep the upstream
    partitioning, no shuffle.
    """
    if not partition_cols or files_per_partition == 0:
        return df
    if files_per_partition is None:
        # hint parameters are read as SQL: quote names (they may hold spaces)
        return df.hint("rebalance", *[f"`{c}`" for c in partition_cols])
    keys = [F.col(f"`{c}`") for c in partition_cols]
    if files_per_partition > 1:
        salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]),
                      F.lit(files_per_partition))
        keys.append(salt)
    if num_partitions:
        return df.repartition(num_partitions, *keys)
    return df.repartition(*keys)


def _writer(df: DataFrame, mode: str, partition_cols: list[str] | None,
            max_rows_per_file: int | None, fmt: str, header: bool, dynamic: bool):
    w = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", str(header).lower()).options(**CSV_WRITER)
    if fmt in ("csv", "json"):
        w = w.options(**TEXT_TIME_OPTIONS)
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    if max_rows_per_file:
        w = w.option("maxRecordsPerFile", int(max_rows_per_file))
    if dynamic:
        w = w.option("partitionOverwriteMode", "dynamic")
    return w


def write_table(df: DataFrame, path: str, partition_cols: list[str] | None = None,
                mode: str = "overwrite", fmt: str = "parquet", header: bool = True,
                files_per_partition: int | None = None, max_rows_per_file: int | None = None,
                dynamic: bool = True, sort_within: list[str] | None = None) -> str:
    """Write ``df`` as a partitioned table; returns ``path``.

    ``mode="overwrite"`` with ``dynamic`` replaces only the partitions present
    in ``df`` and leaves all others (K5); the replaced partitions are swapped
    in at commit, so a failed job leaves the previous data in place (no
    up-front delete). ``sort_within`` orders rows inside each file (min/max
    statistics then let a filter on that column skip row groups).
    """
    out = layout(df, partition_cols or [], files_per_partition)
    if sort_within:
        # prefixed by the partition columns: that is the order the writer needs
        # anyway, so it adds no sort of its own on top of this one
        out = out.sortWithinPartitions(*(partition_cols or []), *sort_within)
    _writer(out, mode, partition_cols, max_rows_per_file, fmt, header,
            dynamic and bool(partition_cols)).save(path)
    return path


def append_table(df: DataFrame, path: str, partition_cols: list[str] | None = None,
                 **kw) -> str:
    """Append rows to a time-series table, no rollup (K4)."""
    return write_table(df, path, partition_cols, mode="append", **kw)


def replace_partitions(df: DataFrame, path: str, partition_cols: list[str], **kw) -> str:
    """Replace exactly the partitions present in ``df`` (K5)."""
    if not partition_cols:
        raise ValueError("replace_partitions needs partition columns")
    return write_table(df, path, partition_cols, mode="overwrite", dynamic=True, **kw)


def replace_scope(df: DataFrame, path: str, partition_cols: list[str], scope: list[str] | None = None, **kw) -> None:
    """Put the partitions of ``df`` in the table and remove what else lies in ``scope`` (K5, K2).

    ``scope`` are partition folders relative to ``path`` (all of the table's
    by default). The rows are staged first, then swapped in by a journal: a
    crash at any point leaves the old table, or a change that the next load
    of the table finishes (see ``journal``).
    """
    spark = df.sparkSession
    recover(spark, path)
    if scope is None:
        scope = list(partition_folders(spark, path, partition_cols))
    staged = staging_path(path)
    write_table(df, staged, partition_cols, mode="overwrite", dynamic=False, **kw)
    new = list(partition_folders(spark, staged, partition_cols))
    commit(spark, path, staged, replace=new, remove=sorted(set(scope) - set(new)))


def snapshot_path(base: str, run_id: str) -> str:
    return f"{base.rstrip('/')}/run={run_id}"


def write_snapshot(df: DataFrame, base: str, run_id: str, partition_col: str,
                   fmt: str = "csv", **kw) -> str:
    """Dated snapshot: ``base/run=<run_id>/<partition_col>=<value>/`` (K1)."""
    path = snapshot_path(base, run_id)
    return write_table(df, path, [partition_col], mode="overwrite", fmt=fmt, **kw)


def write_snapshot_and_latest(df: DataFrame, base: str, latest: str, run_id: str,
                              partition_col: str, fmt: str = "csv", **kw) -> tuple[str, str]:
    """Dated snapshot plus the refreshed ``latest`` copy of the same rows (K1, K2).

    The upstream plan runs once: the dated snapshot is written from ``df``
    and ``latest`` is written from the snapshot files, so both copies hold
    identical rows (including any run timestamp) and the source is not
    scanned a second time. ``latest`` holds exactly the run's regions: they
    are swapped in, and the others removed, by one journal.
    """
    spark = df.sparkSession
    dated = write_snapshot(df, base, run_id, partition_col, fmt=fmt, **kw)
    r = spark.read.format(fmt)
    if fmt in ("csv", "json"):
        r = r.options(**TEXT_TIME_OPTIONS).schema(_with_string_partition(df, partition_col))
    if fmt == "csv":
        r = r.options(**SNAPSHOT_CSV)
    pinned = r.load(dated)
    replace_scope(pinned.select(*df.columns), latest, [partition_col], fmt=fmt, **kw)
    return dated, latest


def _with_string_partition(df: DataFrame, partition_col: str):
    from pyspark.sql import types as T
    fields = [f for f in df.schema.fields if f.name != partition_col]
    fields.append(T.StructField(partition_col, T.StringType(), True))
    return T.StructType(fields)


def publish_json(df: DataFrame, target: str, fmt: str = "text", options: dict | None = None,
                 cols: list[str] | None = None, partition_cols: list[str] | None = None) -> None:
    """Publish each row as one JSON message (K9).

    ``fmt="kafka"`` sends ``value`` (and ``key`` = the first partition
    column, when given) to the topic named in ``options`` (needs the Kafka
    connector on the classpath); ``fmt="text"`` writes one message per line
    below ``target``, in one folder per value of ``partition_cols`` (like a
    topic keyed by region), files sized by AQE.
    """
    from ..functions.values import to_json_value
    keys = list(partition_cols or [])
    msgs = df.select(to_json_value(cols).alias("value"), *keys)
    if fmt == "kafka":
        if keys:
            msgs = msgs.withColumn("key", F.col(keys[0]).cast("string")).drop(*keys)
        msgs.write.format("kafka").options(**(options or {})).save()
        return
    if keys:
        write_table(msgs, target, keys, mode="overwrite", fmt="text")
    else:
        msgs.write.mode("overwrite").format("text").options(**(options or {})).save(target)
