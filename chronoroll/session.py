"""Session helpers: a tuned SparkSession and the shared scratch location.

Everything that has to be materialised between stages (CSV edge files made
from the driver tables, snapshots, stream checkpoints) goes below the folder
the cluster names in ``spark.checkpoint.dir``. That folder is shared storage
on a real cluster; we never fall back to a machine-local temp folder unless
the setting is absent (local tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from urllib.parse import unquote, urlsplit

from pyspark.sql import SparkSession


def build_session(app: str = "chronoroll", master: str | None = None,
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Return a session with the settings this library assumes.

    UTC session zone (the reference runs every service in UTC), AQE with
    partition coalescing and skew-join splitting, Arrow for pandas transfer,
    and dynamic partition overwrite so ``mode("overwrite")`` on a partitioned
    table replaces only the partitions present in the written data. Spent
    checkpoints are cleaned up from the shared checkpoint folder.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        # checkpointed aggregates (one-pass loads, compaction) are deleted
        # from the shared folder once no plan on the driver refers to them
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scale_conf(total_cores: int, advisory_mb: int = 256) -> dict[str, str]:
    """Settings for a large cluster (tens of TB per load), to pass as ``extra``.

    - scan splits of 256 MiB and AQE target partitions of ``advisory_mb``:
      about 400k scan tasks per 100 TB, shuffle partitions sized by bytes;
    - initial shuffle partitions = 4 × cores, coalesced or split by AQE (a
      skewed rebalance partition is split by map-output ranges);
    - zstd Parquet output; RocksDB state store for windowed streams, whose
      state lives off the JVM heap and is checkpointed incrementally.
    """
    return {
        "spark.sql.files.maxPartitionBytes": "256m",
        "spark.sql.shuffle.partitions": str(4 * total_cores),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(4 * total_cores),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{advisory_mb}m",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": f"{4 * advisory_mb}m",
        "spark.sql.parquet.compression.codec": "zstd",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (set one only when none is set)."""
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if not d:
        d = spark.conf.get("spark.checkpoint.dir", None)
        if not d:
            # no cluster folder is named: only a local run may use its own
            if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that the driver "
                                   "and all executors share")
            d = tempfile.mkdtemp(prefix="chronoroll-ckpt-")
        sc.setCheckpointDir(d)
        d = sc.getCheckpointDir() or d
    return d


_scopes: list[list[str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder path of the shared folder (not created)."""
    base = shared_dir(spark)
    path = _join(base, f"chronoroll/{name}-{uuid.uuid4().hex[:12]}")
    if _scopes:
        _scopes[-1].append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession):
    """Delete, at its end, the scratch folders that were named inside the ``with`` block.

    Results that read them must be written or collected before the end.
    """
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            delete_path(spark, path)


def _join(base: str, rel: str) -> str:
    if "://" in base:
        return base.rstrip("/") + "/" + rel
    return os.path.join(base, rel)


# ---- file-system metadata (driver side, no data read): Hadoop FileSystem, so
# ---- the same calls work on local disk, HDFS and object stores

def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def make_dirs(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.mkdirs(p)


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the sub-folders of ``path`` (empty if it does not exist)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory())


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the files right below ``path`` (empty if it does not exist)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(st.getPath().getName() for st in fs.listStatus(p) if st.isFile())


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def delete_paths(spark: SparkSession, paths: list[str], threads: int = 16) -> None:
    """Delete many files or folders, several calls to the file system at a time."""
    with ThreadPoolExecutor(threads) as pool:
        list(pool.map(lambda p: delete_path(spark, p), paths))


def move_path(spark: SparkSession, src: str, dst: str) -> None:
    """Rename a file or folder; the folder above ``dst`` is created, ``dst`` must not exist."""
    fs, p = _fs(spark, src)
    _, q = _fs(spark, dst)
    fs.mkdirs(q.getParent())
    if not fs.rename(p, q):
        raise OSError(f"could not move {src} to {dst}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def data_files(spark: SparkSession, path: str) -> list[str]:
    """Files below ``path``, relative to it (empty if it does not exist); names with ``_`` or ``.`` in front are skipped.

    Spark lists them, in parallel tasks where there are many folders.
    """
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    base = fs.makeQualified(p).toUri().getPath().rstrip("/") + "/"
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).inputFiles()
    return sorted(unquote(urlsplit(f).path).removeprefix(base) for f in listed)


def content_bytes(spark: SparkSession, path: str) -> int:
    """Total bytes of the files below ``path`` (file-system metadata)."""
    fs, p = _fs(spark, path)
    return int(fs.getContentSummary(p).getLength())
