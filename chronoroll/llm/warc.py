"""WARC files and a Merkle fixity audit of their replicas.

Records are written as plain WARC/1.0 files and read back in parallel, split
at record borders. Every record is hashed; the records of a range of
``RANGE`` bytes of a file, in the order of their offsets, give the hash of
the range, ``FANOUT`` neighbouring ranges the hash of the next larger one, up
to the root of the file. An audit compares the roots of two replicas and
descends only into ranges whose hashes differ, down to the records. Hashes
above the records are bounded by the fan-out, so no file is gathered whole.

A record that a replica holds with other bytes is ``changed``, one that it
lacks is ``missing``, one that only it holds is ``extra``, and one that is
shorter or longer than its header says is ``torn``. Records behind a missing
one stand at other offsets; they are visited, found equal and not reported.

Defined cases: a null payload is an empty one; records that repeat an id are
told apart by their order in the file; a file that a replica lacks misses all
its records; an empty archive has no roots, and two of them agree; a payload
that itself holds a record border (an empty line and ``WARC/1.0``) is read as
two records, both torn.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from . import words as W

RANGE, FANOUT = 1 << 16, 16
# ---- fixed values of the format
VERSION, END = "WARC/1.0\r\n", "\r\n\r\n"
BORDER = END + VERSION


def record(record_id: Column, uri: Column, payload: Column) -> Column:
    """The text of a ``resource`` record, without the empty lines that end it."""
    body = F.coalesce(payload, F.lit(""))
    return F.concat(F.lit(VERSION), F.lit("WARC-Type: resource\r\nWARC-Record-ID: <"), record_id,
                    F.lit(">\r\nWARC-Target-URI: "), F.coalesce(F.regexp_replace(uri, r"[\r\n]", " "), F.lit("")),
                    F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(body).cast("string"),
                    F.lit(END), body)


def write(records: DataFrame, path: str, *, gather: bool = True, compression: str = "none") -> str:
    """Write (file, order, record) rows as one WARC file each value of ``file``.

    Without ``gather`` the rows of a file must already be in one partition, as
    those of a split of a table are: nothing is shuffled then. ``compression``
    (``gzip``) packs a whole file; offsets are those of the unpacked bytes.
    """
    rows = records.repartition("file") if gather else records
    (rows.sortWithinPartitions("file", "order").select("record", "file")
     .write.partitionBy("file").option("lineSep", END).option("compression", compression).text(path))
    return path


def read(spark: SparkSession, path: str) -> DataFrame:
    """(file, offset, length, record_id, uri, digest, torn) of every record below ``path``.

    Offsets are sums over blocks of a file first and over the records of a
    block then, so a file of any size is read by many tasks.
    """
    lines = (spark.read.option("lineSep", BORDER).text(path)
             .select("value", "file", F.col("_metadata.file_path").alias("part"), F.col("_metadata.file_block_start").alias("block"))
             .withColumn("seq", F.monotonically_increasing_id()))
    # the first piece of a file still has its version line, the last one its end
    rows = lines.withColumn("t", F.regexp_replace("value", "^WARC/1\\.0\r\n", ""))
    head = F.substring_index("t", END, 1)
    field = lambda name: F.regexp_extract(head, rf"(?m)^{name}: ?<?([^>\r\n]*)>?\r?$", 1)
    over = (F.octet_length("t") - F.octet_length(head) - len(END) - field("Content-Length").try_cast("long")).cast("long")
    last = F.col("over").eqNullSafe(F.lit(len(END)).cast("long")) & F.col("t").endswith(END)
    rows = rows.withColumn("over", over).withColumn("last", last)
    rows = rows.withColumn("t", F.when(F.col("last"), F.substr("t", F.lit(1), F.length("t") - len(END))).otherwise(F.col("t")))
    rows = rows.select(
        F.col("file").cast("string").alias("file"), "part", "block", "seq",
        (F.octet_length("t") + len(VERSION)).cast("long").alias("length"), field("WARC-Record-ID").alias("record_id"),
        field("WARC-Target-URI").alias("uri"), F.sha2(F.col("t").cast("binary"), 256).alias("digest"),
        (~F.col("last") & ~F.col("over").eqNullSafe(F.lit(0).cast("long"))).alias("torn"))
    step = F.col("length") + len(END)
    sizes = rows.groupBy("part", "block").agg(F.sum(step).alias("size"))
    ahead = F.sum("size").over(Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("part", "block", F.coalesce(ahead, F.lit(0)).alias("start"))
    local = F.sum(step).over(Window.partitionBy("part", "block").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1))
    return (rows.withColumn("local", F.coalesce(local, F.lit(0))).join(starts, ["part", "block"])
            .select("file", (F.col("start") + F.col("local")).alias("offset"), "length", "record_id", "uri", "digest", "torn"))


def tree(records: DataFrame, levels: int, path: str) -> DataFrame:
    """Hashes (level, file, k, digest) of the offset ranges, written by level below ``path``."""
    def node(level: int, start: Column, below: DataFrame) -> DataFrame:
        own = F.sort_array(F.collect_list(F.struct(start.alias("at"), "digest")))
        return (below.groupBy("file", F.floor(start / (RANGE if level == 1 else FANOUT)).cast("long").alias("k"))
                .agg(F.sha2(F.array_join(F.transform(own, lambda x: F.concat(x["at"].cast("string"), F.lit(":"), x["digest"])), ",")
                            .cast("binary"), 256).alias("digest")))

    spark = records.sparkSession
    below = records.select("file", F.col("offset"), "digest")
    for level in range(1, levels + 1):
        node(level, F.col("offset" if level == 1 else "k"), below).write.parquet(f"{path}/level={level}")
        below = spark.read.parquet(f"{path}/level={level}")
    return spark.read.parquet(path)


def audit(first: DataFrame, second: DataFrame) -> DataFrame:
    """(file, record_id, uri, status, offset) of the records of ``first`` (the reference replica) that ``second``
    lacks or holds otherwise, of those only ``second`` has, and of torn ones. Both as ``read`` gives them."""
    spark = first.sparkSession
    kept = []
    for name, df in (("first", first), ("second", second)):
        path = scratch_path(spark, f"warc-{name}")
        df.write.parquet(path)
        kept.append(spark.read.parquet(path))
    size = max((r[0] or 0) for df in kept for r in df.agg(F.max("offset")).collect())
    levels = 1
    while size >= RANGE * FANOUT ** (levels - 1):
        levels += 1
    trees = [tree(df, levels, scratch_path(spark, "warc-tree")) for df in kept]
    suspects = None
    for level in range(levels, 0, -1):
        a, b = (t.where(F.col("level") == level).select("file", "k", "digest") for t in trees)
        if suspects is not None:
            parents = suspects.select("file", F.col("k").alias("up"))
            a, b = (x.withColumn("up", F.floor(F.col("k") / FANOUT).cast("long")).join(parents, ["file", "up"], "left_semi").drop("up")
                    for x in (a, b))
        both = a.join(b.withColumnRenamed("digest", "other"), ["file", "k"], "full_outer")
        suspects = W.checkpointed(both.where(~F.col("digest").eqNullSafe(F.col("other"))).select("file", "k"))
    ranges = suspects.withColumnRenamed("k", "range")
    nth = F.row_number().over(Window.partitionBy("file", "record_id").orderBy("offset"))
    a, b = (df.withColumn("range", F.floor(F.col("offset") / RANGE).cast("long")).join(ranges, ["file", "range"], "left_semi")
            .drop("range").withColumn("nth", nth) for df in kept)
    x, y = a.alias("x"), b.alias("y")
    met = x.join(y, [F.col(f"x.{c}") == F.col(f"y.{c}") for c in ("file", "record_id", "nth")], "full_outer")
    pick = lambda c: F.coalesce(F.col(f"x.{c}"), F.col(f"y.{c}")).alias(c)
    status = (F.when(F.col("y.digest").isNull(), "missing").when(F.col("x.digest").isNull(), "extra")
              .when(F.col("y.torn"), "torn").when(F.col("x.digest") != F.col("y.digest"), "changed"))
    return (met.select(pick("file"), pick("record_id"), pick("uri"), status.alias("status"), pick("offset"))
            .where(F.col("status").isNotNull()))
