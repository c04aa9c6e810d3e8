"""Inventory (Q2) and load audit (Q3).

The inventory lists files with the ``binaryFile`` source reading only the
path and length columns (file contents are not read), so it is one
distributed listing plus one small aggregate. Region folders that hold no
matching file produce no file row; they are found by comparing with the
folder names under the base (a metadata listing) or a list the caller gives.

The audit is three aggregates — rows read, rows loaded, rows set aside, each
one row per region — joined on the region. Each side is tiny after its
aggregate, so the join costs nothing however large the load was.
``content_audit`` compares the cells too, by sums of row hashes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.values import region_from_path
from ..operators.lookup import with_lookups
from ..operators.rollup import N, state_columns
from ..session import list_dirs, make_dirs, path_exists
from ..sinks.files import CHUNK
from ..spec import TIME_COLUMN, TableSpec
from .ingest import _spec_with_partition, prepare, read_ingested, read_table


def list_region_folders(spark: SparkSession, base: str) -> list[str]:
    """Names of the region sub-folders of ``base`` (metadata only, on the driver)."""
    if not path_exists(spark, base):
        raise FileNotFoundError(base)
    return sorted(n.split("=", 1)[-1] for n in list_dirs(spark, base)
                  if not n.startswith(("_", ".")))


def inventory(spark: SparkSession, base: str, partition_col: str = "region",
              glob: str = "*.csv", expected: list[str] | None = None) -> DataFrame:
    """Files and bytes per region folder; empty region folders reported.

    Columns: ``partition_col``, ``n_files``, ``n_bytes``, ``has_files``.
    """
    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
             .load(f"{base.rstrip('/')}/*/")
             .select(region_from_path(F.col("path")).alias(partition_col), "length"))
    per = files.groupBy(partition_col).agg(F.count(F.lit(1)).alias("n_files"),
                                           F.sum("length").alias("n_bytes"))
    if expected is None:
        expected = list_region_folders(spark, base)
    exp = spark.createDataFrame([(e,) for e in expected], f"`{partition_col}` string")
    out = exp.join(per, partition_col, "full_outer")
    return (out.select(partition_col,
                       F.coalesce("n_files", F.lit(0)).cast("long").alias("n_files"),
                       F.coalesce("n_bytes", F.lit(0)).cast("long").alias("n_bytes"))
               .withColumn("has_files", F.col("n_files") > 0)
               .orderBy(partition_col))


def load_audit(rows_in: DataFrame, loaded: DataFrame, bad: DataFrame | None,
               partition_col: str = "region", count_col: str | None = "count") -> DataFrame:
    """Per region: rows read, loaded, set aside, and SUCCESS / FAILED / EMPTY.

    ``rows_in`` is either the raw frame (rows are counted) or the per-region
    ``counts`` an ingest kept (column ``rows_in``; its ``rows_outside`` are
    rows outside the intervals and count as accounted for). ``loaded`` is
    the written table read back: rows loaded is the sum of its ``count``
    metric for a rolled-up table. Status is SUCCESS when every row read is
    found loaded or set aside.
    """
    if "rows_in" in rows_in.columns:     # counts kept by the load itself
        a = rows_in.select(partition_col, "rows_in")
    else:
        a = rows_in.groupBy(partition_col).agg(F.count(F.lit(1)).alias("rows_in"))
    if count_col and count_col in loaded.columns:
        b = loaded.groupBy(partition_col).agg(F.sum(count_col).cast("long").alias("rows_loaded"))
    else:
        b = loaded.groupBy(partition_col).agg(F.count(F.lit(1)).alias("rows_loaded"))
    out = a.join(b, partition_col, "full_outer")
    if bad is not None:
        c = bad.groupBy(partition_col).agg(F.count(F.lit(1)).alias("rows_bad"))
        out = out.join(c, partition_col, "full_outer")
    else:
        out = out.withColumn("rows_bad", F.lit(0))
    z = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    if "rows_outside" in rows_in.columns:
        out = out.join(rows_in.select(partition_col, "rows_outside"), partition_col, "left")
    else:
        out = out.withColumn("rows_outside", F.lit(0))
    out = out.select(partition_col, z("rows_in"), z("rows_loaded"), z("rows_bad"),
                     z("rows_outside"))
    accounted = F.col("rows_loaded") + F.col("rows_bad") + F.col("rows_outside")
    status = (F.when(F.col("rows_in") == 0, F.lit("EMPTY"))
               .when(F.col("rows_in") == accounted, F.lit("SUCCESS"))
               .otherwise(F.lit("FAILED")))
    return out.withColumn("status", status).orderBy(partition_col)


def fingerprint(df: DataFrame, by: list[str], columns: list[str] | None = None) -> DataFrame:
    """Rows and content per group of ``by``: ``n_rows`` and two sums of row hashes, ``sum_a`` and ``sum_b``.

    The sums do not depend on the order or the partitions of the rows, and
    count repeated rows each: two sets of rows agree in all three exactly if
    they are the same multiset (but for a chance of about 2^-128). Nulls and
    places of cells count. One partial aggregation, a row per group and task
    is shuffled.
    """
    names = sorted(c for c in (columns or df.columns) if c not in by)
    cells = [x for c in names for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    total = lambda h: F.sum(h.cast("decimal(20,0)"))
    return df.groupBy(*[F.col(f"`{c}`") for c in by]).agg(
        F.count(F.lit(1)).alias("n_rows"), total(F.xxhash64(F.lit("a"), *cells)).alias("sum_a"),
        total(F.xxhash64(F.lit("b"), *cells)).alias("sum_b"))


def exact_columns(spec: TableSpec) -> list[str]:
    """Columns of a table of ``spec`` whose values do not depend on the order of the rows.

    Sketches and floating sums without ``scale`` are left out.
    """
    loose = {c for m in spec.metrics for c in state_columns(m)
             if m.type in ("hyperUnique", "thetaSketch", "quantilesDoublesSketch")
             or m.type in ("doubleSum", "doubleMean", "doubleAvg") and m.scale is None and c != m.name + N}
    full = _spec_with_partition(spec)
    states = [c for m in full.metrics for c in state_columns(m)]
    return [c for c in [TIME_COLUMN, *full.dim_names, *states, CHUNK] if c not in loose]


def content_audit(spark: SparkSession, spec: TableSpec, source: DataFrame, table_path: str,
                  quarantine_path: str | None = None) -> DataFrame:
    """Per region: does the table hold exactly what ``source`` gives by ``spec``, cell by cell (Q3)?

    What a load should have written is worked out again from the source and
    compared with the stored table by ``fingerprint``, the bad side likewise.
    Counts can match while cells are wrong, missing rows be made up for by
    repeated ones; then ``rows_match`` is true and ``content_match`` false,
    and the status FAILED. A rolled-up table is compared group by group.
    """
    source = with_lookups(spark, source, spec.lookups)
    by = [spec.partition_col] if spec.partition_col else []
    columns = exact_columns(spec)
    rows, bad = prepare(source, spec)
    sides = [("rows", rows, read_ingested(spark, spec, table_path), columns)]
    if quarantine_path:
        held = read_table(spark, quarantine_path, by)
        sides.append(("bad", bad, held, [c for c in bad.columns if c in held.columns]))
    out = None
    for name, want, have, cols in sides:
        w, h = fingerprint(want, by, cols).alias("w"), fingerprint(have, by, cols).alias("h")
        same = reduce(lambda a, b: a & b, [F.col(f"w.`{c}`").eqNullSafe(F.col(f"h.`{c}`")) for c in by], F.lit(True))
        n_w, n_h = (F.coalesce(F.col(f"{x}.n_rows"), F.lit(0)) for x in "wh")
        equal = reduce(lambda a, b: a & b, [F.col(f"w.{c}").eqNullSafe(F.col(f"h.{c}")) for c in ("sum_a", "sum_b")])
        side = w.join(h, same, "full_outer").select(
            *[F.coalesce(F.col(f"w.`{c}`"), F.col(f"h.`{c}`")).alias(c) for c in by], n_w.alias(f"{name}_expected"),
            n_h.alias(f"{name}_found"), equal.alias(f"{name}_equal"))
        if out is None:
            out = side
        else:
            a, b = out.alias("a"), side.alias("b")
            same = reduce(lambda x, y: x & y, [F.col(f"a.`{c}`").eqNullSafe(F.col(f"b.`{c}`")) for c in by], F.lit(True))
            keep = [F.coalesce(F.col(f"a.`{c}`"), F.col(f"b.`{c}`")).alias(c) for c in by]
            out = a.join(b, same, "full_outer").select(*keep, *[c for c in out.columns if c not in by], *[c for c in side.columns if c not in by])
    names = [name for name, *_ in sides]
    zero = {f"{n}_{k}": 0 for n in names for k in ("expected", "found")}
    out = out.fillna(zero).fillna({f"{n}_equal": True for n in names})
    all_of = lambda cols: reduce(lambda a, b: a & b, cols)
    out = out.withColumn("rows_match", all_of([F.col(f"{n}_expected") == F.col(f"{n}_found") for n in names]))
    out = out.withColumn("content_match", all_of([F.col(f"{n}_equal") for n in names])).drop(*[f"{n}_equal" for n in names])
    return out.withColumn("status", F.when(F.col("rows_match") & F.col("content_match"), F.lit("SUCCESS")).otherwise(F.lit("FAILED")))


def make_folder(spark: SparkSession, path: str) -> None:
    """Create an (empty) folder, e.g. a region announced before its files."""
    make_dirs(spark, path)


def compare_inventories(spark: SparkSession, raw_base: str, out_base: str,
                        partition_col: str = "region", raw_glob: str = "*.csv",
                        out_glob: str = "*") -> DataFrame:
    """Per region: has the raw input files, has the output files, and the
    status (``OK``, ``MISSING_OUTPUT`` for a raw region with no output,
    ``NO_INPUT`` for a region with output only, ``EMPTY`` for neither)."""
    raw = inventory(spark, raw_base, partition_col, raw_glob) \
        .select(partition_col, F.col("n_files").alias("raw_files"))
    out = inventory(spark, out_base, partition_col, out_glob) \
        .select(partition_col, F.col("n_files").alias("out_files"))
    j = raw.join(out, partition_col, "full_outer")
    r = F.coalesce(F.col("raw_files"), F.lit(0)) > 0
    o = F.coalesce(F.col("out_files"), F.lit(0)) > 0
    status = (F.when(r & o, F.lit("OK")).when(r, F.lit("MISSING_OUTPUT"))
               .when(o, F.lit("NO_INPUT")).otherwise(F.lit("EMPTY")))
    return j.select(partition_col, r.alias("raw_has_files"), o.alias("out_has_files"),
                    status.alias("status")).orderBy(partition_col)
