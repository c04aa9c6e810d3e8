"""Corrected rows of the bad side, loaded exactly once.

Every row a load sets aside has an id (``_row_id``). Corrected rows keep it:
``replay`` loads those whose id is on the bad side and not yet in the table's
ledger of settled ids, an anti-join. Rows that are still bad stay open. The
rows and the ledger become visible by one journal (see ``sinks.journal``), so
a replay that is repeated, or dies half way, loads nothing twice and loses
nothing.

A detail table gets the rows as new files. In a rolled-up table the touched
(region, chunk) partitions are merged with the new states and swapped in, so
the table still has one row per group.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.clean import BAD_REASON, RAW_TIME
from ..operators.lookup import with_lookups
from ..operators.rollup import reaggregate
from ..session import data_files, path_exists, shared_dir
from ..sinks.files import write_table
from ..sinks.journal import commit, partition_folders, recover, staging_path
from ..spec import TableSpec
from .ingest import ROW_ID, _spec_with_partition, bad_rows, partition_cols, prepare, read_ingested, read_table

LEDGER = "_replayed"


@dataclass(frozen=True)
class ReplayResult:
    """Corrected rows given, settled by this replay, settled by earlier ones, and still bad."""
    rows_given: int
    rows_settled: int
    rows_before: int
    rows_bad: int


def settled_rows(spark: SparkSession, table_path: str) -> DataFrame:
    """Ids of the bad rows that replays have settled."""
    path = f"{table_path.rstrip('/')}/{LEDGER}"
    if not path_exists(spark, path):
        return spark.createDataFrame([], f"{ROW_ID} string")
    return spark.read.schema(f"{ROW_ID} string").parquet(path)


def open_rows(spark: SparkSession, spec: TableSpec, table_path: str, quarantine_path: str) -> DataFrame:
    """The bad side without the rows that replays have settled."""
    parts = [spec.partition_col] if spec.partition_col else None
    bad = read_table(spark, quarantine_path, parts)
    return bad.join(settled_rows(spark, table_path), ROW_ID, "left_anti")


def replay(spark: SparkSession, spec: TableSpec, corrected: DataFrame, table_path: str, quarantine_path: str) -> ReplayResult:
    """Load corrected rows of ``quarantine_path`` (its columns, ``_row_id`` unchanged) into the table.

    A row outside the spec's intervals is settled without being loaded. Of
    several corrections of one row the smallest counts. Ids that the bad side
    does not hold are left out.
    """
    recover(spark, table_path)
    cells = [c for c in corrected.columns if c not in (ROW_ID, RAW_TIME, BAD_REASON)]
    one = corrected.groupBy(ROW_ID).agg(F.min(F.struct(*[F.col(f"`{c}`") for c in cells])).alias("row"))
    ids = spark.read.parquet(quarantine_path).select(ROW_ID)
    before = settled_rows(spark, table_path)
    known = one.join(ids, ROW_ID, "left_semi")
    fresh = (known.join(before, ROW_ID, "left_anti").select(ROW_ID, *[F.col(f"row.`{c}`") for c in cells]))
    shared_dir(spark)
    fresh = with_lookups(spark, fresh, spec.lookups).checkpoint()      # corrected rows are read for several writes
    still_bad = bad_rows(fresh, spec).select(ROW_ID)
    settled = fresh.select(ROW_ID).join(still_bad, ROW_ID, "left_anti")
    rows, _ = prepare(fresh.drop(ROW_ID), spec)

    staged, parts = staging_path(table_path), partition_cols(spec)
    replace: list[str] = []
    kw = dict(max_rows_per_file=spec.max_rows_per_file, sort_within=spec.indexed or None)
    if spec.rollup and path_exists(spark, table_path):
        full = _spec_with_partition(spec)
        rows = rows.checkpoint()
        # the touched partitions: folders, of which a table has few
        touched = [tuple(r) for r in rows.select(*parts).distinct().collect()]
        if touched:
            same = [F.struct(*[F.coalesce(F.col(f"`{p}`"), F.lit("")) for p in parts]).isin(
                *[F.struct(*[F.lit(v if v is not None else "") for v in t]) for t in touched])]
            chunks = F.col(f"`{parts[-1]}`").isin(*sorted({t[-1] for t in touched}))   # prunes folders
            old = read_ingested(spark, spec, table_path).where(chunks).where(*same)
            rows = reaggregate(rows.unionByName(old), full, keep=[parts[-1]])
    write_table(rows, f"{staged}/rows", parts, dynamic=False, **kw)
    settled.write.parquet(f"{staged}/ledger")
    n_settled = spark.read.parquet(f"{staged}/ledger").count()
    result = ReplayResult(one.count(), n_settled, known.join(before, ROW_ID, "left_semi").count(), still_bad.count())
    add = {f"ledger/{f}": f"{LEDGER}/{f}" for f in data_files(spark, f"{staged}/ledger")}
    if spec.rollup:
        replace = [f"rows/{f}" for f in partition_folders(spark, f"{staged}/rows", parts)]
    else:
        add |= {f"rows/{f}": f for f in data_files(spark, f"{staged}/rows")}
    commit(spark, table_path, staged, replace=replace, below="rows/", add=add)
    return result


__all__ = ["LEDGER", "ReplayResult", "open_rows", "replay", "settled_rows"]
