"""Declarative ingest job (Q4): source + time + dimensions + metrics + layout.

``prepare`` turns a raw frame into (rolled-up or detail rows, bad rows) as
one lazy plan: project → type → parse time → set bad rows aside → keep the
allowed intervals → roll up → label the time chunk. ``run_ingest`` writes it
as a table laid out by (region, chunk) and replaces only the partitions the
load touches, so re-loading one region leaves every other region alone.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.time import chunk_label, chunk_names, floor_time, interval_bounds
from ..operators.clean import (MALFORMED, RAW_TIME, coerce_dims, exclude, filter_intervals,
                               interval_predicate, keep_rows, project, split_bad,
                               with_event_time)
from ..operators.lookup import with_lookups
from ..operators.rollup import reaggregate, roll, rollup, state_aggs
from ..session import list_dirs, list_files, shared_dir
from ..sinks.files import CHUNK, append_table, replace_partitions, replace_scope, with_chunk, write_table
from ..sinks.journal import partition_folders, recover
from ..spec import TIME_COLUMN, Dim, TableSpec


@dataclass(frozen=True)
class IngestResult:
    """Where a load went, plus per-region row accounting when it was kept.

    ``counts`` (rollup loads) has one row per region: ``rows_in``,
    ``rows_loaded``, ``rows_bad`` and ``rows_outside`` (outside the
    intervals), taken from the load itself, not from a second read.
    """
    table: str
    quarantine: str | None
    partition_cols: tuple[str, ...]
    counts: DataFrame | None = None


def _spec_with_partition(spec: TableSpec) -> TableSpec:
    """The region column is a key of every row: add it as a dimension."""
    p = spec.partition_col
    if p and p not in spec.dim_names:
        return spec.with_(dimensions=spec.dimensions + (Dim(p),))
    return spec


def _typed(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Projected, typed rows with a nullable ``__time`` and the raw time text.

    A blank region counts as a missing one: both live in the same partition
    folder, so they must be one group.
    """
    spec = _spec_with_partition(spec)
    keep = [spec.partition_col] if spec.partition_col else []
    keep += [MALFORMED] if MALFORMED in df.columns else []
    typed = with_event_time(coerce_dims(project(df, spec, keep=keep), spec), spec).drop(MALFORMED)
    if spec.partition_col:
        p = F.col(f"`{spec.partition_col}`")
        typed = typed.withColumn(spec.partition_col, F.when(p.cast("string") != "", p))
    return typed


def _consumed(spec: TableSpec) -> list[str]:
    return [c for c in (spec.time_column, RAW_TIME, *spec.exclude) if c != TIME_COLUMN]


def bad_rows(df: DataFrame, spec: TableSpec) -> DataFrame:
    """The rows that cannot be loaded, with every source column as it was read.

    ``_raw_time`` and ``_bad_reason`` are added; nothing is typed or dropped,
    so a corrected row can be loaded again.
    """
    _, bad = split_bad(with_event_time(df, spec))
    return bad.drop(TIME_COLUMN)


def _timed(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Typed rows with a nullable ``__time``."""
    return exclude(_typed(df, spec), _consumed(spec))


BAD_ROWS = "bad_rows"
ROW_ID = "_row_id"


def with_row_id(bad: DataFrame) -> DataFrame:
    """Bad rows with an id of their own, unique over all loads, by which a corrected row is recognised (``replay``).

    A load's own id, a hash of the row and its place in the load: equal rows
    are told apart.
    """
    cells = [x for c in bad.columns for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    return bad.withColumn(ROW_ID, F.concat_ws("-", F.lit(uuid.uuid4().hex), F.hex(F.xxhash64(*cells)), F.hex(F.monotonically_increasing_id())))


def _text_time(df: DataFrame, spec: TableSpec) -> bool:
    return isinstance(df.schema[spec.time_column].dataType, T.StringType)


def _count_bad(timed: DataFrame, observation: Observation | None) -> DataFrame:
    """Count the bad rows (null ``__time``) as a side metric of the write."""
    if observation is None:
        return timed
    return timed.observe(observation, F.count_if(F.col(TIME_COLUMN).isNull()).alias(BAD_ROWS))


def no_bad_rows(observation: Observation | None) -> bool:
    """True only when the finished write reported zero bad rows.

    A plan Spark optimised down to nothing (an empty input) reports no
    metric at all; that counts as unknown, so the caller still writes the
    bad side (a read of nothing).
    """
    if observation is None:
        return False
    try:
        return observation.get.get(BAD_ROWS) == 0
    except Py4JJavaError:            # no metrics row: the observed node never ran
        return False


def clean(df: DataFrame, spec: TableSpec,
          observation: Observation | None = None) -> tuple[DataFrame, DataFrame]:
    """(typed rows with ``__time`` inside the intervals, bad rows), lazily.

    A time parsed from text is kept with ``keep_rows`` (parsed once per
    row); a typed time column is filtered normally, so the predicate is
    pushed into the scan. ``observation`` (text times only) counts the bad
    rows while the good ones are written.
    """
    timed, bad = _timed(_in_reach(df, spec), spec), bad_rows(df, spec)
    t = F.col(TIME_COLUMN)
    cond = t.isNotNull()
    if spec.intervals:
        cond = cond & interval_predicate(t, spec.intervals)
    if _text_time(df, spec):
        return keep_rows(_count_bad(timed, observation), cond), bad
    return timed.filter(cond), bad


def _in_reach(df: DataFrame, spec: TableSpec, nulls: bool = False) -> DataFrame:
    """Source rows whose typed time can lie inside the intervals.

    The test is on the source column itself, so it reaches the scan; rows
    without a time stay if they take a default or are to be counted
    (``nulls``). For a time parsed from text such a filter would make every
    row parse twice; there the rollup itself drops the others.
    """
    kind = df.schema[spec.time_column].dataType
    if not spec.intervals or not isinstance(kind, T.TimestampNTZType):
        return df
    raw = F.col(f"`{spec.time_column}`")
    inside = interval_predicate(raw, spec.intervals)
    return df.filter(raw.isNull() | inside if nulls or spec.missing_time is not None else inside)


def prepare(df: DataFrame, spec: TableSpec,
            observation: Observation | None = None) -> tuple[DataFrame, DataFrame]:
    """(table rows with ``chunk``, bad rows) for a raw frame, lazily.

    A rollup takes the rows with their nullable time straight into the
    aggregation (see ``rollup``), so each time text is parsed once.
    ``observation`` counts bad rows as the table is written (see ``clean``).
    """
    full = _spec_with_partition(spec)
    if spec.rollup:
        timed, bad = _timed(_in_reach(df, spec), spec), bad_rows(df, spec)
        rows = rollup(_count_bad(timed, observation), full, intervals=spec.intervals)
    else:
        good, bad = clean(df, spec, observation)
        rows = roll(good, full)
    return with_chunk(rows, TIME_COLUMN, spec.segment_granularity), bad


KEPT, BAD, N = "_kept", "_bad", "_n"


def rollup_with_rejects(df: DataFrame, spec: TableSpec, count_outside: bool = False) -> DataFrame:
    """One aggregation that yields the rolled-up rows *and* the load's accounts.

    Good rows are grouped by (bucket, dimensions) as usual; bad rows and rows
    outside the intervals fall in a null bucket and are only counted, by
    group. For a typed time the rows outside the intervals are not read
    unless ``count_outside`` asks for their number.
    """
    full = _spec_with_partition(spec)
    typed = _typed(df if count_outside else _in_reach(df, spec, nulls=True), spec)
    t = F.col(TIME_COLUMN)
    keep = t.isNotNull()
    if spec.intervals:
        keep = keep & interval_predicate(t, spec.intervals)
    keys = [F.when(keep, floor_time(t, spec.query_granularity)).alias(TIME_COLUMN)]
    keys += [F.col(f"`{d}`") for d in full.dim_names]
    aggs = [a for m in full.metrics for a in state_aggs(m)]
    return typed.groupBy(*keys).agg(*aggs, F.count_if(keep).alias(KEPT),
                                    F.count_if(t.isNull()).alias(BAD), F.count(F.lit(1)).alias(N))


def split_rollup(agg: DataFrame, spec: TableSpec,
                 outside_known: bool = True) -> tuple[DataFrame, DataFrame]:
    """(table rows with ``chunk``, per-region counts) from ``rollup_with_rejects``."""
    rows = agg.filter(F.col(KEPT) > 0).drop(KEPT, BAD, N)
    rows = with_chunk(rows, TIME_COLUMN, spec.segment_granularity)
    region = [spec.partition_col] if spec.partition_col else []
    counts = agg.groupBy(*region).agg(F.sum(N).alias("rows_in"), F.sum(KEPT).alias("rows_loaded"),
                                      F.sum(BAD).alias("rows_bad"))
    outside = F.col("rows_in") - F.col("rows_loaded") - F.col("rows_bad")
    return rows, counts.withColumn("rows_outside", outside if outside_known else F.lit(None).cast("long"))


def has_bad(agg: DataFrame) -> bool:
    """Whether a ``rollup_with_rejects`` (materialised) met a bad row."""
    return bool(agg.agg(F.sum(BAD)).first()[0])


def partition_cols(spec: TableSpec) -> list[str]:
    return ([spec.partition_col] if spec.partition_col else []) + [CHUNK]


def run_ingest(spark: SparkSession, spec: TableSpec, source: DataFrame, table_path: str,
               quarantine_path: str | None = None, mode: str = "replace",
               files_per_partition: int | None = None, keep_counts: bool = False,
               one_pass: bool = True, drop_existing: bool = False,
               regions: list[str] | None = None, count_outside: bool = False) -> IngestResult:
    """Load ``source`` into the table at ``table_path`` as ``spec`` says.

    ``mode="replace"`` replaces the (region, chunk) partitions present in
    this load (others stay); ``"append"`` adds rows. With ``drop_existing``
    a replacing load stands for its whole scope: partitions of ``regions``
    (all regions by default) whose chunk lies wholly inside the intervals
    (every chunk without intervals) and that the load did not write are
    removed with the swap of the new ones (``replace_scope``). A change that
    an earlier load of the table began and did not end is finished first. Bad rows go to
    ``quarantine_path`` (partitioned by region, all source columns) when it
    is given.

    A rollup load with a quarantine or ``keep_counts`` takes its accounts
    from the aggregation itself (``rollup_with_rejects``, checkpointed to
    the cluster's checkpoint folder); a detail load counts the bad rows of a
    text time while the table is written (an ``Observation``). Either way
    the bad rows are written by a second, filtered read, and only if there
    are any: a clean load is read once, and no number of equal bad rows
    gathers in a task. ``one_pass=False`` skips the accounts.
    """
    parts = partition_cols(spec)
    kw = dict(files_per_partition=files_per_partition, max_rows_per_file=spec.max_rows_per_file,
              sort_within=spec.indexed or None)
    if mode not in ("append", "replace"):
        raise ValueError(f"unknown mode {mode!r}")
    if regions and not spec.partition_col:
        raise ValueError("a load of some regions needs a partition column, or it would "
                         "replace the chunks of the others")
    recover(spark, table_path)
    source = with_lookups(spark, source, spec.lookups)
    counts = obs = None
    clean_load = False
    bad = bad_rows(source, spec)
    if spec.rollup and one_pass and (quarantine_path or keep_counts):
        shared_dir(spark)
        agg = rollup_with_rejects(source, spec, count_outside).checkpoint(eager=True)
        known = count_outside or _in_reach(source, spec) is source
        rows, counts = split_rollup(agg, spec, known)
        clean_load = not has_bad(agg)
    else:
        if quarantine_path and _text_time(source, spec):
            obs = Observation(f"chronoroll_bad_rows_{uuid.uuid4().hex}")
        rows, _ = prepare(source, spec, obs)
    if mode == "append":
        append_table(rows, table_path, parts, **kw)
    elif drop_existing:
        replace_scope(rows, table_path, parts, _scope(spark, spec, table_path, regions), **kw)
    else:
        replace_partitions(rows, table_path, parts, **kw)
    if quarantine_path:
        bad = with_row_id(bad)
        if clean_load or no_bad_rows(obs):
            # no bad row in this load: an empty quarantine, no second read
            # (a zero limit is planned as an empty relation). A task re-run
            # after an executor loss can only add to the count, never hide
            # a bad row, so zero is exact; an overcount just costs the read.
            bad = bad.limit(0)
        qparts = [spec.partition_col] if spec.partition_col else None
        write_table(bad, quarantine_path, qparts, mode="overwrite")
    return IngestResult(table_path, quarantine_path, tuple(parts), counts)


def _scope(spark: SparkSession, spec: TableSpec, path: str,
           regions: list[str] | None) -> list[str]:
    """Partition folders a load stands for, relative to the table (metadata only)."""
    bounds = None
    if spec.intervals:
        g = spec.segment_granularity
        cols = []
        for iv in spec.intervals:
            lo, hi = interval_bounds(iv)
            # a chunk that starts before the interval is not wholly inside
            first = F.when(floor_time(lo, g) == lo, F.lit(0)).otherwise(F.lit(1))
            cols.append(F.struct(chunk_label(lo, g), first, chunk_label(hi, g)))
        bounds = [tuple(b) for b in spark.range(1).select(F.array(*cols)).first()[0]]
    out = []
    for folder, values in partition_folders(spark, path, partition_cols(spec)).items():
        chunk = values[CHUNK]
        if regions is not None and values[spec.partition_col] not in regions:
            continue
        if bounds is None or any((chunk > lo or chunk == lo and not late) and chunk < hi
                                 for lo, late, hi in bounds):
            out.append(folder)
    return out


def read_table(spark: SparkSession, path: str, string_partitions: list[str] | None = None,
               schema: T.StructType | None = None) -> DataFrame:
    """Read a table written by this library.

    Partition folder values such as ``2024-01-01`` would be inferred as
    dates; the named partition columns are read back as text, as written.
    With ``schema`` the files are listed once and none is opened for it.
    Without one the columns are those of all loads together (Spark merges
    the files' schemas in parallel tasks): a column that a later load added
    is null in the rows of earlier ones.
    """
    text = set(string_partitions or [])
    if schema is None:
        merged = spark.read.option("mergeSchema", "true").parquet(path)
        if not text:
            return merged
        schema = merged.schema
    fields = [T.StructField(f.name, T.StringType(), True) if f.name in text else f for f in schema.fields]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def table_schema(spark: SparkSession, spec: TableSpec) -> T.StructType:
    """The columns a load of ``spec`` writes, partition columns last."""
    full = _spec_with_partition(spec)
    inputs = [*full.input_names, *[x.name for x in full.lookups]]
    none = spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in inputs]))
    written = prepare(none, spec)[0].schema
    parts = partition_cols(spec)
    return T.StructType([f for f in written if f.name not in parts] + [written[p] for p in parts])


def a_partition(spark: SparkSession, path: str) -> str:
    """A partition folder that holds files (the table itself if there is none)."""
    def first(folder: str) -> str | None:
        if any(not n.startswith(("_", ".")) for n in list_files(spark, folder)):
            return folder
        names = (n for n in list_dirs(spark, folder) if "=" in n)
        return next((f for f in (first(f"{folder}/{n}") for n in names) if f), None)
    return first(path.rstrip("/")) or path


def read_ingested(spark: SparkSession, spec: TableSpec, path: str) -> DataFrame:
    """The table with the columns of ``spec``: null where an earlier load had no such column."""
    return read_table(spark, path, partition_cols(spec), table_schema(spark, spec))


#: Chunks of a range that are listed by name; the folders of a longer range are listed whole and pruned.
MOST_CHUNKS = 10_000


def read_range(spark: SparkSession, spec: TableSpec, path: str, intervals) -> DataFrame:
    """Rows of an ingested table inside ``lo/hi`` intervals, partition-pruned.

    The chunks that can hold such rows are worked out from the intervals and
    only their folders are listed; the range of their labels is a condition
    too (``PartitionFilters``), since a filter on ``__time`` alone prunes no
    folder. A range without chunks gives no rows.
    """
    names = chunk_names(spark, intervals, spec.segment_granularity, MOST_CHUNKS) if intervals else None
    if names is None:
        table = read_ingested(spark, spec, path)
    else:
        region = f"{spec.partition_col}=*/" if spec.partition_col else ""
        schema = table_schema(spark, spec)
        fields = [T.StructField(f.name, T.StringType(), True) if f.name in partition_cols(spec) else f for f in schema]
        reader = spark.read.schema(T.StructType(fields)).option("basePath", path)
        try:
            table = reader.parquet(f"{path.rstrip('/')}/{region}{CHUNK}={{{','.join(names)}}}")
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            table = spark.createDataFrame([], T.StructType(fields))
    return filter_intervals(table, intervals, TIME_COLUMN, CHUNK, spec.segment_granularity)
