"""Row shaping and row quality: projection, typing, time, intervals, bad rows.

All operators are lazy ``DataFrame → DataFrame`` functions made of built-in
expressions, so Catalyst pushes the filters and the column list into the
scan and keeps the whole chain in one code-generated stage.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.time import (chunk_label, event_time, instant_to_ntz, interval_bounds,
                              is_blank, ntz_literal)
from ..functions.values import coerce, parse_json
from ..spec import TIME_COLUMN, TableSpec

RAW_TIME = "_raw_time"
BAD_REASON = "_bad_reason"
MALFORMED = "_malformed"        # the text of a record that could not be parsed, else null


def project(df: DataFrame, spec: TableSpec, keep: list[str] | None = None) -> DataFrame:
    """Keep the time column, the listed dimensions and metric inputs.

    A listed dimension or metric input that the input does not have (a file
    with fewer columns) is added as null, so every row has the table's shape.
    """
    wanted: list[str] = []
    for c in ([spec.time_column] + spec.dim_names
              + [m.field for m in spec.metrics if m.field] + (keep or [])):
        if c not in wanted:
            wanted.append(c)
    if spec.time_column not in df.columns:
        raise ValueError(f"time column {spec.time_column!r} is not in the input")
    return df.select(*[F.col(f"`{c}`") if c in df.columns
                       else F.lit(None).cast("string").alias(c) for c in wanted])


def parsed_messages(df: DataFrame, ddl: str, value: str = "value",
                    keep: list[str] | None = None) -> DataFrame:
    """JSON messages as typed columns plus ``_malformed``.

    ``_malformed`` is the text of a message that is no JSON object (empty text
    for a missing one) and null for all others: a record of nulls is a record,
    garbage is not.
    """
    m = df.select(*(keep or []), F.col(value), parse_json(value, ddl, MALFORMED).alias("_m"))
    broken = F.when(F.col("_m").isNull(), F.coalesce(F.col(value), F.lit(""))) \
              .otherwise(F.col(f"_m.{MALFORMED}"))
    fields = [f.name for f in m.schema["_m"].dataType.fields if f.name != MALFORMED]
    return m.select(*(keep or []), *[F.col(f"_m.`{f}`") for f in fields], broken.alias(MALFORMED))


def exclude(df: DataFrame, columns: list[str] | tuple[str, ...]) -> DataFrame:
    """Drop the named columns, e.g. the time text once it is parsed."""
    return df.drop(*columns)


def coerce_dims(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Cast every declared dimension to its type; bad text → null."""
    types = {d.name: d.type for d in spec.dimensions}
    return df.select(*[coerce(F.col(f"`{c}`"), types[c]).alias(c) if c in types
                       else F.col(f"`{c}`") for c in df.columns])


def coerce_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast the named columns to spec types; bad text → null."""
    return df.select(*[coerce(F.col(f"`{c}`"), types[c]).alias(c) if c in types
                       else F.col(f"`{c}`") for c in df.columns])


def rename_positional(df: DataFrame, names: list[str]) -> DataFrame:
    """Give the columns new names by position (P4); arity must match."""
    if len(names) != len(df.columns):
        raise ValueError(f"{len(names)} names for {len(df.columns)} columns")
    return df.toDF(*names)


def tag(df: DataFrame, name: str, value) -> DataFrame:
    """Constant column, e.g. the region of a single-region load (P5)."""
    return df.withColumn(name, F.lit(value))


def stamp(df: DataFrame, name: str = "processing_ts",
          run_ts: _dt.datetime | str | None = None) -> DataFrame:
    """Processing-time column pinned once per run.

    The value is taken on the driver once and put in the plan as a literal,
    so every action, every retry and every copy written from this frame
    carries the same timestamp.
    """
    if run_ts is None:
        run_ts = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    return df.withColumn(name, ntz_literal(run_ts))


def with_expr(df: DataFrame, name: str, sql_expr: str) -> DataFrame:
    """``SELECT *, <expr> AS name``."""
    return df.selectExpr("*", f"{sql_expr} AS `{name}`")


def interval_predicate(time_col: Column | str, intervals, chunk_col: str | None = None,
                       chunk_granularity: str | None = None) -> Column:
    """OR of ``lo <= t < hi`` over ``lo/hi`` intervals (end-exclusive).

    With ``chunk_col`` the matching chunk-label range is added too, so a
    table laid out by chunk is pruned to the folders that can hold rows.
    """
    t = F.col(time_col) if isinstance(time_col, str) else time_col
    preds = []
    for iv in intervals:
        lo, hi = interval_bounds(iv)
        p = (t >= lo) & (t < hi)
        if chunk_col and chunk_granularity:
            p = p & (F.col(chunk_col) >= chunk_label(lo, chunk_granularity)) \
                  & (F.col(chunk_col) <= chunk_label(hi, chunk_granularity))
        preds.append(p)
    return reduce(lambda a, b: a | b, preds)


def filter_intervals(df: DataFrame, intervals, time_col: str = TIME_COLUMN,
                     chunk_col: str | None = None, chunk_granularity: str | None = None) -> DataFrame:
    """Keep rows inside the allowed intervals; ``None`` keeps all."""
    if not intervals:
        return df
    return df.filter(interval_predicate(time_col, intervals, chunk_col, chunk_granularity))


def filter_partition(df: DataFrame, partition_col: str, value) -> DataFrame:
    """Restrict to one region; on a partitioned table this prunes folders."""
    if isinstance(value, (list, tuple, set)):
        return df.filter(F.col(partition_col).isin(list(value)))
    return df.filter(F.col(partition_col) == F.lit(value))


def with_event_time(df: DataFrame, spec: TableSpec, keep_raw: bool = True) -> DataFrame:
    """Add ``__time`` parsed from the spec's time column.

    Null or empty time text takes ``spec.missing_time`` when the spec has
    one; text that does not parse stays null (see ``split_bad``). A record
    marked as malformed has no time at all, so no default either.
    """
    raw = F.col(f"`{spec.time_column}`")
    kind = df.schema[spec.time_column].dataType.typeName()
    if kind in ("timestamp_ntz", "timestamp", "date"):
        # already typed (Parquet, JDBC): no text to parse, only a default to
        # apply; an instant (``timestamp``) becomes its UTC wall clock
        t = instant_to_ntz(raw) if kind == "timestamp" else raw.cast("timestamp_ntz")
        if spec.missing_time is not None:
            t = F.coalesce(t, ntz_literal(spec.missing_time))
    else:
        t = event_time(raw, spec.time_format, spec.missing_time)
    if MALFORMED in df.columns:
        t = F.when(F.col(MALFORMED).isNull(), t)
    out = df.withColumn(TIME_COLUMN, t)
    if keep_raw:
        out = out.withColumn(RAW_TIME, raw.cast("string"))
    return out


def bad_reason(raw_time: str = RAW_TIME, parsed: str = TIME_COLUMN,
               malformed: bool = False) -> Column:
    """Why a row cannot be loaded, or null when it can."""
    first = F.when(F.col(MALFORMED).isNotNull(), F.lit("malformed record")) if malformed else F
    return (first.when(is_blank(raw_time) & F.col(parsed).isNull(), F.lit("missing time"))
             .when(F.col(parsed).isNull(), F.lit("unparseable time")))


def split_bad(df: DataFrame, raw_time: str = RAW_TIME,
              parsed: str = TIME_COLUMN) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad rows with ``_bad_reason``) instead of failing.

    Both sides are lazy views of one plan; write the good side and the bad
    side from it, or checkpoint the input first when the source is costly
    to read twice.
    """
    # a row is bad exactly when its parsed time is null; the reason is only
    # worked out on the (small) bad side
    good = df.filter(F.col(parsed).isNotNull())
    bad = df.filter(F.col(parsed).isNull()).withColumn(
        BAD_REASON, bad_reason(raw_time, parsed, MALFORMED in df.columns))
    return good, bad


def keep_rows(df: DataFrame, cond: Column) -> DataFrame:
    """``df.filter(cond)``, evaluating the columns of ``df`` once.

    When ``cond`` reads a column computed by an expensive expression just
    below (a time parsed from text), Catalyst pushes a filter beneath that
    projection and evaluates the expression twice: once in the filter, once
    in the projection. A row emitted through a one-element ``explode`` (null
    array = no row) cannot be pushed below, so the expression runs once; the
    generator stays inside whole-stage code generation. For predicates on
    plain scan columns use ``filter``: those should reach the scan.
    """
    cols = df.columns
    packed = F.array(F.struct(*[F.col(f"`{c}`") for c in cols]))
    rows = df.select(F.explode(F.when(cond, packed)).alias("_row"))
    return rows.select(*[F.col(f"_row.`{c}`").alias(c) for c in cols])


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """First ``n`` rows for a look at the data."""
    return df.limit(n)
