"""Rollup: group rows by (time bucket, dimensions) and compute metrics.

Every metric is stored as a *mergeable state*: counts and sums as numbers,
a mean as (sum, count), distinct counts as sketches. A rolled-up table can
therefore be rolled up again — to a coarser bucket, over fewer dimensions,
or across partial results of several loads or micro-batches — with exactly
the answer a direct rollup of the raw rows would give (``reaggregate``).
A stored average could not be merged; a stored (sum, count) can.

All metric states are built-in aggregate functions with partial
(map-side) aggregation, so a hot group is pre-aggregated in every task
before the shuffle; only one partial row per group and task moves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.time import floor_time
from ..functions.values import exact_long
from ..spec import TIME_COLUMN, Metric, TableSpec

UNITS = "__units"
SUM = "__sum"
N = "__n"


def _f(m: Metric) -> Column:
    return F.col(f"`{m.field}`")


def metric_input(m: Metric) -> Column:
    """The metric's input column as a number; text that is no number → null."""
    x = _f(m)
    if m.type in ("longSum", "longMin", "longMax"):
        return exact_long(x)
    if m.type in ("doubleSum", "doubleMean", "doubleAvg", "doubleMin", "doubleMax",
                  "quantilesDoublesSketch", "fixedBucketsHistogram"):
        return x.try_cast("double")
    return x


def _bin(m: Metric, x: Column) -> Column:
    """Place of a value in the bin array: below, the bins, at or above, missing."""
    inside = (F.floor((x - F.lit(m.lower)) * F.lit(m.bins) / F.lit(m.upper - m.lower)) + 1).cast("int")
    return (F.when(x.isNull() | F.isnan(x), F.lit(m.bins + 2)).when(x < F.lit(m.lower), F.lit(0))
             .when(x >= F.lit(m.upper), F.lit(m.bins + 1)).otherwise(F.least(inside, F.lit(m.bins))))


def _units(m: Metric, x: Column) -> Column:
    """Fixed-point integer units of a value (10**-scale each)."""
    # NaN, Infinity and values beyond 64 bits count as no value
    return F.round(x * F.lit(float(10 ** m.scale))).try_cast("long")


def state_columns(m: Metric) -> list[str]:
    t = m.type
    if t in ("doubleMean", "doubleAvg"):
        return [m.name + (UNITS if m.scale is not None else SUM), m.name + N]
    if t == "doubleSum" and m.scale is not None:
        return [m.name + UNITS]
    return [m.name]


def state_aggs(m: Metric) -> list[Column]:
    """Aggregate expressions that build the stored state of a metric."""
    t = m.type
    if t == "count":
        return [F.count(F.lit(1)).alias(m.name)]
    x = metric_input(m)
    if t == "longSum":
        return [F.sum(x).alias(m.name)]
    if t == "doubleSum":
        if m.scale is not None:
            return [F.sum(_units(m, x)).alias(m.name + UNITS)]
        return [F.sum(x).alias(m.name)]
    if t in ("doubleMean", "doubleAvg"):
        s = F.sum(_units(m, x)).alias(m.name + UNITS) if m.scale is not None \
            else F.sum(x).alias(m.name + SUM)
        return [s, F.count(_units(m, x) if m.scale is not None else x).alias(m.name + N)]
    if t.endswith("Min"):
        return [F.min(x).alias(m.name)]
    if t.endswith("Max"):
        return [F.max(x).alias(m.name)]
    if t == "hyperUnique":
        return [F.hll_sketch_agg(x, m.lg_k).alias(m.name)]
    if t == "thetaSketch":
        return [F.theta_sketch_agg(x, m.lg_k).alias(m.name)]
    if t == "quantilesDoublesSketch":
        return [F.kll_sketch_agg_double(x).alias(m.name)]
    if t == "fixedBucketsHistogram":
        at = _bin(m, x)
        return [F.array(*[F.count_if(at == k) for k in range(m.bins + 3)]).alias(m.name)]
    raise ValueError(t)


def row_states(m: Metric) -> list[Column]:
    """The stored state of a metric for one row (detail tables)."""
    x = metric_input(m)
    if m.type in ("doubleSum", "doubleMean", "doubleAvg"):
        v = _units(m, x) if m.scale is not None else x
        state = [v.alias(state_columns(m)[0])]
        return state if m.type == "doubleSum" else [*state, v.isNotNull().cast("long").alias(m.name + N)]
    if m.type in ("hyperUnique", "thetaSketch", "quantilesDoublesSketch"):
        raise ValueError(f"metric {m.name!r} ({m.type}) needs a rollup")
    if m.type == "fixedBucketsHistogram":
        at = _bin(m, x)
        return [F.array(*[(at == k).cast("long") for k in range(m.bins + 3)]).alias(m.name)]
    return [x.alias(m.name)]


def merge_aggs(m: Metric) -> list[Column]:
    """Aggregate expressions that merge stored states of a metric."""
    t = m.type
    if t in ("count", "longSum", "doubleSum", "doubleMean", "doubleAvg"):
        return [F.sum(F.col(c)).alias(c) for c in state_columns(m)]
    if t.endswith("Min"):
        return [F.min(m.name).alias(m.name)]
    if t.endswith("Max"):
        return [F.max(m.name).alias(m.name)]
    if t == "hyperUnique":
        return [F.hll_union_agg(m.name, True).alias(m.name)]
    if t == "thetaSketch":
        return [F.theta_union_agg(m.name, m.lg_k).alias(m.name)]
    if t == "quantilesDoublesSketch":
        return [F.kll_merge_agg_double(m.name).alias(m.name)]
    if t == "fixedBucketsHistogram":
        return [F.array(*[F.sum(F.get(m.name, k)) for k in range(m.bins + 3)]).alias(m.name)]
    raise ValueError(t)


def finish_expr(m: Metric) -> Column:
    """Final value of a metric from its stored state."""
    t = m.type
    if t == "doubleSum" and m.scale is not None:
        return (F.col(m.name + UNITS).cast("double") / F.lit(float(10 ** m.scale))).alias(m.name)
    if t in ("doubleMean", "doubleAvg"):
        n = F.col(m.name + N)
        if m.scale is not None:
            s = F.col(m.name + UNITS).cast("double") / F.lit(float(10 ** m.scale))
        else:
            s = F.col(m.name + SUM)
        return F.when(n > 0, s / n.cast("double")).alias(m.name)
    if t == "hyperUnique":
        return F.hll_sketch_estimate(m.name).alias(m.name)
    if t == "thetaSketch":
        return F.theta_sketch_estimate(m.name).alias(m.name)
    return F.col(m.name)


def bucket(df: DataFrame, granularity: str, time_col: str = TIME_COLUMN) -> DataFrame:
    """Floor the time column to its bucket (query granularity, F7)."""
    return df.withColumn(TIME_COLUMN, floor_time(time_col, granularity))


def rollup(df: DataFrame, spec: TableSpec, time_col: str = TIME_COLUMN,
           intervals=None) -> DataFrame:
    """Group by (bucket, all dimensions) and store metric states (A1–A5).

    Rows whose time is null, or outside ``intervals`` when given, are left
    out. That test is made inside the aggregation (such rows fall in a null
    bucket that is dropped afterwards) rather than by a filter before it:
    Catalyst would push such a filter below the projection that parses the
    time text and so parse every row twice. Null dimension values form
    their own group, as in the reference.
    """
    t = F.col(time_col)
    keep = t.isNotNull()
    if intervals:
        from .clean import interval_predicate
        keep = keep & interval_predicate(t, intervals)
    keys = [F.when(keep, floor_time(t, spec.query_granularity)).alias(TIME_COLUMN)]
    keys += [F.col(f"`{d}`") for d in spec.dim_names]
    aggs = [a for m in spec.metrics for a in state_aggs(m)]
    kept = F.count_if(keep).alias("_kept")
    out = df.groupBy(*keys).agg(*aggs, kept)
    return out.filter(F.col("_kept") > 0).drop("_kept")


def detail(df: DataFrame, spec: TableSpec, time_col: str = TIME_COLUMN,
           keep: list[str] | None = None) -> DataFrame:
    """No rollup: every row kept, time floored, ``count = 1``.

    A metric is stored as its mergeable state of one row, so ``finish`` and
    ``reaggregate`` read a detail table like a rolled-up one. Sketches have
    no state of a single row: they need a rollup.
    """
    cols = [floor_time(time_col, spec.query_granularity).alias(TIME_COLUMN)]
    cols += [F.col(f"`{d}`") for d in spec.dim_names if d != TIME_COLUMN]
    cols += [F.col(f"`{c}`") for c in (keep or [])]
    for m in spec.metrics:
        if m.type == "count":
            cols.append(F.lit(1).cast("long").alias(m.name))
        elif m.field:
            cols += row_states(m)
    return df.select(*cols)


def roll(df: DataFrame, spec: TableSpec, time_col: str = TIME_COLUMN) -> DataFrame:
    """``rollup`` or ``detail`` as the spec says.

    A spec with no metrics and ``rollup=True`` keeps the distinct
    (bucket, dimensions) rows; with ``rollup=False`` it is a projection.
    """
    return rollup(df, spec, time_col) if spec.rollup else detail(df, spec, time_col)


def finish(rolled: DataFrame, spec: TableSpec) -> DataFrame:
    """Readable view of a rolled-up table: one final column per metric."""
    state = {c for m in spec.metrics for c in state_columns(m)}
    others = [F.col(f"`{c}`") for c in rolled.columns if c not in state]
    return rolled.select(*others, *[finish_expr(m) for m in spec.metrics])


def reaggregate(rolled: DataFrame, spec: TableSpec, dims: list[str] | None = None,
                granularity: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """Merge stored states to a coarser bucket and/or fewer dimensions (A10).

    Also the read side of partial rollups (micro-batches, repeated appends):
    it returns exactly what a direct rollup of the raw rows would.
    """
    dims = spec.dim_names if dims is None else dims
    g = granularity or spec.query_granularity
    keys = [floor_time(TIME_COLUMN, g).alias(TIME_COLUMN)]
    keys += [F.col(f"`{d}`") for d in list(keep or []) + dims]
    aggs = [a for m in spec.metrics for a in merge_aggs(m)]
    if not aggs:
        return rolled.select(*keys).distinct()
    return rolled.groupBy(*keys).agg(*aggs)


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """Distinct values of one column, sorted."""
    return df.select(col).distinct().orderBy(col)


def counts_by(df: DataFrame, col: str, name: str = "rows") -> DataFrame:
    """Row count per value in one aggregate, sorted."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias(name)).orderBy(col)


def exact_distinct(df: DataFrame, group_cols: list[str], cols: dict[str, Column | str]) -> DataFrame:
    """Several exact distinct counts in one aggregate.

    Catalyst rewrites multiple ``COUNT(DISTINCT …)`` into one ``Expand``
    plus two aggregations, with partial aggregation on both levels.
    """
    aggs = [F.count_distinct(F.col(c) if isinstance(c, str) else c).alias(n)
            for n, c in cols.items()]
    return df.groupBy(*group_cols).agg(*aggs)


def histogram_bins(df: DataFrame, metric: Metric, keep: list[str]) -> DataFrame:
    """A stored histogram as rows: ``keep``, ``bin`` (0 is below, ``bins + 1`` at or above, ``bins + 2``
    missing), its borders ``lower`` and ``upper`` (null where open) and ``n``."""
    rows = df.select(*[F.col(f"`{c}`") for c in keep], F.posexplode(F.col(f"`{metric.name}`")).alias("bin", "n"))
    width, b = (metric.upper - metric.lower) / metric.bins, F.col("bin")
    return rows.select(*[F.col(f"`{c}`") for c in keep], "bin",
                       F.when(b.between(1, metric.bins + 1), F.lit(metric.lower) + (b - 1) * F.lit(width)).alias("lower"),
                       F.when(b <= metric.bins, F.lit(metric.lower) + b * F.lit(width)).alias("upper"), "n")


def quantiles(sketch: Column | str, probs: list[float]) -> list[Column]:
    """Quantile estimates from a stored KLL sketch."""
    s = F.col(sketch) if isinstance(sketch, str) else sketch
    return [F.kll_sketch_get_quantile_double(s, F.lit(float(p))) for p in probs]


def sketch_summary(df: DataFrame, group_cols: list[str], value: str,
                   probs: tuple[float, ...] = (0.5, 0.9, 0.99), bins: int = 10) -> DataFrame:
    """Quantile sketch, approximate percentiles and a histogram per group."""
    g = df.groupBy(*group_cols).agg(
        F.kll_sketch_agg_double(F.col(value).cast("double")).alias("_kll"),
        F.percentile_approx(F.col(value).cast("double"), list(probs), 10000).alias("pct"),
        F.histogram_numeric(F.col(value).cast("double"), F.lit(bins)).alias("histogram"),
        F.count(F.col(value)).alias("n"))
    qs = [q.alias(f"q{int(round(p * 100))}") for q, p in zip(quantiles("_kll", list(probs)), probs)]
    return g.select(*group_cols, "n", *qs, "pct", "histogram")
