"""Immutable description of a time-series table: time, dimensions, metrics.

A ``TableSpec`` is what an ingestion spec describes — the time column and its
format, the default for a missing time, the typed dimension list, the metrics,
the bucket (query) granularity, the chunk (segment) granularity, whether rows
are rolled up, and the allowed time intervals. Specs are frozen: deriving a
per-region variant returns a new object (``dataclasses.replace``), so one
spec can never be changed by a job that uses it.
"""

from __future__ import annotations

import dataclasses
import logging
from dataclasses import dataclass, field
from typing import Any

# Granularity names accepted in specs (case-insensitive).
GRANULARITIES = ("none", "second", "minute", "fifteen_minute", "thirty_minute",
                 "hour", "six_hour", "day", "week", "month", "quarter", "year", "all")

# Dimension types of the reference's specs.
DIM_TYPES = ("string", "long", "double", "float", "boolean")

# Metric types of the reference's specs, plus the sketch family
# enabled by its extension list.
METRIC_TYPES = ("count", "longSum", "doubleSum", "doubleMean", "doubleAvg",
                "hyperUnique", "thetaSketch", "quantilesDoublesSketch",
                "longMin", "longMax", "doubleMin", "doubleMax", "fixedBucketsHistogram")

TIME_COLUMN = "__time"


@dataclass(frozen=True)
class Dim:
    """A dimension. ``index=True`` (``createBitmapIndex``) sorts rows by it
    inside every written file, so Parquet min/max statistics let a filter on
    it skip row groups."""
    name: str
    type: str = "string"
    index: bool = False

    def __post_init__(self):
        if self.type.lower() not in DIM_TYPES:
            raise ValueError(f"unknown dimension type {self.type!r} for {self.name!r}")

    @staticmethod
    def of(d: str | dict | "Dim") -> "Dim":
        if isinstance(d, Dim):
            return d
        if isinstance(d, str):
            return Dim(d)
        return Dim(d["name"], d.get("type", "string").lower(), bool(d.get("createBitmapIndex", False)))


@dataclass(frozen=True)
class Metric:
    """One metric. ``scale`` makes a sum exact: values are accumulated as
    integers of 10**-scale units, so partial sums merge without float drift.
    A ``fixedBucketsHistogram`` counts values in ``bins`` equal bins of
    ``[lower, upper)``, those below, those at or above ``upper``, and those
    that are missing or no number."""
    name: str
    type: str
    field: str | None = None
    scale: int | None = None
    lg_k: int = 12
    bins: int = 0
    lower: float = 0.0
    upper: float = 0.0

    def __post_init__(self):
        if self.type == "fixedBucketsHistogram" and not (self.bins > 0 and self.lower < self.upper):
            raise ValueError(f"histogram {self.name!r} needs numBuckets and lowerLimit < upperLimit")
        if self.type not in METRIC_TYPES:
            raise ValueError(f"unknown metric type {self.type!r}")
        if self.type != "count" and not self.field:
            raise ValueError(f"metric {self.name!r} needs a field")

    @staticmethod
    def of(m: dict | "Metric") -> "Metric":
        if isinstance(m, Metric):
            return m
        return Metric(m["name"], m["type"], m.get("fieldName", m.get("field")),
                      m.get("scale"), m.get("lgK", m.get("lg_k", 12)), int(m.get("numBuckets", 0)),
                      float(m.get("lowerLimit", 0.0)), float(m.get("upperLimit", 0.0)))


@dataclass(frozen=True)
class Lookup:
    """A dimension taken from a mapping table: ``name`` = the mapping's ``value`` for the row's ``column``.

    The mapping (``path``, read with format ``fmt``) is read anew by every
    load and every micro-batch.
    """
    name: str
    column: str
    path: str
    key: str
    value: str
    default: str | None = None
    fmt: str = "parquet"

    @staticmethod
    def of(x: dict | "Lookup") -> "Lookup":
        if isinstance(x, Lookup):
            return x
        return Lookup(x["name"], x["column"], x["path"], x["key"], x["value"], x.get("default"), x.get("format", "parquet"))


@dataclass(frozen=True)
class TableSpec:
    """Everything a load needs to know about one table."""
    name: str
    time_column: str
    time_format: str = "iso"
    missing_time: str | None = None
    dimensions: tuple[Dim, ...] = ()
    exclude: tuple[str, ...] = ()
    metrics: tuple[Metric, ...] = ()
    query_granularity: str = "none"
    segment_granularity: str = "day"
    rollup: bool = False
    intervals: tuple[str, ...] | None = None
    partition_col: str | None = None
    max_rows_per_file: int | None = None
    lookups: tuple[Lookup, ...] = ()

    def __post_init__(self):
        object.__setattr__(self, "lookups", tuple(Lookup.of(x) for x in self.lookups))
        for g in (self.query_granularity, self.segment_granularity):
            if g.lower() not in GRANULARITIES:
                raise ValueError(f"unknown granularity {g!r}")
        object.__setattr__(self, "query_granularity", self.query_granularity.lower())
        object.__setattr__(self, "segment_granularity", self.segment_granularity.lower())
        object.__setattr__(self, "dimensions", tuple(Dim.of(d) for d in self.dimensions))
        object.__setattr__(self, "metrics", tuple(Metric.of(m) for m in self.metrics))
        object.__setattr__(self, "exclude", tuple(self.exclude))
        if self.intervals is not None:
            object.__setattr__(self, "intervals", tuple(self.intervals))

    @property
    def dim_names(self) -> list[str]:
        return [d.name for d in self.dimensions]

    @property
    def input_names(self) -> list[str]:
        """The columns a source must have: time, dimensions, metric inputs; a lookup's column for its name."""
        made = {x.name for x in self.lookups}
        names = [self.time_column, *self.dim_names, *[m.field for m in self.metrics if m.field], *[x.column for x in self.lookups]]
        return list(dict.fromkeys(n for n in names if n not in made))

    @property
    def indexed(self) -> list[str]:
        return [d.name for d in self.dimensions if d.index]

    def with_(self, **changes: Any) -> "TableSpec":
        return dataclasses.replace(self, **changes)

    @staticmethod
    def from_dict(d: dict) -> "TableSpec":
        """Build from the JSON shape of an ingestion spec's ``dataSchema``.

        An absent ``granularitySpec.rollup`` means rollup, as it does in the
        store whose specs these are; without metrics that keeps the distinct
        rows, which is logged since it may not be what was meant.
        """
        schema = d.get("dataSchema", d)
        ts = schema["timestampSpec"]
        dims = schema.get("dimensionsSpec", {})
        gran = schema.get("granularitySpec", {})
        metrics = schema.get("metricsSpec", [])
        if "rollup" not in gran and not metrics:
            logging.getLogger(__name__).warning(
                "spec %r has no metrics and no rollup flag: its distinct rows are kept",
                schema.get("dataSource", "table"))
        tuning = d.get("tuningConfig", {})
        return TableSpec(
            name=schema.get("dataSource", "table"),
            time_column=ts["column"],
            time_format=ts.get("format", "auto"),
            missing_time=ts.get("missingValue"),
            dimensions=tuple(Dim.of(x) for x in dims.get("dimensions", [])),
            exclude=tuple(dims.get("dimensionExclusions", [])),
            metrics=tuple(Metric.of(m) for m in metrics),
            query_granularity=gran.get("queryGranularity", "none"),
            segment_granularity=gran.get("segmentGranularity", "day"),
            rollup=bool(gran.get("rollup", True)),
            intervals=gran.get("intervals"),
            partition_col=d.get("partitionColumn"),
            max_rows_per_file=tuning.get("maxRowsPerSegment"),
            lookups=tuple(Lookup.of(x) for x in schema.get("transformSpec", {}).get("lookups", [])),
        )


@dataclass(frozen=True)
class JdbcOptions:
    """Connection options; nothing is hard-coded, the caller passes all."""
    url: str
    user: str | None = None
    password: str | None = None
    driver: str | None = None
    extra: dict = field(default_factory=dict)

    def as_dict(self) -> dict[str, str]:
        out = {"url": self.url}
        for k in ("user", "password", "driver"):
            v = getattr(self, k)
            if v is not None:
                out[k] = v
        out.update({k: str(v) for k, v in self.extra.items()})
        return out
