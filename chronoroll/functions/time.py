"""Event-time functions: parse, default, floor to a bucket, chunk labels.

All results are ``timestamp_ntz`` holding the UTC wall clock, so bucket
boundaries never move with the session zone. Flooring works on the wall-clock
fields of the value (``make_timestamp_ntz`` / date truncation) instead of
``date_trunc``, which would round-trip through the session zone.
Everything here is a built-in Catalyst expression: no Python runs per row.
"""

from __future__ import annotations

import datetime as _dt
import re

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

NTZ = "timestamp_ntz"

# The reference's event-time text format. Run ids are
# date-time digits down to the second (two runs in one minute must not share one).
REFERENCE_TIME_FORMAT = "MM/dd/yyyy hh:mm:ss a"
RUN_ID_FORMAT = "yyyyMMddHHmmss"

_NUMERIC = r"^\s*-?\d+\s*$"
_ZONED = r"([Zz]|[+-][0-9]{2}(:?[0-9]{2})?)\s*$"


def _epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast(NTZ)


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ntz_literal(text: str | _dt.datetime) -> Column:
    """An exact ``timestamp_ntz`` literal from ISO text (``Z``/offset → UTC)."""
    if isinstance(text, _dt.datetime):
        d = text
    else:
        t = text.strip().replace("Z", "+00:00")
        d = _dt.datetime.fromisoformat(t)
    if d.tzinfo is not None:
        d = d.astimezone(_dt.timezone.utc).replace(tzinfo=None)
    return F.lit(d.isoformat(sep=" ")).cast(NTZ)


def parse_time(c: Column | str, fmt: str = "iso") -> Column:
    """Parse event-time text; unparseable text gives null, never an error.

    ``fmt``: ``iso`` (ISO-8601 text), ``auto`` (ISO text, else whole-number
    epoch milliseconds), ``millis`` / ``posix`` / ``micros`` / ``nano``
    (epoch numbers), or a datetime pattern such as ``MM/dd/yyyy hh:mm:ss a``.
    Pattern parsing reads the text in the session zone and converts back in
    the same zone, so the wall clock written in the text is what is kept.
    """
    col = _c(c)
    f = fmt.lower()
    if f == "iso":
        return _iso(col.cast("string"))
    if f in ("millis", "posix", "micros", "nano"):
        return _epoch(col, f)
    if f == "auto":
        s = col.cast("string")
        return F.when(s.rlike(_NUMERIC), _epoch(s, "millis")).otherwise(_iso(s))
    text = col.cast("string")
    if _has_zone_letter(fmt):
        return instant_to_ntz(F.try_to_timestamp(text, F.lit(fmt)))
    if _session_is_utc():
        # read and written back in UTC, which has no gaps or overlaps: exact
        return F.try_to_timestamp(text, F.lit(fmt)).cast(NTZ)
    # other session zones: read the text as UTC explicitly (exact across
    # daylight-saving gaps, at some parsing cost)
    return instant_to_ntz(F.try_to_timestamp(F.concat(text, F.lit(" +0000")),
                                             F.lit(fmt + " Z")))


def _has_zone_letter(fmt: str) -> bool:
    """Whether a datetime pattern reads a zone (letters outside quotes)."""
    unquoted = re.sub(r"'[^']*'", "", fmt)
    return any(ch in unquoted for ch in "XxZzVO")


_UTC_NAMES = {"UTC", "GMT", "Z", "ETC/UTC", "ETC/GMT", "UCT", "UNIVERSAL", "ZULU", "+00:00"}


def _session_is_utc() -> bool:
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    if spark is None:
        return False
    # no default argument: Spark validates a default against the zone
    # checker (an empty one fails); the setting always has a value (the
    # JVM's zone when unset)
    return str(spark.conf.get("spark.sql.session.timeZone") or "").upper() in _UTC_NAMES


def _iso(s: Column) -> Column:
    """ISO-8601 text → UTC wall clock.

    Text without a zone is a UTC wall clock already (cast straight to
    ``timestamp_ntz``, which would otherwise drop an offset silently); text
    with ``Z`` or ``±hh[:mm]`` is read as an instant and turned into its UTC
    wall clock.
    """
    zoned = s.contains(":") & s.rlike(_ZONED)
    return F.when(zoned, instant_to_ntz(s.try_cast("timestamp"))).otherwise(s.try_cast(NTZ))


def _epoch(col: Column, unit: str) -> Column:
    """Epoch number → UTC wall clock, by arithmetic on the epoch (no zone)."""
    n = col.cast("string").try_cast("long")
    if unit == "posix":
        return F.timestamp_add("SECOND", n, _epoch_ntz())
    if unit == "millis":
        return F.timestamp_add("MILLISECOND", n, _epoch_ntz())
    if unit == "nano":
        n = F.floor(n / F.lit(1000)).cast("long")
    return F.timestamp_add("MICROSECOND", n, _epoch_ntz())


def is_blank(c: Column | str) -> Column:
    col = _c(c)
    return col.isNull() | (F.trim(col.cast("string")) == F.lit(""))


def event_time(c: Column | str, fmt: str = "iso", missing: str | None = None) -> Column:
    """Parsed time; null or empty text takes ``missing`` when one is given.

    Non-empty text that does not parse stays null so that ``split_bad`` can
    set the row aside instead of silently moving it to the default time.
    """
    col = _c(c)
    parsed = parse_time(col, fmt)
    if missing is None:
        return parsed
    return F.when(is_blank(col), ntz_literal(missing)).otherwise(parsed)


def floor_time(c: Column | str, granularity: str) -> Column:
    """Floor a ``timestamp_ntz`` to the start of its bucket."""
    t = _c(c)
    g = granularity.lower()
    if g == "none":
        return t
    y, mo, d, h, mi = F.year(t), F.month(t), F.dayofmonth(t), F.hour(t), F.minute(t)
    zero = F.lit(0)
    if g == "second":
        return F.make_timestamp_ntz(y, mo, d, h, mi, F.second(t))
    if g == "minute":
        return F.make_timestamp_ntz(y, mo, d, h, mi, zero)
    if g in ("fifteen_minute", "thirty_minute"):
        step = F.lit(15 if g.startswith("fifteen") else 30)
        return F.make_timestamp_ntz(y, mo, d, h, mi - F.pmod(mi, step), zero)
    if g == "hour":
        return F.make_timestamp_ntz(y, mo, d, h, zero, zero)
    if g == "six_hour":
        return F.make_timestamp_ntz(y, mo, d, h - F.pmod(h, F.lit(6)), zero, zero)
    day = F.to_date(t)
    if g == "day":
        return day.cast(NTZ)
    if g in ("week", "month", "quarter", "year"):
        return F.trunc(day, g).cast(NTZ)
    if g == "all":
        return ntz_literal("1970-01-01T00:00:00")
    raise ValueError(f"unknown granularity {granularity!r}")


def chunk_label(c: Column | str, granularity: str) -> Column:
    """Folder label of the time chunk (segment) a time falls in.

    ``yyyy-MM-dd`` of the chunk start for day and coarser chunks, with
    ``THH`` appended for sub-day chunks. Built from date parts, so the label
    is independent of the session zone.
    """
    g = granularity.lower()
    start = floor_time(c, g)
    label = F.to_date(start).cast("string")
    if g in ("hour", "six_hour", "minute", "fifteen_minute", "thirty_minute", "second", "none"):
        label = F.concat(label, F.lit("T"), F.lpad(F.hour(start).cast("string"), 2, "0"))
    return label


# From one chunk's start to the next (sub-day labels name the hour), and its least hours.
CHUNK_STEPS = {"day": ("1 day", 24), "week": ("7 day", 168), "month": ("1 month", 672), "quarter": ("3 month", 2160),
               "year": ("1 year", 8760)}


def chunk_names(spark: SparkSession, intervals, granularity: str, most: int) -> list[str] | None:
    """Labels of all chunks that can hold a time inside the ``lo/hi`` intervals, in order; ``None`` beyond ``most``."""
    g = granularity.lower()
    if g == "all":
        return ["1970-01-01"]
    length, hours = CHUNK_STEPS.get(g, ("1 hour", 1))
    step = F.expr(f"INTERVAL {length}")
    found = set()
    for iv in intervals:
        lo, hi = interval_bounds(iv)
        if spark.range(1).select(F.timestamp_diff("HOUR", lo, hi)).first()[0] > most * hours:
            return None
        first = floor_time(lo, g if g in CHUNK_STEPS else "hour")
        starts = F.when(lo < hi, F.sequence(first, hi, step)).otherwise(F.array(first))
        found.update(spark.range(1).select(F.transform(starts, lambda t: chunk_label(t, g))).first()[0])
    return sorted(found)


def format_reference_time(c: Column | str) -> Column:
    """``MM/dd/yyyy hh:mm:ss a`` text of a ``timestamp_ntz``, from its fields."""
    t = _c(c)
    h = F.hour(t)
    h12 = F.when(F.pmod(h, F.lit(12)) == 0, F.lit(12)).otherwise(F.pmod(h, F.lit(12)))
    return F.format_string("%02d/%02d/%04d %02d:%02d:%02d %s", F.month(t), F.dayofmonth(t),
                           F.year(t), h12, F.minute(t), F.second(t),
                           F.when(h < 12, F.lit("AM")).otherwise(F.lit("PM")))


def run_id(ts: _dt.datetime | None = None, fmt: str = RUN_ID_FORMAT) -> str:
    """Run identifier from a pinned timestamp (seconds precision by default)."""
    ts = ts or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    java_to_py = [("yyyy", "%Y"), ("MM", "%m"), ("dd", "%d"), ("HH", "%H"),
                  ("mm", "%M"), ("ss", "%S")]
    out = fmt
    for j, p in java_to_py:
        out = out.replace(j, p)
    return ts.strftime(out)


def format_run_id(c: Column | str, fmt: str = RUN_ID_FORMAT) -> Column:
    """The same run id as a column expression (``date_format``)."""
    return F.date_format(_c(c), fmt)


_ISO_INTERVAL = re.compile(r"^\s*([^/]+)/([^/]+)\s*$")


def interval_bounds(interval: str) -> tuple[Column, Column]:
    """``lo/hi`` ISO interval → (lo, hi) ``timestamp_ntz`` literals."""
    m = _ISO_INTERVAL.match(interval)
    if not m:
        raise ValueError(f"interval must look like 'start/end': {interval!r}")
    return ntz_literal(m.group(1)), ntz_literal(m.group(2))


def utc_epoch_millis(c: Column | str) -> Column:
    """Epoch milliseconds of a ``timestamp_ntz`` read as a UTC wall clock."""
    return F.timestamp_diff("MILLISECOND", _epoch_ntz(), _c(c))


def ntz_to_instant(c: Column | str) -> Column:
    """The instant (``timestamp``) a UTC wall clock (``timestamp_ntz``) denotes.

    Pure arithmetic on epoch microseconds: exact in every session zone,
    daylight-saving gaps and overlaps included.
    """
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", _epoch_ntz(), _c(c)))


def instant_to_ntz(c: Column | str) -> Column:
    """The UTC wall clock (``timestamp_ntz``) of an instant (``timestamp``)."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(_c(c)), _epoch_ntz())
