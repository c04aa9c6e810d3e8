"""Continuous ingest of JSON messages with a time-bucketed rollup (S9, S10, ST1–ST4).

Two shapes are offered.

``stream_rollup`` (the default, ST1/ST3): each micro-batch is rolled up on
its own and written as a partial table ``chunk=…/batch_id=…``; readers merge
the partials with ``reaggregate``. No state is kept between batches, late
records are simply accepted into a later partial, and re-running a batch
after a failure overwrites exactly its own partition, so a restart from the
checkpoint never double counts. Partials of old batches can be compacted by
reading, re-aggregating and replacing a chunk.

``stream_window`` (ST4): a stateful tumbling event-time window with an
optional watermark. The state store keeps one mergeable state per open
window and group; with a watermark, windows older than it are dropped from
state and late rows for them are ignored. Updated groups of each batch are
written with the batch id; the reader keeps the newest version of each
group. With ``arrival`` the state is bounded and no row is ever ignored: a
state belongs to the stretch of time in which its rows came in, leaves the
store when that is over, and rows that come later for the same window make a
new partial, which the reader merges.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.time import floor_time, instant_to_ntz, ntz_to_instant
from ..operators.clean import BAD_REASON, parsed_messages
from ..operators.lookup import with_lookups
from ..operators.rollup import finish, reaggregate, state_aggs
from ..plans.ingest import (_spec_with_partition, _text_time, a_partition, bad_rows, clean, has_bad,
                            no_bad_rows, prepare, read_table, rollup_with_rejects, split_rollup)
from ..session import data_files, delete_paths, list_files, path_exists, shared_dir
from ..sinks.files import CHUNK, replace_partitions, with_chunk, write_table
from ..sinks.journal import commit, partition_folders, recover, staging_path
from ..spec import TIME_COLUMN, TableSpec

BATCH = "batch_id"
EVENT_TS = "_event_ts"


def read_json_stream(spark: SparkSession, source: str, schema: str | T.StructType,
                     fmt: str = "files", options: dict | None = None,
                     max_files_per_trigger: int | None = None,
                     max_bytes_per_trigger: int | None = None) -> DataFrame:
    """Stream of JSON messages as typed columns (S9), from the earliest.

    A message that is no JSON object has its text in ``_malformed`` (see
    ``parsed_messages``); it never counts as a record.
    ``fmt="kafka"``: ``source`` is the topic; ``options`` carry
    ``kafka.bootstrap.servers`` etc.; reading starts at the earliest offset
    unless the options say otherwise.
    ``fmt="files"``: ``source`` is a folder of text files, one message per
    line (region sub-folders allowed); all files present at start are read
    first. ``max_bytes_per_trigger`` bounds a micro-batch by input size,
    ``max_files_per_trigger`` by file count.
    """
    ddl = schema if isinstance(schema, str) else schema.simpleString()
    if fmt == "kafka":
        r = (spark.readStream.format("kafka").option("subscribe", source)
             .option("startingOffsets", "earliest"))
        for k, v in (options or {}).items():
            r = r.option(k, v)
        raw = r.load().select(F.col("value").cast("string").alias("value"))
    else:
        r = spark.readStream.format("text")
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
        if max_bytes_per_trigger:
            r = r.option("maxBytesPerTrigger", int(max_bytes_per_trigger))
        for k, v in (options or {}).items():
            r = r.option(k, v)
        raw = r.load(source)
    return parsed_messages(raw, ddl)


def _trigger(writer, trigger: str | None):
    if trigger in (None, "availableNow"):
        return writer.trigger(availableNow=True)
    if trigger == "once":
        return writer.trigger(once=True)
    return writer.trigger(processingTime=trigger)


def stream_rollup(stream: DataFrame, spec: TableSpec, out_path: str, checkpoint: str,
                  quarantine_path: str | None = None, trigger: str | None = "availableNow",
                  files_per_partition: int | None = 0):
    """Start the partial-rollup stream (ST1–ST3); returns the StreamingQuery.

    ``trigger``: ``availableNow`` (process what is there, then stop),
    ``once``, or a processing-time interval such as ``"10 minutes"``.
    Partials are written straight from the aggregation's partitions (already
    hashed and sized by AQE): one shuffle per micro-batch, not two.
    ``compact_stream_rollup`` later rewrites them into sized files. The spec's
    lookups are read anew for every micro-batch.
    """
    spark = stream.sparkSession

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch = with_lookups(spark, batch, spec.lookups)     # each mapping as it is now
        agg = obs = None
        if quarantine_path and spec.rollup:
            # the aggregation also says whether the batch has bad rows (see rollup_with_rejects)
            agg = rollup_with_rejects(batch, spec).persist()
            rows, _ = split_rollup(agg, spec)
        else:
            if quarantine_path and _text_time(batch, spec):
                obs = Observation(f"chronoroll_bad_rows_{uuid.uuid4().hex}")
            rows, _ = prepare(batch, spec, obs)
        bad = bad_rows(batch, spec)
        write_table(rows.withColumn(BATCH, F.lit(batch_id).cast("long")), out_path,
                    [CHUNK, BATCH], mode="overwrite", files_per_partition=files_per_partition,
                    max_rows_per_file=spec.max_rows_per_file)
        if quarantine_path and (not has_bad(agg) if agg is not None else no_bad_rows(obs)):
            bad = bad.limit(0)         # no bad row in this batch: no second read
        if quarantine_path:
            write_table(bad.withColumn(BATCH, F.lit(batch_id).cast("long")), quarantine_path,
                        [BATCH], mode="overwrite")
        if agg is not None:
            agg.unpersist()

    w = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    return _trigger(w, trigger).start()


UPTO = "upto_batch"


def _covered(spark: SparkSession, compacted_path: str | None) -> dict[str, int]:
    """Chunk → last batch that its base holds, from the folder names (``chunk=…/upto_batch=…``): no data is read."""
    covered: dict[str, int] = {}
    for folder in {f.rpartition("/")[0] for f in data_files(spark, compacted_path)} if compacted_path else ():
        parts = [p.partition("=") for p in folder.split("/")]
        if [p[0] for p in parts] != [CHUNK, UPTO]:
            raise ValueError(f"{compacted_path}/{folder} is no folder of a compacted base ({CHUNK}=…/{UPTO}=…)")
        chunk, upto = unquote(parts[0][2]), int(parts[1][2])
        covered[chunk] = max(upto, covered.get(chunk, -1))
    return covered


def _by_batch(covered: dict[str, int]) -> dict[int, list[str]]:
    out = defaultdict(list)
    for chunk, upto in covered.items():
        out[upto].append(chunk)
    return out


def _not_covered(covered: dict[str, int]) -> Column:
    """Partition filter of the partials that no base holds; the others are not even listed for reading."""
    keep = ~F.col(CHUNK).isin(list(covered))
    for upto, chunks in _by_batch(covered).items():
        keep = keep | (F.col(CHUNK).isin(chunks) & (F.col(BATCH) > upto))
    return keep


def _base(spark: SparkSession, compacted_path: str, covered: dict[str, int]) -> DataFrame:
    """The newest version of the base of the ``covered`` chunks: a partition filter on both folder levels."""
    newest = reduce(lambda x, y: x | y, [F.col(CHUNK).isin(chunks) & (F.col(UPTO) == upto)
                                         for upto, chunks in _by_batch(covered).items()])
    return read_table(spark, compacted_path, [CHUNK]).filter(newest).drop(UPTO)


def _partials(spark: SparkSession, out_path: str, compacted_path: str | None) -> DataFrame:
    """Partial states still to merge: compacted base + newer micro-batches."""
    covered = _covered(spark, compacted_path)
    if not covered:
        return read_table(spark, out_path, [CHUNK]).drop(BATCH)
    base = _base(spark, compacted_path, covered)
    if not data_files(spark, out_path):
        return base                    # every partial folded into the base and purged
    newer = read_table(spark, out_path, [CHUNK]).filter(_not_covered(covered)).drop(BATCH)
    return newer.unionByName(base)


def read_stream_rollup(spark: SparkSession, spec: TableSpec, out_path: str,
                       finished: bool = True, compacted_path: str | None = None) -> DataFrame:
    """Merge the partials of ``stream_rollup`` (and a compacted base) into the table."""
    spec = _spec_with_partition(spec)
    merged = reaggregate(_partials(spark, out_path, compacted_path), spec, keep=[CHUNK])
    return finish(merged, spec) if finished else merged


def last_committed(spark: SparkSession, checkpoint: str) -> int:
    """The last micro-batch that a stream with this checkpoint folder has committed (-1: none)."""
    return max((int(n) for n in list_files(spark, f"{checkpoint}/commits") if n.isdigit()), default=-1)


def compact_stream_rollup(spark: SparkSession, spec: TableSpec, out_path: str, compacted_path: str,
                          upto_batch: int | None = None, checkpoint: str | None = None) -> int:
    """Fold all partials up to ``upto_batch`` into the compacted base table.

    The merged states of a chunk become a new version of that chunk of the
    base, ``chunk=…/upto_batch=…``; readers then skip partials up to it. What
    a base covers is thus known from folder names, and only the chunks with
    newer partials are read and written. New versions are staged and swapped
    in by the table's journal: a compaction that dies is undone or finished
    by the next one, and a reader in between takes the newest version it
    sees. Returns the batch the base now covers.

    While the stream runs, name its ``checkpoint``: only batches it has
    committed are folded then (the folders of the running one appear one by
    one). Old partial folders may be deleted afterwards with
    ``purge_compacted`` (readers ignore them either way).
    """
    spec = _spec_with_partition(spec)
    recover(spark, compacted_path)
    batches = {(v[CHUNK], int(v[BATCH])) for v in partition_folders(spark, out_path, [CHUNK, BATCH]).values()}
    last = max((b for _, b in batches), default=-1)
    if upto_batch is None:
        upto_batch = last
    if checkpoint is not None:
        upto_batch = min(upto_batch, last_committed(spark, checkpoint))
    if last < 0 or upto_batch < 0:
        return -1                      # nothing to fold in
    covered = _covered(spark, compacted_path)
    touched = sorted({c for c, b in batches if covered.get(c, -1) < b <= upto_batch})
    if not touched:
        return int(upto_batch)
    fresh = (read_table(spark, out_path, [CHUNK])
             .filter(F.col(CHUNK).isin(touched) & (F.col(BATCH) <= upto_batch) & _not_covered(covered)).drop(BATCH))
    held = {c: covered[c] for c in touched if c in covered}
    if held:
        fresh = fresh.unionByName(_base(spark, compacted_path, held))
    merged = reaggregate(fresh, spec, keep=[CHUNK]).withColumn(UPTO, F.lit(upto_batch).cast("long"))
    staged = staging_path(compacted_path)
    write_table(merged, staged, [CHUNK, UPTO])
    new = partition_folders(spark, staged, [CHUNK, UPTO])
    old = partition_folders(spark, compacted_path, [CHUNK, UPTO]) if held else {}
    commit(spark, compacted_path, staged, replace=list(new),
           remove=[f for f, v in old.items() if v[CHUNK] in held and f not in new])
    return int(upto_batch)


def purge_compacted(spark: SparkSession, out_path: str, compacted_path: str) -> int:
    """Delete partial folders already covered by the compacted base; returns the count."""
    covered = _covered(spark, compacted_path)
    old = [f"{out_path.rstrip('/')}/{folder}" for folder, v in partition_folders(spark, out_path, [CHUNK, BATCH]).items()
           if int(v[BATCH]) <= covered.get(v[CHUNK], -1)]
    delete_paths(spark, old)
    return len(old)


# Granularities that are event-time windows of one length, and
# the offset of a week's start (Monday) from the epoch's weekday.
WINDOWS = {"second": "1 second", "minute": "1 minute", "fifteen_minute": "15 minutes",
           "thirty_minute": "30 minutes", "hour": "1 hour", "six_hour": "6 hours",
           "day": "1 day", "week": "7 days"}
WEEK_START = "4 days"


ARRIVED = "_arrived"


def stream_window(stream: DataFrame, spec: TableSpec, out_path: str, checkpoint: str,
                  watermark: str | None = None, trigger: str | None = "availableNow",
                  arrival: str | None = None):
    """Stateful tumbling-window rollup (ST4); returns the StreamingQuery.

    The window is the spec's query granularity; the updated groups of a batch
    are written to ``chunk=…/batch_id=…`` folders, so a time range reads only
    its chunks. Without ``watermark`` every late row is still counted, and the
    state grows with the number of windows and groups; with one, state older
    than the watermark is dropped, and rows that come later are too.

    ``arrival`` (a length, ``"10 minutes"``) bounds the state without losing
    rows: a group's state is kept per stretch of arrival time (the batch's
    own time, which a replay of the batch repeats), and a watermark on the
    arrival drops it once the stretch has passed. The store holds the groups
    of the latest stretches only; a late row starts a new partial of its old
    window, and ``read_stream_window`` merges a window's partials.

    Rows that cannot be loaded are left to ``stream_quarantine``, run beside
    this query on the same source.
    """
    if spec.lookups:
        raise ValueError("lookups are read for every micro-batch, which a windowed state cannot do: use stream_rollup")
    if watermark and arrival:
        raise ValueError("a stream has a watermark on its event time or on the arrival, not both")
    if spec.query_granularity not in WINDOWS:
        raise ValueError(f"no window of fixed length for granularity {spec.query_granularity!r}")
    spec = _spec_with_partition(spec)
    metric_inputs, _ = clean(stream, spec)
    # event-time windows and watermarks work on instants: the UTC wall clock
    # is turned into its instant, so windows start at UTC day boundaries
    # whatever the session zone
    metric_inputs = metric_inputs.withColumn(EVENT_TS, ntz_to_instant(TIME_COLUMN))
    if watermark:
        metric_inputs = metric_inputs.withWatermark(EVENT_TS, watermark)
    aggs = [a for m in spec.metrics for a in state_aggs(m)]
    length = WINDOWS[spec.query_granularity]
    window = (F.window(EVENT_TS, length, length, WEEK_START) if spec.query_granularity == "week"
              else F.window(EVENT_TS, length))
    dims = [F.col(f"`{d}`") for d in spec.dim_names]
    if arrival:
        came = metric_inputs.withColumn(ARRIVED, F.current_timestamp()).withWatermark(ARRIVED, "0 seconds")
        agg = came.groupBy(F.window(ARRIVED, arrival).alias("_w"), floor_time(TIME_COLUMN, spec.query_granularity).alias(TIME_COLUMN),
                           *dims).agg(*aggs)
    else:
        agg = metric_inputs.groupBy(window.alias("_w"), *dims).agg(*aggs)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        out = (batch.withColumn(ARRIVED if arrival else TIME_COLUMN, instant_to_ntz(F.col("_w.start"))).drop("_w")
               .withColumn(BATCH, F.lit(batch_id).cast("long")))
        # a stateful micro-batch is planned without AQE, which would drop a
        # REBALANCE hint: the updated groups are written straight from the
        # state's hash partitions (fixed for the life of the query), one
        # file per state partition, chunk and batch, no extra shuffle
        write_table(with_chunk(out, TIME_COLUMN, spec.segment_granularity), out_path,
                    [CHUNK, BATCH], mode="overwrite", files_per_partition=0)

    w = (agg.writeStream.outputMode("update").foreachBatch(write_batch)
         .option("checkpointLocation", checkpoint))
    return _trigger(w, trigger).start()


def stream_quarantine(stream: DataFrame, spec: TableSpec, path: str, checkpoint: str,
                      trigger: str | None = "availableNow"):
    """Stream the rows that cannot be loaded to ``path`` (P11); returns the StreamingQuery.

    A query of its own over the same source, for streams whose aggregation
    keeps state and so cannot hand them out.
    """
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        write_table(bad_rows(batch, spec).withColumn(BATCH, F.lit(batch_id).cast("long")), path,
                    [BATCH], mode="overwrite", files_per_partition=0)

    w = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    return _trigger(w, trigger).start()


def _versions(spark: SparkSession, out_path: str, compacted_path: str | None) -> DataFrame:
    """Every version of every group: compacted base and newer batches."""
    # a path whose batches were all folded into the base and purged holds no file
    frames = [read_table(spark, p, [CHUNK]) for p in (out_path, compacted_path)
              if p and path_exists(spark, p) and a_partition(spark, p) != p]
    if not frames:
        raise FileNotFoundError(f"no window output below {out_path}")
    return reduce(DataFrame.unionByName, frames)


def _newest(versions: DataFrame, spec: TableSpec, keep_batch: bool) -> DataFrame:
    keys = [TIME_COLUMN, CHUNK, *spec.dim_names, *([ARRIVED] if ARRIVED in versions.columns else [])]
    # a group is written once per batch that updates it: the newest version
    # is the one of the highest batch id. max_by is a partial aggregate, so
    # the versions are reduced map-side before the shuffle (a window would
    # shuffle and sort every version). One max_by per column (versions of one
    # batch are equal, so all pick the same row) keeps fixed-width buffers
    # and a hash aggregate; a struct buffer would force a sort.
    values = [c for c in versions.columns if c not in keys and c != BATCH]
    last = [F.max(BATCH).alias(BATCH)] if keep_batch else []
    return (versions.groupBy(*[F.col(f"`{k}`") for k in keys])
            .agg(*[F.max_by(F.col(f"`{c}`"), F.col(BATCH)).alias(c) for c in values], *last))


def read_stream_window(spark: SparkSession, spec: TableSpec, out_path: str,
                       compacted_path: str | None = None) -> DataFrame:
    """Newest version of each (window, group) written by ``stream_window``; partials by arrival are merged."""
    spec = _spec_with_partition(spec)
    newest = _newest(_versions(spark, out_path, compacted_path), spec, False)
    return finish(reaggregate(newest, spec, keep=[CHUNK]) if ARRIVED in newest.columns else newest, spec)


def compact_stream_window(spark: SparkSession, spec: TableSpec, out_path: str,
                          compacted_path: str) -> int:
    """Keep only the newest version of each group in a base table; returns its last batch.

    The base holds a version's batch id, so a reader that still sees the
    folded batches (before ``purge_window``) gets the same answer. Only the
    chunks that have newer versions are read and rewritten.
    """
    spec = _spec_with_partition(spec)
    try:
        versions = _versions(spark, out_path, None)
    except FileNotFoundError:
        return -1                      # nothing new
    if path_exists(spark, compacted_path) and a_partition(spark, compacted_path) != compacted_path:
        touched = versions.select(CHUNK).distinct()
        base = _versions(spark, compacted_path, None)
        versions = versions.unionByName(base.join(touched, CHUNK, "left_semi"))
    shared_dir(spark)
    newest = _newest(versions, spec, True).checkpoint(eager=True)
    upto = newest.agg(F.max(BATCH)).first()[0]
    if upto is None:
        return -1
    replace_partitions(newest, compacted_path, [CHUNK])
    return int(upto)


def purge_window(spark: SparkSession, out_path: str, upto_batch: int) -> int:
    """Delete the batch folders up to ``upto_batch`` that a base covers; returns the number."""
    old = [f"{out_path.rstrip('/')}/{folder}" for folder, v in partition_folders(spark, out_path, [CHUNK, BATCH]).items()
           if int(v[BATCH]) <= upto_batch]
    delete_paths(spark, old)
    return len(old)


def bad_messages(spark: SparkSession, quarantine_path: str) -> DataFrame:
    return spark.read.parquet(quarantine_path).filter(F.col(BAD_REASON).isNotNull())


__all__ = ["read_json_stream", "stream_rollup", "read_stream_rollup", "compact_stream_rollup",
           "purge_compacted", "last_committed", "stream_window", "read_stream_window", "compact_stream_window",
           "purge_window", "stream_quarantine", "bad_messages"]
