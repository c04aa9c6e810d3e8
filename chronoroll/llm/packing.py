"""Best-fit packing of token sequences by minimum bin slack.

Pieces shorter than a sequence are packed so that each sequence is filled as
far as the lengths at hand allow: starting from the longest piece left, a
subset-sum over the available lengths (a bitset of reachable fills, one shift
per length and copy) finds the fullest feasible combination, which is then
removed. Only lengths matter to it, so it runs on their histogram, at most
``capacity - 1`` numbers whatever the corpus holds, and a combination is taken
as many times as the lengths last: every combination uses up a length, which
bounds their number too. Pieces are then dealt to the combinations by their
rank among pieces of the same length, counted in salted parts, so that no
length is gathered in one task.

Defined cases: a null or empty text is one piece that holds the end id alone;
an empty table gives an empty result; repeated rows are packed each; extra
columns are carried, those named like a result column are replaced.
"""

from __future__ import annotations

import zlib
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words as W

CAPACITY = 1024
END_ID = 2
#: Most pieces of one length that are ranked in one task.
RANK_GROUP = 200_000
PIECE = ("piece", "start", "length", "ids", "ids_crc32")
PLACE = ("sequence_id", "offset")


def tokenize(docs: DataFrame, ranks: str, pattern: str, *, text: str = "text",
             special: dict[str, int] | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece: ``docs`` without ``text``, with the columns of PIECE.

    ``ranks`` is the rank file of a byte-level vocabulary, ``pattern`` what
    splits a text before the merges. ``special`` gives the ids of special
    tokens; without it their strings are ordinary text. ``ids`` is binary, little-endian unsigned 32-bit. A document of more
    than ``capacity`` ids is cut into full pieces, the first takes the rest.
    """
    kept = [n for n in docs.columns if n != text and n not in PIECE]
    rest = [F.col(W.quoted(n)).alias(f"c{i}") for i, n in enumerate(kept)]
    packed = docs.select(F.struct(F.lit(0).alias("none"), *rest).alias("row"), F.col(W.quoted(text)).cast("string").alias("text"))
    schema = T.StructType([packed.schema["row"], T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
                           T.StructField("length", T.LongType()), T.StructField("ids", T.BinaryType()),
                           T.StructField("ids_crc32", T.LongType())])

    def run(batches):
        encoding = _encoding(ranks, pattern, special or {})
        for batch, _, _ in W.blocks(batches, "text"):
            at, piece, start, length, ids, crc = [], [], [], [], [], []
            for i, s in enumerate(batch.column("text").to_pylist()):
                got = np.append(encoding.encode_to_numpy(s or "", allowed_special=set(special or ()), disallowed_special=()), np.uint32(end_id)).astype("<u4")
                cuts = [0, *range(len(got) % capacity or capacity, len(got) + 1, capacity)]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    raw = got[a:b].tobytes()
                    for out, v in zip((at, piece, start, length, ids, crc), (i, k, a, b - a, raw, zlib.crc32(raw)), strict=True):
                        out.append(v)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row").take(pa.array(at, pa.int32())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(ids, pa.binary()), pa.array(crc, pa.int64())], names=schema.names)

    done = packed.mapInArrow(run, schema)
    return done.select(*[F.col(f"row.c{i}").alias(n) for i, n in enumerate(kept)], *PIECE)


def special_tokens(tokenizer: str) -> dict[str, int]:
    """The added tokens of a tokenizer's JSON file and their ids."""
    import json
    with open(tokenizer, encoding="utf-8") as f:
        return {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}


def _encoding(ranks: str, pattern: str, special: dict[str, int]):
    """The vocabulary, built once in a worker process."""
    import base64

    import tiktoken
    from tiktoken import registry
    name = f"chronoroll:{ranks}:{pattern}:{sorted(special.items())}"
    if name not in registry.ENCODINGS:
        with open(ranks, "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        registry.ENCODINGS[name] = tiktoken.Encoding(name, pat_str=pattern, mergeable_ranks=table, special_tokens=special)
    return registry.ENCODINGS[name]


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """The combination of available lengths with the largest sum up to ``room``, longer ones first."""
    reach, steps = 1, []
    limit = (1 << (room + 1)) - 1
    for size in sorted((s for s, c in counts.items() if c and s <= room), reverse=True):
        for _ in range(min(counts[size], room // size)):
            new = (reach | (reach << size)) & limit
            if new == reach:
                break
            steps.append((size, reach))
            reach = new
        if reach >> room & 1:
            break
    fill, out = reach.bit_length() - 1, {}
    for size, before in reversed(steps):
        if not before >> fill & 1:
            out[size] = out.get(size, 0) + 1
            fill -= size
    return out


def combine(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, dict[int, int]]]:
    """(times, lengths and copies) of every combination, for pieces of the counted lengths."""
    left = {s: c for s, c in histogram.items() if c > 0}
    out = []
    while left:
        longest = max(left)
        left[longest] -= 1
        chosen = fullest(left, capacity - longest)
        left[longest] += 1
        chosen[longest] = chosen.get(longest, 0) + 1
        times = min(left[s] // k for s, k in chosen.items())
        for s, k in chosen.items():
            left[s] -= k * times
            if not left[s]:
                del left[s]
        out.append((times, chosen))
    return out


def pack(pieces: DataFrame, *, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (materialised rows with ``length``) with ``sequence_id`` and ``offset``.

    Offsets are gapless from 0 in each sequence. The rows are read several
    times and must be the same each time: give a checkpointed frame.
    """
    own = [n for n in pieces.columns if n not in PLACE]
    rows = pieces.select(*[F.col(W.quoted(n)) for n in own]).withColumn("__row", F.monotonically_increasing_id())
    short = rows.where(F.col("length") < capacity)
    histogram = {int(r["length"]): r["count"] for r in short.groupBy("length").count().collect()}  # below capacity rows
    slots, bins, dealt = [], 0, dict.fromkeys(histogram, 0)
    for times, chosen in combine(histogram, capacity):
        at = 0
        for size in sorted(chosen, reverse=True):
            copies = chosen[size]
            slots.append((size, dealt[size], dealt[size] + times * copies, copies, bins, at))
            dealt[size] += times * copies
            at += size * copies
        bins += times
    spark = pieces.sparkSession
    # below capacity combinations of at most sqrt(2 capacity) different lengths each
    table = spark.createDataFrame(slots, "length long, lo long, hi long, copies long, bin long, at long")

    salts = max(1, ceil(max(histogram.values(), default=0) / RANK_GROUP))
    salted = short.withColumn("__salt", F.pmod(F.xxhash64("__row"), F.lit(salts)))
    ahead = (salted.groupBy("length", "__salt").count()
             .withColumn("__ahead", F.coalesce(F.sum("count").over(
                 Window.partitionBy("length").orderBy("__salt").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
             .drop("count"))
    local = F.row_number().over(Window.partitionBy("length", "__salt").orderBy("__row")) - 1
    ranked = (salted.withColumn("__local", local).join(ahead, ["length", "__salt"])
              .withColumn("__rank", F.col("__local") + F.col("__ahead")))
    t = F.broadcast(table).alias("t")
    r = ranked.alias("r")
    turn = F.col("r.__rank") - F.col("t.lo")
    placed = r.join(t, (F.col("r.length") == F.col("t.length")) & (F.col("r.__rank") >= F.col("t.lo")) & (F.col("r.__rank") < F.col("t.hi")))
    placed = placed.select(*[F.col(f"r.{W.quoted(n)}") for n in own],
                           (F.col("t.bin") + F.floor(turn / F.col("t.copies"))).cast("long").alias("sequence_id"),
                           (F.col("t.at") + F.pmod(turn, F.col("t.copies")) * F.col("t.length")).cast("long").alias("offset"))
    full = rows.where(F.col("length") >= capacity).select(
        *[F.col(W.quoted(n)) for n in own], (F.col("__row") + F.lit(bins)).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return placed.unionAll(full)
