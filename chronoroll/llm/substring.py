"""Substring dedup by level-wise doubling.

A window is a run of consecutive words. Windows of the asked length are not
compared at once: those of half the length come first, and only what repeats
at one length is extended to twice that length, until the asked length is
reached or no candidate survives. On the lower rungs a long window stands on
one of the short windows inside it, the one with the smallest hash, so equal
long windows stand on equal short ones, and only these are compared. On the
last rung every surviving window is, by a 96-bit hash.

Texts are staged as blocks of some megabytes. For each rung a block sends its
distinct hashes, once each however many texts hold them, dealt by hash range,
and gets one bit back for each: whether the window repeats, or, on the last
rung, whether a text with a smaller id starts with it in another block. So a
passage that a third of all texts hold is one hash per block, and what a task
gathers does not grow with how common a passage is.

Defined cases: a null or empty text has no words; rows without an id come
after all others and are equal among themselves, as are rows that repeat an
id (an equal id is not a smaller one); a text shorter than a window loses
nothing; an empty table gives an empty result; other columns of the input are
not carried.
"""

from __future__ import annotations

from itertools import compress
from math import ceil

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from . import words as W

WINDOW = 13
#: Bytes of text in a block, and of hashes that a task compares at once (about).
STAGED_BLOCK, GATHERED = 2 << 20, 16 << 20
_NO_ID = np.iinfo(np.int64).max


def ladder(window: int, rungs: int = 2) -> list[int]:
    """Lengths that end at ``window``, each at most twice the one before."""
    out = [window]
    while len(out) < rungs and out[0] > 1:
        out.insert(0, -(-out[0] // 2))
    return out


def stage(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per block: ``block`` (its number), ``ids``, ``sizes`` (bytes of each text), ``data`` (compressed)."""
    src = docs.select(F.col(W.quoted(doc_id)).cast("long").alias("id"), F.col(W.quoted(text)).cast("string").alias("text"))

    def run(batches):
        pack = zstandard.ZstdCompressor(level=3)
        for batch, buf, off in W.blocks(batches, "text", STAGED_BLOCK):
            yield pa.RecordBatch.from_arrays(
                [pa.array([batch.column("id").to_pylist()], pa.list_(pa.int64())),
                 pa.array([np.diff(off)], pa.list_(pa.int64())),
                 pa.array([pack.compress(buf.tobytes())], pa.binary())], names=["ids", "sizes", "data"])

    rows = src.mapInArrow(run, "ids array<long>, sizes array<long>, data binary")
    path = scratch_path(docs.sparkSession, "blocks")
    rows.withColumn("block", F.monotonically_increasing_id()).write.parquet(path)
    return docs.sparkSession.read.parquet(path)


class Block:
    """The words of a staged block and its windows that may repeat."""

    def __init__(self, ids, sizes, data, rungs: list[int]):
        self.ids = np.array([_NO_ID if i is None else i for i in ids], np.int64)
        raw = zstandard.ZstdDecompressor().decompress(data) if len(data) else b""
        self.buf = np.frombuffer(raw, np.uint8)
        self.off = np.concatenate([[0], np.cumsum(np.asarray(sizes, np.int64))])
        self.start, self.end, self.first = W.split(self.buf, self.off)
        self.window = rungs[-1]
        self.rungs = rungs
        self.h = W.FIRST.runs(self.buf, self.start, self.end)
        self.doc = W.owner(self.first)
        #: Where the windows that are still candidates start.
        self.at = np.flatnonzero(W.inside(self.first, self.window))

    def standing(self, rung: int) -> np.ndarray:
        """For each candidate, the hash of the short window it stands on."""
        g = W.FIRST.windows(self.h, rung)
        span = self.window - rung + 1
        if not len(self.at):
            return np.empty(0, np.uint64)
        least = g[: len(g) - span + 1].copy()
        for j in range(1, span):
            np.minimum(least, g[j: len(g) - span + 1 + j], out=least)
        return least[self.at]

    def low(self, rung: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(distinct hashes in order, candidates' places among them, which occur in two texts here)."""
        s = self.standing(rung)
        order = np.argsort(s, kind="stable")
        srt, doc = s[order], self.doc[self.at][order]
        new = np.ones(len(srt), bool)
        new[1:] = srt[1:] != srt[:-1]
        group = np.cumsum(new) - 1
        place = np.empty(len(s), np.int64)
        place[order] = group
        lead = doc[np.flatnonzero(new)]
        twice = np.zeros(int(new.sum()), bool)
        twice[group[doc != lead[group]]] = True
        return srt[new], place, twice

    def last(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(hashes in order, their second hashes, smallest id of each here, candidates' places)."""
        a = W.FIRST.windows(self.h, self.window)[self.at]
        b = W.SECOND.windows(W.SECOND.runs(self.buf, self.start, self.end), self.window)[self.at].astype(np.uint32)
        order = np.lexsort((b, a))
        sa, sb = a[order], b[order]
        new = np.ones(len(sa), bool)
        new[1:] = (sa[1:] != sa[:-1]) | (sb[1:] != sb[:-1])
        group = np.cumsum(new) - 1
        place = np.empty(len(a), np.int64)
        place[order] = group
        least = np.minimum.reduceat(self.ids[self.doc[self.at]][order], np.flatnonzero(new)) if len(sa) else np.empty(0, np.int64)
        return sa[new], sb[new], least, place

    def keep(self, flags: np.ndarray, place: np.ndarray) -> None:
        self.at = self.at[flags[place]]


def _ranges(hashes: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Borders of the hash ranges within hashes in order, and which ranges have any."""
    part = ((hashes >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
    cut = np.searchsorted(part, np.arange(parts + 1, dtype=np.uint64))
    return cut, np.flatnonzero(np.diff(cut))


def _flags(n: int, hashes: np.ndarray, parts: int, answers) -> np.ndarray:
    """The bits that came back for a block's hashes; ranges without an answer have none set."""
    out = np.zeros(n, bool)
    cut, _ = _ranges(hashes, parts)
    for a in answers or []:
        lo, hi = cut[a["part"]], cut[a["part"] + 1]
        out[lo:hi] = np.unpackbits(np.frombuffer(a["bits"], np.uint8), count=hi - lo).astype(bool)
    return out


def _replay(row, rungs, parts) -> Block:
    """The block with the candidates that survived the answered rungs."""
    block = Block(row["ids"], row["sizes"], row["data"], rungs)
    for k, rung in enumerate(rungs[:-1]):
        if f"bits{k}" not in row:
            break
        hashes, place, _ = block.low(rung)
        block.keep(_flags(len(hashes), hashes, parts[k], row[f"bits{k}"]), place)
    return block


def _rows(batches):
    """Rows one by one: a block is large."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield {n: batch.column(n)[i].as_py() for n in batch.schema.names}
            pa.default_memory_pool().release_unused()


def _ask(staged: DataFrame, rungs: list[int], parts: list[int], k: int) -> DataFrame:
    """Hashes of rung ``k`` by block and hash range."""
    last = k == len(rungs) - 1
    n = parts[k]

    def run(batches):
        for row in _rows(batches):
            block = _replay(row, rungs, parts)
            if last:
                a, b, least, _ = block.last()
                wide = least.astype(np.uint32) if len(least) and least.min() >= 0 and least.max() < 2**32 else least
                cut, some = _ranges(a, n)
                data = [[a[cut[p]:cut[p + 1]].tobytes() for p in some], [b[cut[p]:cut[p + 1]].tobytes() for p in some],
                        [wide[cut[p]:cut[p + 1]].tobytes() for p in some]]
            else:
                h, _, twice = block.low(rungs[k])
                cut, some = _ranges(h, n)
                data = [[h[cut[p]:cut[p + 1]].tobytes() for p in some],
                        [np.packbits(twice[cut[p]:cut[p + 1]]).tobytes() for p in some], [b""] * len(some)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["block"]] * len(some), pa.int64()), pa.array(some, pa.int32()), *[pa.array(d, pa.binary()) for d in data]],
                names=["block", "part", "a", "b", "c"])

    return staged.mapInArrow(run, "block long, part int, a binary, b binary, c binary")


def _answer(asked: DataFrame, last: bool) -> DataFrame:
    """Bits by block and hash range; rows without a set bit are left out."""

    def run(table: pa.Table) -> pa.Table:
        raw = [[x.as_py() for x in table.column(c)] for c in ("a", "b", "c")]
        hashes = [np.frombuffer(x, np.uint64) for x in raw[0]]
        size = np.array([len(x) for x in hashes])
        a = np.concatenate(hashes)
        if last:
            b = np.concatenate([np.frombuffer(x, np.uint32) for x in raw[1]])
            c = np.concatenate([np.frombuffer(x, np.uint32 if len(x) == 4 * m else np.int64).astype(np.int64)
                                for x, m in zip(raw[2], size, strict=True)])
            order = np.lexsort((b, a))
            new = np.ones(len(a), bool)
            new[1:] = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
            least = np.minimum.reduceat(c[order], np.flatnonzero(new))
            bit = np.empty(len(a), bool)
            bit[order] = c[order] > least[np.cumsum(new) - 1]
        else:
            twice = np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=m) for x, m in zip(raw[1], size, strict=True)]).astype(bool)
            order = np.argsort(a, kind="stable")
            srt = a[order]
            new = np.ones(len(a), bool)
            new[1:] = srt[1:] != srt[:-1]
            group = np.cumsum(new) - 1
            again = np.bincount(group) > 1
            again[group[twice[order]]] = True
            bit = np.empty(len(a), bool)
            bit[order] = again[group]
        ends = np.cumsum(size)
        bits = [bit[e - m:e] for e, m in zip(ends, size, strict=True)]
        some = [i for i, x in enumerate(bits) if x.any()]
        return pa.table({"block": table.column("block").take(pa.array(some, pa.int64())), "part": table.column("part").take(pa.array(some, pa.int64())),
                         "bits": pa.array([np.packbits(bits[i]).tobytes() for i in some], pa.binary())})

    return asked.groupBy("part").applyInArrow(run, "block long, part int, bits binary")


def dedup(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, rungs: int = 2) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_words``, ``n_removed`` and ``kept``, the words left, one space between.

    A word goes if a window that covers it also starts in a text with a
    smaller id; windows are judged on the input texts.
    """
    lengths = ladder(window, rungs)
    staged = stage(docs, doc_id=doc_id, text=text)
    n_blocks = staged.count()
    #: Hashes of a block: a fourth of its windows at most on a low rung (8 bytes each), all on the last (16).
    words = STAGED_BLOCK // 6
    parts = [max(16, ceil(n_blocks * words * (2 if k < len(lengths) - 1 else 16) / GATHERED)) for k in range(len(lengths))]
    blocks = staged
    for k in range(len(lengths)):
        last = k == len(lengths) - 1
        bits = _answer(_ask(blocks, lengths, parts, k), last).groupBy("block").agg(F.collect_list(F.struct("part", "bits")).alias(f"bits{k}"))
        # one row for each block, bits only
        bits = W.checkpointed(bits)
        staged = staged.join(bits, "block", "left")
        blocks = staged.where(F.col(f"bits{k}").isNotNull())

    def run(batches):
        for row in _rows(batches):
            block = _replay(row, lengths, parts)
            gone = np.zeros(len(block.h), bool)
            if len(block.at):
                a, _, least, place = block.last()
                other = _flags(len(a), a, parts[-1], row[f"bits{len(lengths) - 1}"])
                mine = block.ids[block.doc[block.at]]
                gone = W.covered(block.at[other[place] | (mine > least[place])], window, len(block.h))
            raw = block.buf.tobytes()
            kept = []
            for i in range(len(block.ids)):
                words = raw[block.off[i]:block.off[i + 1]].split()
                flags = gone[block.first[i]:block.first[i + 1]]
                kept.append(b" ".join(compress(words, ~flags) if flags.any() else words).decode())
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["ids"], pa.int64()), pa.array(np.diff(block.first), pa.int64()),
                 pa.array(W.per_text(gone, block.first), pa.int64()), pa.array(kept, pa.string())], names=["doc_id", "n_words", "n_removed", "kept"])

    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_words", T.LongType()),
                           T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType())])
    return staged.mapInArrow(run, schema)
