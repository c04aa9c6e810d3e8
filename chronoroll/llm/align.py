"""Alignment of two tokenizers' tokens over the same bytes, by lockstep merging of their ends.

One NumPy state holds a pointer into the A tokens and one into the B tokens of
every document of a block. Each step emits the link of all pointed pairs,
advances the pointers whose token ends first (both where the ends agree, which
cuts a group) and drops finished documents from the state. A document longer
than ``LANE`` A tokens takes several places in the state, each with its own
stretch of A tokens, so the number of steps does not grow with the longest
text; where a stretch starts among the B tokens is found by binary search.

Links are kept as one byte a step (which pointers advanced), beside the A ids;
a B id as its place among the block's partners of the A id that it begins in.
Counting takes two shuffles of distinct id pairs, never of links: each block
counts its own pairs first, the pairs are summed, and each block gets back the
counts of the pairs it holds. The rest is done block by block.

Blocks hold about ``BLOCK`` bytes of text, or one longer text, which
bounds memory. Defined cases: a null or empty text, and one whose joined A or
B bytes are not a space and the text, has no tokens: all figures are 0 and
``groups`` is empty; repeated rows are documents each; an empty table gives an
empty result; extra columns are carried without the text, those named like a
result column are replaced.
"""

from __future__ import annotations

import hashlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words as W
from .pieces import Model

FIELDS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")
#: A tokens of one place in the state, and bytes of text in a block.
LANE, BLOCK = 512, 1 << 20
#: Row groups of the table of blocks: a row holds a whole block.
_ROW_GROUP = 16 << 20


class Ranks:
    """Byte-level vocabulary A of a rank file, without special tokens."""

    def __init__(self, data: bytes, pattern: str):
        import base64

        import tiktoken
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines())}
        self.encoding = tiktoken.Encoding("a", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.surface = [b""] * (max(table.values()) + 1)
        for token, i in table.items():
            self.surface[i] = token
        self.width = np.array([len(t) for t in self.surface])

    @staticmethod
    def of(data: bytes, pattern: str) -> Ranks:
        held = W._held()
        key = "ranks" + hashlib.sha256(pattern.encode() + data).hexdigest()
        if key not in held:
            held[key] = Ranks(data, pattern)
        return held[key]


def lockstep(a_end: np.ndarray, a_cut: np.ndarray, b_end: np.ndarray, b_cut: np.ndarray,
             lane: int = LANE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(A token, B token, move) of every link, in order of the tokens.

    ``a_end`` and ``b_end`` are ends of tokens in bytes of the whole block (they
    grow from one document to the next), ``a_cut`` and ``b_cut`` each
    document's first token. A move has bit 1 where A advances, bit 2 where B does.
    """
    n = np.diff(a_cut)
    lanes = -(-n // lane)
    doc = np.repeat(np.arange(len(n)), lanes)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
    a = a_cut[doc] + nth * lane
    stop = np.minimum(a + lane, a_cut[doc + 1])
    # the first B token that ends behind the place where the stretch starts
    b = np.where(nth > 0, np.searchsorted(b_end, a_end[a - 1], "right"), b_cut[doc]) if len(a) else a
    out_a, out_b, out_m = [], [], []
    while len(a):
        ends_a, ends_b = a_end[a], b_end[b]
        on_a, on_b = ends_a <= ends_b, ends_b <= ends_a
        out_a.append(a)
        out_b.append(b)
        out_m.append(on_a + 2 * on_b)
        a = a + on_a
        b = b + on_b
        left = a < stop
        if not left.all():
            a, b, stop = a[left], b[left], stop[left]
    if not out_a:
        return a, a, a
    a, b, m = np.concatenate(out_a), np.concatenate(out_b), np.concatenate(out_m)
    order = np.argsort(a + b)  # grows at every step, from document to document too
    return a[order], b[order], m[order]


def _encode(texts: list[str], a: Ranks, b: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(A ids, their number by text, B ids, their number by text); none for a text whose bytes don't agree."""
    ids_a, ids_b = [], b.own.encode(texts, num_threads=1)
    for i, t in enumerate(texts):
        whole = b" " + t.encode()
        x = a.encoding.encode_ordinary(" " + t) if t else []
        if b"".join([a.surface[y] for y in x]) != whole or b"".join([b.surface[y] for y in ids_b[i]]) != whole:
            x, ids_b[i] = [], []
        ids_a.append(x)
    n_a, n_b = (np.array([len(x) for x in ids], np.int64) for ids in (ids_a, ids_b))
    flat_a, flat_b = (np.fromiter(chain.from_iterable(ids), np.int64, int(n.sum())) for ids, n in ((ids_a, n_a), (ids_b, n_b)))
    return flat_a, n_a, flat_b, n_b


def _pack(values: np.ndarray, n: int) -> bytes:
    """Numbers below ``n``, compressed: low bytes first, then the next ones."""
    raw = values.astype(_dtype(n))
    planes = np.ascontiguousarray(raw.view(np.uint8).reshape(len(raw), raw.itemsize).T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unpack(data: bytes, count: int, n: int) -> np.ndarray:
    kind = np.dtype(_dtype(n))
    raw = np.frombuffer(pa.decompress(data, count * kind.itemsize, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(raw.reshape(kind.itemsize, count).T).view(kind).reshape(count).astype(np.int64)


def _dtype(n: int) -> str:
    return "u1" if n <= 1 << 8 else "<u2" if n <= 1 << 16 else "<u4"


def _stage(docs: DataFrame, kept: list[str], text: str, shared, pattern: str) -> DataFrame:
    """One row a block: its rows, ids, moves, sizes by document, and its distinct id pairs with their documents."""
    rest = [F.col(W.quoted(c)).alias(f"c{i}") for i, c in enumerate(kept)]
    packed = docs.select(F.struct(F.lit(0).alias("none"), *rest).alias("row"), F.col(W.quoted(text)).cast("string").alias("text"))
    binary = ("a", "b", "moves", "sizes", "pairs", "docs")
    schema = T.StructType([T.StructField("block", T.LongType()), T.StructField("rows", T.ArrayType(packed.schema["row"].dataType)),
                           *[T.StructField(c, T.BinaryType()) for c in binary]])

    def run(batches):
        ranks, model = Ranks.of(shared.value[0], pattern), Model.of(shared.value[1])
        task = TaskContext.get().partitionId() << 32
        for k, (batch, _, _) in enumerate(W.blocks(batches, "text", BLOCK)):
            a, n_a, b, n_b = _encode([t or "" for t in batch.column("text").to_pylist()], ranks, model)
            a_cut, b_cut = np.append(0, np.cumsum(n_a)), np.append(0, np.cumsum(n_b))
            at_a, at_b, moves = lockstep(np.cumsum(ranks.width[a]), a_cut, np.cumsum(model.bytes_of[b]), b_cut)
            doc = np.searchsorted(a_cut, at_a, "right") - 1
            space = len(ranks.surface) * len(model.surface)
            pair = np.unique(doc * space + a[at_a] * len(model.surface) + b[at_b]) % space
            pair, held = np.unique(pair, return_counts=True)
            sizes = np.stack([n_a, n_b, np.bincount(doc, minlength=len(n_a))], 1)
            start = np.flatnonzero(np.diff(at_b, prepend=-1))  # the first link of each B token
            of_a = a[at_a[start]] * len(model.surface)
            nth = np.searchsorted(pair, of_a + b) - np.searchsorted(pair, of_a)
            data = (_pack(a, len(ranks.surface)), _pack(nth, len(model.surface)), _pack(moves, 4),
                    sizes.astype("<i8").tobytes(), pair.astype("<i8").tobytes(), held.astype("<i4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array([task + k], pa.int64()), pa.ListArray.from_arrays(pa.array([0, batch.num_rows], pa.int32()), batch.column("row")),
                 *[pa.array([x], pa.binary()) for x in data]], names=schema.names)

    return packed.mapInArrow(run, schema)


def _pairs(staged: DataFrame) -> DataFrame:
    """(block, pair, n): how many of a block's documents hold an id pair linked."""

    def run(batches):
        for batch in batches:
            for block, pairs, docs in zip(*[batch.column(c).to_pylist() for c in ("block", "pairs", "docs")]):
                pair = np.frombuffer(pairs, "<i8")
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(pair), block), pa.int64()), pa.array(pair, pa.int64()),
                                                  pa.array(np.frombuffer(docs, "<i4"), pa.int32())], names=["block", "pair", "n"])

    return staged.select("block", "pairs", "docs").mapInArrow(run, "block long, pair long, n int")


def counts(pairs: DataFrame, n_b: int) -> DataFrame:
    """(pair, docs, best) of all id pairs ``a * n_b + b``: documents that hold it linked, whether no pair of its A id has more."""
    total = pairs.groupBy("pair").agg(F.sum("n").alias("docs"))
    of_a = Window.partitionBy(F.expr(f"pair div {n_b}"))  # at most as many rows as B has tokens
    return total.withColumn("best", F.col("docs") == F.max("docs").over(of_a))


def align(docs: DataFrame, ranks: str, pattern: str, model: str, *, text: str = "text") -> DataFrame:
    """``docs`` without the text, with the columns of FIELDS.

    ``ranks`` is the rank file of vocabulary A, which encodes a space and the
    text after splitting it by ``pattern``; ``model`` the model file of B.
    ``groups`` lists the ids of each group, ``a1,a2|b1;a3|b2,b3``; links are
    pairs of tokens whose bytes overlap; ``n_best`` counts those whose pair is
    its A id's most frequent one, ``count_sum`` sums the pairs' counts.
    """
    from ..session import scratch_path
    spark = docs.sparkSession
    raw = []
    for path in (ranks, model):
        with open(path, "rb") as f:
            raw.append(f.read())
    n_a, n_b = len(Ranks.of(raw[0], pattern).surface), len(Model.of(raw[1]).surface)
    kept = [n for n in docs.columns if n != text and n not in FIELDS]
    rows_type = docs.select(*[F.col(W.quoted(c)).alias(f"c{i}") for i, c in enumerate(kept)]).schema
    path = scratch_path(spark, "align")
    _stage(docs, kept, text, spark.sparkContext.broadcast(tuple(raw)), pattern).write.option(
        "compression", "zstd").option("parquet.block.size", _ROW_GROUP).parquet(path)  # two vocabularies' files are broadcast
    staged = spark.read.parquet(path)
    pairs = _pairs(staged)
    found = (pairs.select("block", "pair").join(counts(pairs.select("pair", "n"), n_b), "pair")
             .groupBy("block").agg(F.collect_list(F.struct("pair", "docs", "best")).alias("table")))  # one block's pairs
    joined = staged.select("block", "rows", "a", "b", "moves", "sizes").join(
        found.hint("shuffle_hash"), "block", "left").select("rows", "a", "b", "moves", "sizes", "table")
    figures = T.StructType([T.StructField(c, T.LongType()) for c in FIELDS[:-1]] + [T.StructField(FIELDS[-1], T.StringType())])
    schema = T.StructType([T.StructField("row", T.StructType([T.StructField("none", T.IntegerType()), *rows_type.fields])), *figures.fields])

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                yield _judge(batch.slice(i, 1), n_a, n_b, schema.names)
                pa.default_memory_pool().release_unused()

    done = joined.mapInArrow(run, schema)
    return done.select(*[F.col(f"row.c{i}").alias(n) for i, n in enumerate(kept)], *FIELDS)


def _judge(block: pa.RecordBatch, n_a: int, n_b: int, names: list[str]) -> pa.RecordBatch:
    """The documents of a block with their figures."""
    sizes = np.frombuffer(block.column("sizes")[0].as_py(), "<i8").reshape(-1, 3)
    a, nth, moves = (_unpack(block.column(c)[0].as_py(), int(m), n) for c, m, n in zip(("a", "b", "moves"), sizes.sum(0), (n_a, n_b, 4)))
    on_a, on_b = moves & 1, moves >> 1
    at_a, at_b = np.cumsum(on_a) - on_a, np.cumsum(on_b) - on_b
    links = np.append(0, np.cumsum(sizes[:, 2]))
    b = best = docs = np.empty(0, np.int64)
    if len(moves):
        table = block.column("table").flatten()
        pair, held, top = (table.field(c).to_numpy(zero_copy_only=False) for c in ("pair", "docs", "best"))
        order = np.argsort(pair)
        pair, held, top = pair[order], held[order], top[order].astype(np.int64)
        start = np.flatnonzero(np.diff(at_b, prepend=-1))
        b = pair[np.searchsorted(pair, a[at_a[start]] * n_b) + nth] % n_b
        place = np.searchsorted(pair, a[at_a] * n_b + b[at_b])
        best, docs = top[place], held[place]
    cut = moves == 3
    figures = [sizes[:, 0], sizes[:, 1], W.per_text(cut, links), sizes[:, 2], W.per_text(best, links), W.per_text(docs, links)]
    return pa.RecordBatch.from_arrays(
        [block.column("rows").flatten(), *[pa.array(x, pa.int64()) for x in figures],
         _groups(a, b, at_a[cut], at_b[cut], sizes)], names=names)


def _groups(a: np.ndarray, b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """``a1,a2|b1;a3|b2,b3`` for each document; ``last_a`` and ``last_b`` end the groups."""
    # an A token stands behind the B tokens of the groups before its own, a B token behind the A tokens of its own too
    size_a, size_b = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)
    to_a = np.arange(len(a)) + np.repeat(last_b + 1 - size_b, size_a)
    to_b = np.arange(len(b)) + np.repeat(last_a + 1, size_b)
    code = np.empty(len(a) + len(b), np.int64)
    code[to_a], code[to_b] = a * 4, b * 4
    code[to_a[last_a]] += 1
    code[to_b[last_b]] += 2
    ends = np.cumsum(sizes[:, 0] + sizes[:, 1])
    code[ends[sizes[:, 0] > 0] - 1] += 1  # nothing follows a document's last token
    text, width = _names(int(code.max(initial=0)) // 4 + 1)
    size = width[code]
    chars = text[code][np.arange(text.shape[1]) < size[:, None]]
    off = np.append(0, np.append(0, np.cumsum(size))[ends])
    return pa.Array.from_buffers(pa.large_string(), len(sizes), [None, pa.py_buffer(off.astype(np.int64)), pa.py_buffer(chars)]).cast(pa.string())


def _names(n: int) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, length) of decimal ids, each with the four marks that can follow it."""
    held = W._held()
    if len(held.get("decimal", ((),))[0]) < 4 * n:
        names = np.array([f"{i}{mark}".encode() for i in range(n) for mark in (",", "|", ";", "")])
        held["decimal"] = names.view(np.uint8).reshape(4 * n, -1), np.char.str_len(names)
    return held["decimal"]
