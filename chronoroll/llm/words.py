"""Words of whole texts, split and hashed over Arrow buffers without Python strings.

A word is a run of bytes outside ``[\\x20\\x09-\\x0D]``. Every function works
on a block of documents: one byte buffer and the offsets of its texts. Blocks
hold about ``BLOCK`` bytes (a longer text is a block of its own), so memory
does not grow with the batch. Hashes are polynomials over a random value per
byte, mixed afterwards; two independent ones make a 128-bit key.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from types import ModuleType

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCK = 2 << 20
#: Bytes hashed at once; only a single word longer than this needs more.
_SEGMENT = 1 << 17

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def _random(seed: int, n: int) -> np.ndarray:
    return np.random.RandomState(seed).randint(0, 2**63 - 1, size=n).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _held() -> dict:
    """A dictionary of the worker process itself.

    This module travels with every task by value; what it held in its own
    variables would be a new copy each time, and garbage after the task.
    """
    return sys.modules.setdefault("_chronoroll_powers", ModuleType("_chronoroll_powers")).__dict__


class Hash:
    """One hash function of byte runs and of runs of such hashes."""

    def __init__(self, seed: int, fold_case: bool = False):
        self.table = _random(seed, 256)
        if fold_case:
            self.table[65:91] = self.table[97:123]
        self.base = int(_random(seed + 1, 1)[0])
        self.inverse = pow(self.base, -1, 1 << 64)

    def powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Powers of the base and of its inverse; kept for segments of the usual size."""
        held = _held()
        key = f"h{self.base}"
        if key in held and len(held[key][0]) >= n:
            return held[key]
        out = []
        for b in (self.base, self.inverse):
            p = np.full(n, b, np.uint64)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        if n <= _SEGMENT + 1:
            held[key] = (out[0], out[1])
        return out[0], out[1]

    def runs(self, buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of the byte runs ``buf[start:end]`` (runs in order)."""
        out = np.empty(len(start), np.uint64)
        a = 0
        while a < len(start):
            b = max(int(np.searchsorted(end, start[a] + _SEGMENT, "right")), a + 1)
            lo, hi = int(start[a]), int(end[b - 1])
            p, inv = self.powers(max(hi - lo + 1, _SEGMENT + 1))
            c = np.zeros(hi - lo + 1, np.uint64)
            np.cumsum(self.table[buf[lo:hi]] * p[: hi - lo], out=c[1:])
            s, e = start[a:b] - lo, end[a:b] - lo
            out[a:b] = mix((c[e] - c[s]) * inv[s] + (e - s).astype(np.uint64))
            a = b
        return out

    def windows(self, h: np.ndarray, k: int) -> np.ndarray:
        """Hashes of the windows of ``k`` consecutive hashes (``len(h) - k + 1`` of them)."""
        n = len(h) - k + 1
        if n <= 0:
            return np.empty(0, np.uint64)
        out = h[:n].copy()
        for j in range(1, k):
            out *= np.uint64(self.base)
            out += h[j:j + n]
        return mix(out)


FIRST, SECOND = Hash(11), Hash(23)


def text_block(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (one more than texts) of a string array; null is empty."""
    if arr.null_count:
        arr = arr.fill_null("")
    kind = np.int64 if pa.types.is_large_string(arr.type) else np.int32
    off = np.frombuffer(arr.buffers()[1], kind, count=arr.offset + len(arr) + 1)[arr.offset:] if arr.buffers()[1] else np.zeros(len(arr) + 1, kind)
    off = off.astype(np.int64)
    data = arr.buffers()[2]
    buf = np.frombuffer(data, np.uint8)[off[0]:off[-1]] if data is not None else np.empty(0, np.uint8)
    return buf, off - off[0]


def blocks(batches, column: str, size: int = BLOCK) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches with about ``size`` bytes of ``column`` each, its bytes and offsets."""
    for batch in batches:
        buf, off = text_block(batch.column(column))
        lo = 0
        while lo < batch.num_rows:
            hi = max(int(np.searchsorted(off, off[lo] + size, "right")) - 1, lo + 1)
            yield batch.slice(lo, hi - lo), buf[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
            lo = hi


def split(buf: np.ndarray, off: np.ndarray, space: np.ndarray = IS_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, first): byte range of each word, and each text's first word (one more than texts)."""
    if not len(buf):
        none = np.empty(0, np.int64)
        return none, none, np.zeros(len(off), np.int64)
    word = ~space[buf]
    before = np.empty_like(word)
    before[0] = False
    before[1:] = word[:-1]
    before[off[off < len(buf)]] = False
    after = np.empty_like(word)
    after[-1] = False
    after[:-1] = word[1:]
    after[off[off > 0] - 1] = False
    start = np.flatnonzero(word & ~before)
    end = np.flatnonzero(word & ~after) + 1
    return start, end, np.searchsorted(start, off)


def owner(first: np.ndarray) -> np.ndarray:
    """The text that each word belongs to."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def inside(first: np.ndarray, k: int) -> np.ndarray:
    """Whether the window of ``k`` words that starts at each word ends in the same text."""
    n = int(first[-1])
    last = np.repeat(first[1:], np.diff(first))
    return (np.arange(n) + k <= last)[: max(n - k + 1, 0)]


def per_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of ``values`` (one each word or byte) by text."""
    c = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=c[1:])
    return c[first[1:]] - c[first[:-1]]


def covered(at: np.ndarray, k: int, n: int) -> np.ndarray:
    """Which of ``n`` words lie in a window of ``k`` words that starts in ``at``."""
    d = np.zeros(n + 1, np.int32)
    np.add.at(d, at, 1)
    np.add.at(d, at + k, -1)
    return np.cumsum(d[:n]) > 0


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the cluster's checkpoint folder, its lineage cut."""
    from ..session import shared_dir  # here: this module goes to the workers, the other does not
    shared_dir(df.sparkSession)
    return df.checkpoint()


def quoted(name: str) -> str:
    """A column name of any characters as a reference."""
    return "`" + name.replace("`", "``") + "`"


def add_columns(df: DataFrame, text: str, fields: dict[str, T.DataType],
                measure: Callable[[np.ndarray, np.ndarray], dict[str, np.ndarray]]) -> DataFrame:
    """``df`` with the columns that ``measure(bytes, offsets)`` gives for blocks of ``text``.

    Columns of ``df`` named like a new one are replaced; the others keep
    names, types and order, new columns come last.
    """
    kept = [n for n in df.columns if n not in fields]
    rest = [F.col(quoted(n)).alias(f"c{i}") for i, n in enumerate(kept) if n != text]
    packed = df.select(F.struct(F.lit(0).alias("none"), *rest).alias("row"), F.col(quoted(text)).cast("string").alias("text"))
    schema = T.StructType([*packed.schema.fields, *[T.StructField(f"m{i}", t) for i, t in enumerate(fields.values())]])
    kinds = [pa_type(t) for t in fields.values()]

    def run(batches):
        for batch, buf, off in blocks(batches, "text"):
            new = measure(buf, off)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *[pa.array(new[n], k) for n, k in zip(fields, kinds, strict=True)]],
                names=schema.names)

    done = packed.mapInArrow(run, schema)
    back = [F.col("text").alias(n) if n == text else F.col(f"row.c{i}").alias(n) for i, n in enumerate(kept)]
    return done.select(*back, *[F.col(f"m{i}").alias(n) for i, n in enumerate(fields)])


def pa_type(t: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(t)
