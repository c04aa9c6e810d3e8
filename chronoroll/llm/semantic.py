"""Benchmark decontamination by latent semantic retrieval.

The corpus is cut into passages; a passage is a TF-IDF vector over the words
of the benchmark (other words cannot bring a passage nearer to an item). A
randomised SVD of the passage matrix A, by distributed passes that compute
``A'(A X)`` for a thin X, gives a latent space. Items and sliding windows of
the documents are folded into it, on axes of equal variance, and a window is
a candidate for an item if their cosine reaches ``LEAST_COSINE``. The cosine
is worked out only where the two can share enough words at all: of an item's
rarest words, ``HITS`` more than may be missing, a leak must hold ``HITS``, so an
index of these words leaves out no pair that the next test would pass. A candidate
is a leak if the longest common subsequence of the two holds enough of the
item: ``LEAST_SHARE`` of its words together with its answer (most of its last
words), or ``SURE_SHARE`` of them without.

The benchmark is the stated query set. It is read in blocks of
``ITEMS_AT_ONCE`` items; vocabulary, axes and item vectors are bounded by a
block, and all documents are searched for each block. Long items are searched
in parts, each an item of its own.

Defined cases: null or empty texts and items match nothing; parts of fewer
than ``LEAST_WORDS`` words can't be told from chance and are left out; letter
case and punctuation do not count; documents without an id give no rows;
repeated rows and ids give one row for each id and item, the best one (ties:
the first place); an empty table gives an empty result.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from . import words as W

RANK, SPARE, SEED = 64, 16, 5
#: Words of a passage of the statistics, and of the search windows by the length of the item.
PASSAGE, WINDOWS = 48, (24, 32, 48, 64, 96)
LEAST_WORDS, LEAST_COSINE, LEAST_SHARE, SURE_SHARE = 8, 0.3, 0.6, 0.8
ANSWER_WORDS, ANSWER_SHARE = 5, 0.6
ITEMS_AT_ONCE = 2_000
#: Rare words of an item that a window must hold for its cosine to be worked out.
HITS = 4
#: Words, and pairs of a window and an item, that are worked on at once.
_AT_ONCE, _PAIRS = 1 << 15, 512

_WORD = W.Hash(61, fold_case=True)
_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_GAP = ~_ALNUM


def _hashes(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words (runs of letters and digits, case folded) of a block, and each text's first."""
    if len(buf) > 1:
        # capitals of Latin-1 are two bytes in UTF-8, 0x20 below their small letters
        big = np.flatnonzero((buf[:-1] == 0xC3) & (buf[1:] >= 0x80) & (buf[1:] <= 0x9E) & (buf[1:] != 0x97)) + 1
        if len(big):
            buf = buf.copy()
            buf[big] += 0x20
    start, end, first = W.split(buf, off, _GAP)
    return _WORD.runs(buf, start, end), first


class Queries:
    """A block of benchmark items as parts, over the block's own vocabulary."""

    def __init__(self, items: list[tuple[int, str]]):
        raw = [(t or "").encode() for _, t in items]
        h, first = _hashes(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
        self.vocabulary = np.unique(h)
        terms = np.searchsorted(self.vocabulary, h)
        most = WINDOWS[-1] * 3 // 4
        self.item, self.parts = [], []
        for i, (item, _) in enumerate(items):
            own = terms[first[i]:first[i + 1]]
            pieces = max(1, ceil(len(own) / most))
            for part in np.array_split(own, pieces):
                if len(part) >= LEAST_WORDS and item is not None:
                    self.item.append(item)
                    self.parts.append(part)
        lengths = np.array([len(p) for p in self.parts], int)
        #: The smallest window that holds a part whole wherever it stands (steps of a quarter window).
        self.window = np.array([min(w for w in WINDOWS if n <= w * 3 // 4) for n in lengths], int)
        self.least = np.array([ceil(LEAST_SHARE * n) for n in lengths], int)

    def index(self, h: np.ndarray) -> np.ndarray:
        """Places in the vocabulary, its size for words outside it."""
        n = len(self.vocabulary)
        at = np.searchsorted(self.vocabulary, h).clip(0, max(n - 1, 0))
        return np.where(self.vocabulary[at] == h, at, n).astype(np.int32) if n else np.zeros(len(h), np.int32)


def _staged(docs: DataFrame, queries: Queries) -> DataFrame:
    """Documents as places of their words in the vocabulary: (ids, sizes, terms) by block."""

    def run(batches):
        pack = zstandard.ZstdCompressor(level=1)
        for batch, buf, off in W.blocks(batches, "text"):
            h, first = _hashes(buf, off)
            yield pa.RecordBatch.from_arrays(
                [pa.array([batch.column("id").to_pylist()], pa.list_(pa.int64())), pa.array([np.diff(first)], pa.list_(pa.int64())),
                 pa.array([pack.compress(queries.index(h).tobytes())], pa.binary())], names=["ids", "sizes", "terms"])

    path = scratch_path(docs.sparkSession, "terms")
    docs.mapInArrow(run, "ids array<long>, sizes array<long>, terms binary").write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def _blocks(batches):
    unpack = zstandard.ZstdDecompressor()
    for batch in batches:
        for i in range(batch.num_rows):
            raw = batch.column("terms")[i].as_py()
            terms = np.frombuffer(unpack.decompress(raw) if raw else b"", np.int32)
            sizes = np.asarray(batch.column("sizes")[i].values, np.int64)
            yield batch.column("ids")[i].as_py(), terms, np.concatenate([[0], np.cumsum(sizes)])


def _passages(first: np.ndarray) -> np.ndarray:
    """Where the passages of a block's texts start."""
    sizes = np.diff(first)
    count = -(-sizes // PASSAGE)
    begin = np.cumsum(count) - count
    step = np.arange(int(count.sum())) - np.repeat(begin, count)
    return np.repeat(first[:-1], count) + step * PASSAGE


def _document_counts(staged: DataFrame, size: int) -> tuple[int, np.ndarray]:
    """(passages, passages that hold each term)."""

    def run(batches):
        total, seen = 0, np.zeros(size + 1, np.int64)
        for _, terms, first in _blocks(batches):
            starts = _passages(first)
            total += len(starts)
            passage = np.searchsorted(starts, np.arange(len(terms)), "right") - 1
            known = terms < size
            pair = np.unique(passage[known] * np.int64(size) + terms[known])
            seen[:size] += np.bincount(pair % size, minlength=size)
        seen[size] = total
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(seen[at], pa.int64())], names=["term", "n"])

    out = np.zeros(size + 1, np.int64)
    for term, n in staged.select("ids", "sizes", "terms").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n")).collect():
        out[term] = n
    return int(out[size]), out[:size]


def _gram(staged: DataFrame, idf: np.ndarray, x: np.ndarray) -> np.ndarray:
    """``A'(A x)`` over all passages, A being their TF-IDF matrix."""
    size, width = x.shape
    shared = staged.sparkSession.sparkContext.broadcast((idf[:, None] * x).astype(np.float32))  # a block's vocabulary

    def run(batches):
        table, out = shared.value, np.zeros((size, width))
        for _, terms, first in _blocks(batches):
            starts = _passages(first)
            for lo in range(0, len(starts), _AT_ONCE // PASSAGE):
                own = starts[lo:lo + _AT_ONCE // PASSAGE]
                end = starts[lo + len(own)] if lo + len(own) < len(starts) else len(terms)
                t = terms[own[0]:end]
                known = np.flatnonzero(t < size)
                if not len(known):
                    continue
                term = t[known]
                new = np.diff(np.searchsorted(own - own[0], known, "right"), prepend=-1) > 0  # a passage begins
                y = np.add.reduceat(table[term], np.flatnonzero(new), axis=0)
                passage = np.cumsum(new) - 1
                order = np.argsort(term, kind="stable")
                cut = np.flatnonzero(np.diff(term[order], prepend=-1))
                out[term[order][cut]] += np.add.reduceat(y[passage[order]], cut, axis=0)
        at = np.flatnonzero(out.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), *[pa.array(out[at, j]) for j in range(width)]],
                                         names=["term", *[f"v{j}" for j in range(width)]])

    fields = ", ".join(f"v{j} double" for j in range(width))
    summed = staged.mapInArrow(run, f"term long, {fields}").groupBy("term").agg(*[F.sum(f"v{j}").alias(f"v{j}") for j in range(width)])
    out = np.zeros((size, width))
    rows = summed.toArrow()  # a row for each word of the block's vocabulary
    for j in range(width):
        out[rows.column("term").to_numpy(), j] = rows.column(f"v{j}").to_numpy()
    return out * idf[:, None]


def axes(staged: DataFrame, size: int, rank: int = RANK, counts: tuple[int, np.ndarray] | None = None) -> np.ndarray | None:
    """Word vectors (vocabulary x rank) that fold TF-IDF into the latent space, axes of equal variance.

    ``counts``: the passages, and those that hold each word, if they are known.
    """
    passages, seen = counts or _document_counts(staged, size)
    if not passages or not seen.any():
        return None
    idf = np.log((passages + 1) / (seen + 1)) + 1e-3
    width = min(rank + SPARE, size)
    start = np.random.RandomState(SEED).standard_normal((size, width))
    q, _ = np.linalg.qr(_gram(staged, idf, start))
    z = _gram(staged, idf, q)
    values, turn = np.linalg.eigh((q.T @ z + z.T @ q) / 2)
    order = np.argsort(values)[::-1][:rank]
    order = order[values[order] > values[order[0]] * 1e-9]
    return (idf[:, None] * (q @ turn[:, order]) / np.sqrt(values[order])).astype(np.float32)


def common(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence, by bits over ``a``."""
    where: dict[int, int] = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for y in b:
        m = where.get(y)
        if m is not None:
            u = v & m
            v = (v + u) | (v - u)
    return len(a) - (v & full).bit_count()


def _unit(x: np.ndarray) -> np.ndarray:
    size = np.sqrt((x * x).sum(1, keepdims=True))
    return x / np.where(size > 0, size, 1)


class Index:
    """Items of one window length by their rarest words."""

    def __init__(self, queries: Queries, own: np.ndarray, seen: np.ndarray):
        self.own = own
        terms, items = [], []
        for k, p in enumerate(own):
            part = queries.parts[p]
            rare = part[np.argsort(seen[part], kind="stable")][:len(part) - queries.least[p] + HITS]
            terms.append(np.unique(rare))
            items.append(np.full(len(terms[-1]), k))
        terms, items = np.concatenate(terms), np.concatenate(items)
        order = np.argsort(terms, kind="stable")
        self.items = items[order]
        self.at = np.searchsorted(terms[order], np.arange(len(seen) + 2))  # one more for words outside the vocabulary

    def pairs(self, terms: np.ndarray, first: np.ndarray, begin: np.ndarray, count: np.ndarray, w: int) -> tuple[np.ndarray, np.ndarray]:
        """(window, item of ``own``) that share at least HITS places of rare words; ``begin`` and ``count`` are each text's windows."""
        many = self.at[terms + 1] - self.at[terms]
        place = np.flatnonzero(many)
        many = many[place]
        item = self.items[np.repeat(self.at[terms[place]] - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))]
        place = np.repeat(place, many)
        text = np.searchsorted(first, place, "right") - 1
        within, step = place - first[text], w // 4
        low = np.maximum(-(-(within - w + 1) // step), 0)
        high = np.minimum(within // step, count[text] - 1)
        n = high - low + 1
        window = np.repeat(begin[text] + low - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        key, hits = np.unique(window * len(self.own) + np.repeat(item, n), return_counts=True)
        return np.divmod(key[hits >= HITS], len(self.own))


def _search(staged: DataFrame, queries: Queries, vectors: np.ndarray, seen: np.ndarray) -> DataFrame:
    """(doc_id, item_id, cosine, share, start): the best window of each document and item."""
    table = np.vstack([vectors, np.zeros((1, vectors.shape[1]), np.float32)])
    items = _unit(np.stack([vectors[p].sum(0) for p in queries.parts])).astype(np.float32)
    by_window = [(w, Index(queries, np.flatnonzero(queries.window == w), seen)) for w in WINDOWS if (queries.window == w).any()]
    parts = [p.tolist() for p in queries.parts]
    least, item_of, size = queries.least, queries.item, len(queries.vocabulary)
    has_word = np.zeros((len(parts), (size >> 3) + 1), np.uint8)
    for k, p in enumerate(queries.parts):
        np.bitwise_or.at(has_word[k], p >> 3, np.uint8(1) << (p & 7).astype(np.uint8))
    # a block of items: their vectors, words and index
    shared = staged.sparkSession.sparkContext.broadcast((table, items, by_window, parts, least, item_of, has_word))

    def leaks(terms, first, found, ids):
        """Adds the leaks of some texts to ``found``."""
        table, items, by_window, parts, least, _, has_word = shared.value
        padded = np.concatenate([terms, np.full(WINDOWS[-1], size, terms.dtype)])
        sizes = np.diff(first)
        for w, index in by_window:
            count = np.where(sizes > 0, -(-np.maximum(sizes - w, 0) // (w // 4)) + 1, 0)
            begin = np.cumsum(count) - count
            window, item = index.pairs(terms, first, begin, count, w)
            for c in range(0, len(window), _PAIRS):
                own, part = window[c:c + _PAIRS], index.own[item[c:c + _PAIRS]]
                text = np.searchsorted(begin + count, own, "right")
                lo = first[text] + (own - begin[text]) * (w // 4)
                hi = np.minimum(lo + w, first[text + 1])
                there = np.where(np.arange(w) < (hi - lo)[:, None], padded[lo[:, None] + np.arange(w)], size)
                new = np.diff(own, prepend=-1) > 0  # pairs of one window lie together
                vector = _unit(table[there[new]].sum(1, dtype=np.float32))[np.cumsum(new) - 1]
                cosine = np.einsum("ij,ij->i", vector, items[part])
                # words of the window that the item has at all bound the common subsequence
                has = has_word[part[:, None], there >> 3] >> (there & 7).astype(np.uint8) & 1
                has &= there < size
                enough = np.flatnonzero((cosine >= LEAST_COSINE) & (has.sum(1, dtype=np.int32) >= least[part]))
                for j in enough.tolist():
                    confirm(parts[part[j]], part[j], terms[lo[j]:hi[j]].tolist(), ids[text[j]],
                            float(cosine[j]), int(lo[j] - first[text[j]]), found)

    def confirm(mine, part, there, doc, cosine, start, found):
        least, item_of = shared.value[4:6]
        held = set(there)
        if doc is None or sum(x in held for x in mine) < least[part]:
            return
        n = common(mine, there)
        if n < least[part]:
            return
        answer = mine[-ANSWER_WORDS:]
        if n < SURE_SHARE * len(mine) and common(answer, there) < ANSWER_SHARE * len(answer):
            return
        key, new = (doc, item_of[part]), (n / len(mine), cosine, start)
        if key not in found or (new[0], new[1]) > found[key][:2]:
            found[key] = new

    def run(batches):
        for ids, terms, first in _blocks(batches):
            found: dict = {}
            i = 0
            while i < len(ids):
                j = max(int(np.searchsorted(first, first[i] + _AT_ONCE, "right")) - 1, i + 1)
                leaks(terms[first[i]:first[j]], first[i:j + 1] - first[i], found, ids[i:j])
                i = j
            keys = list(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64()),
                 pa.array([found[k][1] for k in keys], pa.float64()), pa.array([found[k][0] for k in keys], pa.float64()),
                 pa.array([found[k][2] for k in keys], pa.int64())], names=["doc_id", "item_id", "cosine", "share", "start"])

    return staged.mapInArrow(run, RESULT)


RESULT = "doc_id long, item_id long, cosine double, share double, start long"


def leaks(docs: DataFrame, benchmark: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
          item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """A row for each document and benchmark item it holds: ``doc_id``, ``item_id``, the ``cosine`` and the
    ``share`` of the item's words (of its best part) in common order, and the ``start`` (in words) of the window."""
    spark = docs.sparkSession
    src = docs.select(F.col(W.quoted(doc_id)).cast("long").alias("id"), F.col(W.quoted(text)).cast("string").alias("text"))
    items = benchmark.select(F.col(W.quoted(item_id)).cast("long").alias("id"), F.col(W.quoted(item_text)).cast("string").alias("text"))
    items = items.where("id is not null and text is not null")
    blocks = max(1, ceil(items.count() / ITEMS_AT_ONCE))
    out = spark.createDataFrame([], RESULT)
    for b in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b).orderBy("id", "text").collect()
        queries = Queries([(r["id"], r["text"]) for r in rows])
        if not queries.parts:
            continue
        staged = _staged(src, queries)
        counts = _document_counts(staged, len(queries.vocabulary))
        vectors = axes(staged, len(queries.vocabulary), counts=counts)
        if vectors is not None:
            out = out.unionAll(_search(staged, queries, vectors, counts[1]))
    best = F.max_by(F.struct("cosine", "share", "start"), F.struct("share", "cosine", -F.col("start"))).alias("best")
    return out.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.cosine", "best.share", "best.start")
