"""Near-duplicate groups by an LSH forest over MinHash signatures.

A text's set is its distinct word shingles. Texts with the same set form a
class, which one text stands for from here on, so copies never meet as pairs.
A signature of MinHash values is cut into several runs; the classes are
sorted by each run (one tree of the forest each) and a class is compared with
its neighbours in every order. Neighbours share the longest prefix there is:
in a sparse region few values must agree, in a dense one many, so the depth
adapts to the region. A neighbour becomes a candidate if it shares at least
``LEAST_DEPTH`` values and a small sketch of the whole signature makes the
threshold possible. Candidates are confirmed on the full sets, the most
likely ones first; pairs already in one component are not looked at again. A
class that failed against a member of a group is also held against the
group's best linked members: in a group of copies of one text these are the
text itself and its lightest edits.

Where more classes share a whole run than have each other as neighbours, as
texts around one template do, the order says no more. The classes of such
dense runs meet in an exact join besides (a prefix filter): two sets that
overlap enough share one of the first shingles of each in any common order,
here the rarest first. Two classes that share a run are thus neighbours or
both in the exact join: the first and last rows of every sorted partition meet
once more across its borders. Pairs already in one component are left out of it.

Components come from alternating star contractions, which need a number of
rounds logarithmic in the longest path.

Defined cases: a text without words has no shingles and is linked with
nothing; a text with fewer words than a shingle has its whole sequence as one;
a row without an id is linked with nothing and has no component; rows that
repeat an id share a node; ties in likelihood go to the smaller id; an empty
table gives an empty result; other columns are not carried.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from . import words as W

SHINGLE, PERCENT = 5, 80
TREES, DEPTH, LEAST_DEPTH, NEIGHBOURS = 20, 7, 3, 4
#: Values of the signature in the sketch (4 bits each), and the least estimate that is confirmed:
#: nearly four standard errors below the threshold.
SKETCH, LEAST_ESTIMATE = 128, 0.66
#: Likeliest candidates of a class that are confirmed first, and members that stand for a group.
FIRST_TRIES, HUBS = 3, 4
#: Counters that order shingles by rarity (collisions cost time only), and rows of one side of the exact join in a salt.
RARITY, SALT_ROWS = 1 << 18, 1000
#: Edges of a task of a contraction round: a round's work is small, its tasks are as few as the edges ask for.
TASK_EDGES = 20_000

_WORD = W.Hash(41, fold_case=True)
_MULTIPLY = W._random(51, TREES * DEPTH)
_ADD = W._random(52, TREES * DEPTH)


def shingles(buf: np.ndarray, off: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of each text in a block (with repeats) and each text's first (one more than texts)."""
    start, end, first = W.split(buf, off)
    h = _WORD.runs(buf, start, end)
    count = np.diff(first)
    whole = (count > 0) & (count < size)
    win = _WORD.windows(h, size) if size > 1 else W.mix(h)
    at = np.flatnonzero(W.inside(first, size))
    doc = W.owner(first)[at]
    values = win[at]
    if whole.any():
        few = np.flatnonzero(whole)
        short = np.array([xxhash.xxh3_64_intdigest(h[first[i]:first[i + 1]].tobytes(), seed=7) for i in few], np.uint64)
        doc = np.concatenate([doc, few])
        values = np.concatenate([values, short])
        order = np.argsort(doc, kind="stable")
        doc, values = doc[order], values[order]
    return values, np.searchsorted(doc, np.arange(len(off)))


def _features(docs: DataFrame, size: int) -> DataFrame:
    """(id, n, key, signature): distinct shingles, a 128-bit key of the set, and the MinHash values."""

    def run(batches):
        for batch, buf, off in W.blocks(batches, "text"):
            values, first = shingles(buf, off, size)
            n = np.zeros(len(off) - 1, np.int64)
            keys: list = [None] * len(n)
            for i in np.flatnonzero(np.diff(first)):
                own = np.unique(values[first[i]:first[i + 1]])
                n[i] = len(own)
                keys[i] = xxhash.xxh3_128_digest(own.tobytes())
            some = np.flatnonzero(n)
            signature = np.empty((len(some), TREES * DEPTH), ">u4")
            if len(some):
                for k in range(TREES * DEPTH):
                    signature[:, k] = np.minimum.reduceat(values * _MULTIPLY[k] + _ADD[k], first[some]) >> np.uint64(32)
            signatures: list = [None] * len(n)
            for j, i in enumerate(some):
                signatures[i] = signature[j].tobytes()
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(n), pa.array(keys, pa.binary()), pa.array(signatures, pa.binary())],
                                             names=["id", "n", "key", "signature"])

    return docs.mapInArrow(run, "id long, n long, key binary, signature binary")


def _trees(classes: DataFrame) -> DataFrame:
    """A row for each class and tree: (tree, prefix, node, sketch)."""

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 2000):
                part = batch.slice(lo, 2000)
                m = part.num_rows
                sig = np.frombuffer(b"".join(part.column("signature").to_pylist()), ">u4").reshape(m, TREES * DEPTH)
                low = (sig[:, :SKETCH] & 15).astype(np.uint8)
                sketch = pa.array([r.tobytes() for r in low[:, ::2] << 4 | low[:, 1::2]], pa.binary())
                for t in range(TREES):
                    run_of = np.ascontiguousarray(sig[:, t * DEPTH:(t + 1) * DEPTH])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(m, t, np.int32)), pa.array([r.tobytes() for r in run_of], pa.binary()), part.column("node"), sketch],
                        names=["tree", "prefix", "node", "sketch"])

    return classes.select("node", "signature").mapInArrow(run, "tree int, prefix binary, node long, sketch binary")


_ROW = ("tree", "prefix", "node", "sketch", "part")
_EDGE = pa.struct([("tree", pa.int32()), ("prefix", pa.binary()), ("node", pa.int64()), ("sketch", pa.binary()), ("part", pa.int32())])


def _neighbours(ordered: DataFrame) -> DataFrame:
    """Candidates (a, b, estimate) with a < b from the rows of each sorted partition, and the rows at its borders.

    A border row has nulls for a pair and itself as ``edge``. Rows that come with the number of their partition
    (``part``) are border rows themselves: only pairs of two partitions are candidates then.
    """
    again = "part" in ordered.columns

    def pairs_of(rows, old):
        tree, prefix, node, sketch, part = rows
        for j in range(1, NEIGHBOURS + 1):
            second = np.arange(max(old, j), len(node))
            first = second - j
            ok = (tree[first] == tree[second]) & (prefix[first, :LEAST_DEPTH] == prefix[second, :LEAST_DEPTH]).all(1)
            if again:
                ok &= part[first] != part[second]
            first, second = first[ok], second[ok]
            x = sketch[first] ^ sketch[second]
            agree = ((x & 15 == 0).sum(1) + (x & 240 == 0).sum(1)) / SKETCH
            estimate = (agree - 1 / 16) * (16 / 15)
            ok = (estimate >= LEAST_ESTIMATE) & (node[first] != node[second])
            u, v = node[first[ok]], node[second[ok]]
            yield np.minimum(u, v), np.maximum(u, v), estimate[ok]

    def edges_of(rows):
        tree, prefix, node, sketch, part = rows
        m = len(node)
        own = [pa.array(tree, pa.int32()), pa.array([r.tobytes() for r in prefix], pa.binary()), pa.array(node, pa.int64()),
               pa.array([r.tobytes() for r in sketch], pa.binary()), pa.array(part, pa.int32())]
        return pa.RecordBatch.from_arrays([pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.float64()),
                                           pa.StructArray.from_arrays(own, fields=list(_EDGE))], names=["a", "b", "estimate", "edge"])

    def run(batches):
        held, head, total = None, None, 0
        for batch in batches:
            m = batch.num_rows
            if not m:
                continue
            part = np.asarray(batch.column("part")) if again else np.full(m, TaskContext.get().partitionId(), np.int32)
            now = [np.asarray(batch.column("tree")), np.frombuffer(b"".join(batch.column("prefix").to_pylist()), ">u4").reshape(m, DEPTH),
                   np.asarray(batch.column("node")), np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint8).reshape(m, SKETCH // 2), part]
            old = 0 if held is None else len(held[0])
            rows = now if held is None else [np.concatenate(x) for x in zip(held, now, strict=True)]
            out = [np.concatenate(x) for x in zip(*pairs_of(rows, old), strict=True)]
            if total < NEIGHBOURS:
                lead = [x[:NEIGHBOURS - total] for x in now]
                head = lead if head is None else [np.concatenate(x) for x in zip(head, lead, strict=True)]
            total += m
            held = [x[-NEIGHBOURS:] for x in rows]
            yield pa.RecordBatch.from_arrays([*map(pa.array, out), pa.nulls(len(out[0]), _EDGE)], names=["a", "b", "estimate", "edge"])
        if total and not again:
            yield edges_of(head)
            last = min(NEIGHBOURS, total - len(head[0]))  # those that are not among the first
            if last > 0:
                yield edges_of([x[-last:] for x in held])

    edge = "struct<tree:int,prefix:binary,node:long,sketch:binary,part:int>"
    return ordered.mapInArrow(run, f"a long, b long, estimate double, edge {edge}")


def _candidates(trees: DataFrame, tasks: int | None = None) -> DataFrame:
    """(a, b, estimate) of every two classes that stand at most NEIGHBOURS places apart in the order of a tree.

    The border rows of the partitions (at most 2 NEIGHBOURS of each, whatever it holds) are sorted once more, in one
    task that streams them; a pair found there may be among the others too.
    """
    order = ["tree", "prefix", "node"]
    ranged = trees.repartitionByRange(tasks, *order) if tasks else trees.repartitionByRange(*order)
    found = W.checkpointed(_neighbours(ranged.sortWithinPartitions(*order)).groupBy("a", "b", "edge").agg(F.first("estimate").alias("estimate")))
    edges = found.where("edge is not null").select(*[F.col(f"edge.{c}").alias(c) for c in _ROW])
    across = _neighbours(edges.coalesce(1).sortWithinPartitions(*order)).groupBy("a", "b").agg(F.first("estimate").alias("estimate"))
    return found.where("edge is null").select("a", "b", "estimate").unionAll(W.checkpointed(across))


def _payload(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, data): the compressed texts of the nodes."""

    def run(batches):
        pack = zstandard.ZstdCompressor(level=3)
        for batch, _, _ in W.blocks(batches, "text"):
            data = [pack.compress((s or "").encode()) for s in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(data, pa.binary())], names=["node", "data"])

    found = docs.where(F.col("id").isNotNull()).mapInArrow(run, "node long, data binary")
    return found.join(nodes, "node", "left_semi").dropDuplicates(["node"])


def _confirm(pairs: DataFrame, payload: DataFrame, size: int, percent: int) -> DataFrame:
    """(a, b, linked): whether the full sets overlap enough."""
    both = (pairs.select("a", "b").join(payload.select(F.col("node").alias("a"), F.col("data").alias("x")), "a")
            .join(payload.select(F.col("node").alias("b"), F.col("data").alias("y")), "b"))

    def run(batches):
        unpack = zstandard.ZstdDecompressor()
        last: dict[int, np.ndarray] = {}

        def set_of(node, data):
            if node not in last:
                if len(last) >= 64:
                    last.clear()
                raw = np.frombuffer(unpack.decompress(data), np.uint8)
                last[node] = np.unique(shingles(raw, np.array([0, len(raw)]), size)[0])
            return last[node]

        for batch in batches:
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            x, y = batch.column("x"), batch.column("y")
            linked = []
            for i in range(len(a)):
                u, v = set_of(a[i], x[i].as_py()), set_of(b[i], y[i].as_py())
                same = len(u) + len(v) - len(np.unique(np.concatenate([u, v])))
                linked.append(100 * same >= percent * (len(u) + len(v) - same))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(linked, pa.bool_())], names=["a", "b", "linked"])

    return both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long, linked boolean")


def _dense(trees: DataFrame) -> DataFrame:
    """(node): the classes of every run that more classes share than a class has neighbours on a side."""
    crowded = trees.groupBy("tree", "prefix").count().where(F.col("count") > NEIGHBOURS + 1).select("tree", "prefix")
    return trees.select("tree", "prefix", "node").join(crowded, ["tree", "prefix"], "left_semi").select("node").distinct()


def _exact(dense: DataFrame, payload: DataFrame, label: DataFrame, size: int, percent: int) -> DataFrame:
    """(a, b): every pair of dense classes of different components that can overlap enough, by a prefix filter."""
    texts = payload.join(dense, "node", "left_semi")

    def sets(batch):
        unpack = zstandard.ZstdDecompressor()
        for data in batch.column("data"):
            raw = np.frombuffer(unpack.decompress(data.as_py()), np.uint8)
            yield np.unique(shingles(raw, np.array([0, len(raw)]), size)[0])

    def count(batches):
        seen = np.zeros(RARITY, np.int64)
        for batch in batches:
            for own in sets(batch):
                np.add.at(seen, (own % np.uint64(RARITY)).astype(np.int64), 1)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(seen[at], pa.int64())], names=["slot", "n"])

    often = np.zeros(RARITY, np.int64)
    for slot, n in texts.select("data").mapInArrow(count, "slot long, n long").groupBy("slot").agg(F.sum("n")).collect():  # at most RARITY rows
        often[slot] = n

    def run(batches):
        for batch in batches:
            node, h, at, n = [], [], [], []
            for i, own in zip(batch.column("node").to_pylist(), sets(batch), strict=True):
                seen = often[(own % np.uint64(RARITY)).astype(np.int64)]
                first = np.lexsort((own, seen))[:len(own) - -(-percent * len(own) // 100) + 1]
                place = np.flatnonzero(seen[first] > 1)  # what no other set holds meets nothing
                node.append(np.full(len(place), i, np.int64))
                h.append(own[first[place]].view(np.int64))
                at.append(place)
                n.append(np.full(len(place), len(own), np.int64))
            if node:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), pa.int64()) for x in (node, h, at, n)], names=["node", "h", "at", "n"])

    listed = texts.select("node", "data").mapInArrow(run, "node long, h long, at long, n long").join(label, "node", "left")
    listed = _stored(listed.select("node", "h", "at", "n", F.coalesce("label", "node").alias("label")), "rare")
    # all but the commonest component of a shingle are held against all, so one large component is not held against itself
    lists = (listed.groupBy("h", "label").count().groupBy("h")
             .agg(F.max_by("label", F.struct("count", "label")).alias("main"), F.max("count").alias("most"), F.sum("count").alias("all")))
    lists = lists.where("most < all").select("h", "main", F.ceil((F.col("all") - F.col("most")) / SALT_ROWS).alias("salts"))
    x = (listed.join(lists, "h").where("label <> main").withColumn("salt", F.pmod(F.xxhash64("node"), F.col("salts"))).alias("x"))
    y = listed.join(lists, "h").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1))).alias("y")
    total = F.col("x.n") + F.col("y.n")
    rest = F.least(F.col("x.n") - F.col("x.at"), F.col("y.n") - F.col("y.at"))
    met = x.join(y, (F.col("x.h") == F.col("y.h")) & (F.col("x.salt") == F.col("y.salt")) & (F.col("x.label") != F.col("y.label"))
                 & ((100 + percent) * rest >= percent * total)
                 & (percent * F.greatest("x.n", "y.n") <= 100 * F.least("x.n", "y.n")))
    return met.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node that each node of (a, b) edges reaches.

    Large-star and small-star contraction in turn, until the edges are the
    stars of the components.
    """
    most = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    e = W.checkpointed(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    tasks, before = most, None
    while True:
        few = lambda df: df.coalesce(tasks) if tasks < most else df  # noqa: B023, E731
        both = few(e).unionAll(few(e).select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = few(both.join(least, "u")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = few(large.join(least, "u")).select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
        e = W.checkpointed(few(small.select("e.*").where("u <> v").distinct()))
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before, tasks = now, max(1, now[0] // TASK_EDGES)
    labels = e.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return labels.unionAll(e.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def links(docs: DataFrame, classes: DataFrame, *, size: int, percent: int) -> DataFrame:
    """(a, b) confirmed links between class nodes, enough to span every component found."""
    trees = _trees(classes)
    dense = W.checkpointed(_dense(trees.select("tree", "prefix", "node")))
    pairs = _candidates(trees)
    ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).unionAll(dense).distinct()
    payload = _stored(_payload(docs, ends), "texts")

    each = pairs.select(F.explode(F.array(F.struct(F.col("a").alias("n")), F.struct(F.col("b").alias("n")))).alias("of"), "a", "b", "estimate")
    rank = F.row_number().over(Window.partitionBy("of.n").orderBy(F.desc("estimate"), "a", "b"))
    likely = each.withColumn("r", rank).where(F.col("r") <= FIRST_TRIES).select("a", "b").distinct()
    tried = W.checkpointed(_confirm(likely, payload, size, percent))
    # what is not yet in one component, whole
    rest = _across(pairs.join(tried, ["a", "b"], "left_anti").select("a", "b"), components(tried.where("linked")))
    tried = tried.unionAll(W.checkpointed(_confirm(rest.select("a", "b"), payload, size, percent)))
    label = W.checkpointed(components(tried.where("linked")))
    # failed against a member of another group: try the members with most links
    good = tried.where("linked")
    degree = (good.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").count().join(label, "node"))
    best = F.row_number().over(Window.partitionBy("label").orderBy(F.desc("count"), "node"))
    hubs = degree.withColumn("r", best).where(F.col("r") <= HUBS).select(F.col("label").alias("group"), F.col("node").alias("hub"))
    failed = _across(tried.where("not linked").select("a", "b"), label)
    turned = (failed.select(F.col("a").alias("node"), F.col("lb").alias("group"))
              .unionAll(failed.select(F.col("b").alias("node"), F.col("la").alias("group"))).distinct())
    more = (turned.join(hubs, "group").where("node <> hub")
            .select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()
            .join(tried, ["a", "b"], "left_anti"))
    tried = tried.unionAll(W.checkpointed(_confirm(more, payload, size, percent)))
    good = tried.where("linked").select("a", "b")
    if dense.isEmpty():
        return good
    label = W.checkpointed(components(good))
    rest = _exact(dense, payload, label, size, percent).join(tried, ["a", "b"], "left_anti")
    return good.unionAll(_confirm(rest, payload, size, percent).where("linked").select("a", "b"))


def _across(pairs: DataFrame, label: DataFrame) -> DataFrame:
    """Pairs between different components, with their labels ``la`` and ``lb``."""
    la = F.coalesce(F.col("x.label"), F.col("p.a")).alias("la")
    lb = F.coalesce(F.col("y.label"), F.col("p.b")).alias("lb")
    return (pairs.alias("p").join(label.alias("x"), F.col("p.a") == F.col("x.node"), "left")
            .join(label.alias("y"), F.col("p.b") == F.col("y.node"), "left")
            .select("p.a", "p.b", la, lb).where("la <> lb"))


def groups(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_shingles``, ``component_id``, ``kept`` (the smallest id of its component)."""
    src = docs.select(F.col(W.quoted(doc_id)).cast("long").alias("id"), F.col(W.quoted(text)).cast("string").alias("text"))
    rows = _stored(_features(src, size), "signatures")
    named = rows.where(F.col("key").isNotNull() & F.col("id").isNotNull())
    classes = _stored(named.groupBy("key").agg(F.min("id").alias("node"), F.first("signature").alias("signature")), "classes")
    label = components(links(src, classes, size=size, percent=percent))
    of_class = (classes.select("key", "node").join(label, "node", "left")
                .select("key", F.coalesce("label", "node").alias("component")))
    out = rows.select("id", "n", "key").join(of_class, "key", "left")
    component = F.when(F.col("id").isNull(), F.lit(None)).otherwise(F.coalesce("component", "id"))
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
