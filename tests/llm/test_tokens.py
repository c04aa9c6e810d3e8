"""Piece encoding, alignment of tokenizers and periodic runs, against the libraries and brute force."""

import base64
import collections
import hashlib
import random
import re
import struct
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
import tiktoken
from pyspark.sql import functions as F

from chronoroll.llm import align, periodic, pieces
from chronoroll.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string"
MODEL = P.path("piece_bpe_32k.model")


def corpus():
    rng = random.Random(8)
    letters = " abcdeéß中文▁\t\n 😀\u0000.,0192ABthe "
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(0, 70))) for _ in range(150)]
    texts += [" ".join(rng.choice("ab the of word".split()) for _ in range(rng.randrange(10, 90))) for _ in range(150)]
    texts += [None, "", " ", "▁", "a▁ b", "<s></s><unk><0x41><|endoftext|>", "ab " * 5000, "x" * 4000, " " * 3000, "\x85 \xa0 w"]
    rows = list(enumerate(texts))
    return [*rows, rows[3], rows[3], (None, "a b a b a b a b a b a b a"), (None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(3).checkpoint()


@pytest.fixture(scope="module")
def folder(spark, docs, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tokens"))
    docs.write.parquet(f"{path}/documents.parquet")
    docs.limit(0).write.parquet(f"{path}/none/documents.parquet")
    return path


def clash(df, *names):
    for n in names:
        df = df.withColumn(n, F.lit("mine"))
    return df.withColumn("a.b `c", F.lit(1))


def lines(df):
    return collections.Counter(tuple(r) for r in df.collect())


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


# ---- pieces

def test_pieces_as_the_library(spark, docs, folder):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    want, digests = collections.Counter(), collections.Counter()
    for i, t in corpus():
        t = t or ""
        proto = library.encode(t, return_type="proto").pieces
        ids = [1, *[p.id for p in proto], 2]
        spans = [0, 0, *[x for p in proto for x in (p.begin, p.end)], *[len(t.encode())] * 2]
        raw = np.array(ids, "<u4").tobytes()
        want[(i, len(ids), raw, np.array(spans, "<u4").tobytes(), library.decode(ids))] += 1
        digests[(i, len(ids), sha(raw), sha(library.decode(ids)))] += 1
    out = pieces.encode(clash(docs, "ids", "n_tokens"), MODEL)
    assert collections.Counter((r["doc_id"], r["n_tokens"], bytes(r["ids"]), bytes(r["spans"]), r["decoded"]) for r in out.collect()) == want
    assert "a.b `c" in out.columns
    query = QUERIES["op11_sentencepiece"]
    assert lines(query(spark, folder).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")) == digests
    assert query(spark, f"{folder}/none").count() == 0


def test_decode_any_ids():
    library, rng = sentencepiece.SentencePieceProcessor(model_file=MODEL), random.Random(4)
    model = pieces.Model(open(MODEL, "rb").read())
    for _ in range(2000):
        ids = [rng.randrange(rng.choice([300, 32000])) for _ in range(rng.randrange(8))]
        assert model.decode(ids) == library.decode(ids)


def remodelled(rule, dummy, trim):
    """The model's file with another normaliser, compiled by the library."""
    spec = sentencepiece.SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=dummy, remove_extra_whitespaces=trim, escape_whitespaces=True)
    spec = spec.serialized_normalizer_spec()
    size, head = len(spec), bytearray([3 << 3 | 2])
    while size > 127:
        head.append(size & 127 | 128)
        size >>= 7
    return open(MODEL, "rb").read() + bytes([*head, size]) + spec


@pytest.mark.parametrize("rule,dummy,trim", [("nmt_nfkc", True, True), ("nfkc_cf", False, True), ("nmt_nfkc_cf", True, False), ("identity", False, False)])
def test_character_map_and_spans(rule, dummy, trim):
    data, rng = remodelled(rule, dummy, trim), random.Random(6)
    letters = "  ab É́éﬁ①Ｆ㍿ｶﾞ 　​½ŕ\tĲ각가가\n😀ẞ"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(0, 30))) for _ in range(800)] + ["", " ", "   ", "a  ", "　", " ​ "]
    library, model = sentencepiece.SentencePieceProcessor(model_proto=data), pieces.Model(data)
    raw = [t.encode() for t in texts]
    got, cut, start, end = model.encode(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    for i, t in enumerate(texts):
        mine = [x[cut[i]:cut[i + 1]].tolist() for x in (got, start, end)]
        want = library.encode(t, return_type="proto").pieces
        assert mine == [[p.id for p in want], [p.begin for p in want], [p.end for p in want]], t
        assert model.decode(mine[0]) == library.decode(mine[0])


def test_user_defined_pieces_are_an_error():
    piece = b"\x0a\x01x\x15" + struct.pack("<f", 0.0) + b"\x18\x04"
    with pytest.raises(ValueError):
        pieces.Model(open(MODEL, "rb").read() + bytes([1 << 3 | 2, len(piece)]) + piece)


# ---- alignment

def aligned(rows):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    token = {i: t for t, i in ranks.items()}
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    docs = []
    for i, t in rows:
        t = t or ""
        a, b = (own.encode_ordinary(" " + t), model.encode(t)) if t else ([], [])
        bytes_b = [bytes([int(p[3:5], 16)]) if model.is_byte(x) else p.replace("▁", " ").encode() for x in b for p in [model.id_to_piece(x)]]
        if b"".join(bytes_b) != (" " + t).encode():
            a, b = [], []
        end_a, end_b = np.cumsum([len(token[x]) for x in a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()
        links = []
        lo = 0
        for x, e in enumerate(end_a):  # overlap of the byte ranges, stated for all pairs but those left behind
            s = end_a[x - 1] if x else 0
            while lo < len(b) and end_b[lo] <= s:
                lo += 1
            y = lo
            while y < len(b) and (end_b[y - 1] if y else 0) < e:
                links.append((a[x], b[y]))
                y += 1
        groups, x, y = [], 0, 0
        for e in sorted(set(end_a) & set(end_b)) if a else []:
            p, q = end_a.index(e) + 1, end_b.index(e) + 1
            groups.append(",".join(map(str, a[x:p])) + "|" + ",".join(map(str, b[y:q])))
            x, y = p, q
        docs.append((i, a, b, groups, links))
    count = collections.Counter(p for d in docs for p in set(d[4]))
    top = collections.defaultdict(int)
    for (x, _), n in count.items():
        top[x] = max(top[x], n)
    return collections.Counter((i, len(a), len(b), len(g), len(k), sum(count[p] == top[p[0]] for p in k), sum(count[p] for p in k), ";".join(g))
                               for i, a, b, g, k in docs)


@pytest.mark.parametrize("lane,block", [(512, align.BLOCK), (3, 700)])
def test_alignment(spark, docs, folder, monkeypatch, lane, block):
    monkeypatch.setattr(align.lockstep, "__defaults__", (lane,))
    monkeypatch.setattr(align, "BLOCK", block)
    rows = [(i, t if t is None or len(t) < 3000 else t[:3000]) for i, t in corpus()]
    src = spark.createDataFrame(rows, SCHEMA).repartition(3)
    want = aligned(rows)
    out = align.align(clash(src, "n_a", "groups"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN, MODEL)
    assert "a.b `c" in out.columns and "text" not in out.columns
    assert lines(out.select("doc_id", *align.FIELDS)) == want


def test_alignment_query(spark, folder):
    query = QUERIES["op12_token_alignment"]
    got = lines(query(spark, folder).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"))
    assert got == collections.Counter({(*k[:7], sha(k[7]) if k[1] else ""): n for k, n in aligned(corpus()).items()})
    assert query(spark, f"{folder}/none").count() == 0


# ---- periodic runs

def brute_runs(s, least):
    out = {}
    for q in range(1, len(s) // 2 + 1):
        i = 0
        while i + q < len(s):
            a = i
            while i + q < len(s) and s[i] == s[i + q]:
                i += 1
            if i - a + q >= max(least, 2 * q) and not any(a2 <= a and i + q <= a2 + n2 and q % q2 == 0 for a2, n2, q2 in out.values()):
                out[a, q] = (a, i - a + q, q)
            i += 1
    return [out[k] for k in sorted(out)]


def test_runs_of_small_alphabets():
    rng = random.Random(2)
    for _ in range(1500):
        s = [rng.randrange(1, rng.randrange(2, 5)) for _ in range(rng.randrange(40))]
        least = rng.choice([1, 2, 5, 12])
        assert [tuple(r) for r in periodic.runs(s, least).tolist()] == brute_runs(s, least)


def test_runs_of_long_texts():
    word = [1, 2, 1, 3, 1]
    assert periodic.runs([1] * 20_000).tolist() == [[0, 20_000, 1]]
    assert [0, 20_000, 5] in periodic.runs(word * 4000).tolist()
    a, b = [1], [1, 2]
    while len(b) < 2000:
        a, b = b, b + a
    assert [tuple(r) for r in periodic.runs(b, 12).tolist()] == brute_runs(b, 12)


def judged(words):
    runs = brute_runs(words, 12)
    gone = {j for a, n, q in runs for j in range(a + q, a + n)}
    top = min(((-n, a, q) for a, n, q in runs), default=None)
    best = (top[1], -top[0], top[2], 1000 * -top[0] // top[2]) if top else (None,) * 4
    return (len(runs), *best, sha("".join(f"{a},{n},{q}\n" for a, n, q in runs)), sha(" ".join(w for j, w in enumerate(words) if j not in gone)))


def planted(i, text):
    words = WORD.findall(text or "")
    h, n = zlib.crc32(str(i).encode()) if i is not None else 1, len(words)
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + k % p] for k in range(n - a)]
    return words


def test_periodic_query(spark, tmp_path):
    rng = random.Random(5)
    rows = [(i, t) for i, t in corpus() if t is None or len(t) < 3000]
    rows += [(1000 + i, " ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(0, 80)))) for i in range(400)]
    for i in range(60):  # several runs a text
        units = [[rng.choice("abcdefgh") for _ in range(rng.randrange(1, 9))] * rng.randrange(1, 6) for _ in range(8)]
        rows.append((2000 + i, " \n".join(w for u in units for w in [*u, *(["x", "y"] * rng.randrange(2))])))
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    query = QUERIES["op13_periodic_runs"]
    want = collections.Counter((i, *judged(planted(i, t))) for i, t in rows)
    assert sum(n for k, n in want.items() if k[1] > 1) > 20
    assert lines(query(spark, str(tmp_path)).select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")) == want


def test_periodic_columns(spark, docs):
    out = periodic.find(clash(docs, "runs", "n_words"))
    assert out.count() == len(corpus()) and "a.b `c" in out.columns
    r = {x["doc_id"]: x for x in out.collect()}
    assert r[306]["runs"][0].asDict() == {"start": 0, "length": 5000, "period": 1} and r[306]["collapsed"] == "ab"
    assert r[300]["n_words"] == 0 and r[300]["runs"] == [] and r[300]["collapsed"] == ""
    assert periodic.find(docs.limit(0)).count() == 0
