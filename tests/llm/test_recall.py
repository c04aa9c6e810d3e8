"""Recall of the benchmark search on paraphrases, against a search of every window."""

import random

import numpy as np
import pytest

from chronoroll.llm import semantic


def vocabulary(rng, n):
    return ["".join(rng.choice("etaoinshrdlucm") for _ in range(rng.randrange(3, 9))) + str(i) for i in range(n)]


def reworded(rng, words, share, pool):
    """Some words replaced (never the last five, the answer), one pair of neighbours swapped, one word put in."""
    out = list(words)
    for i in rng.sample(range(len(out) - 5), int(share * len(out))):
        out[i] = rng.choice(pool)
    i = rng.randrange(len(out) - 7)
    out[i], out[i + 1] = out[i + 1], out[i]
    out.insert(rng.randrange(len(out) - 5), rng.choice(pool))
    return out


def brute(docs, queries):
    """(document, item) pairs of which some window of the item's length passes the rules on common words."""
    found = set()
    for doc, text in docs:
        h, first = semantic._hashes(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text.encode())]))
        terms = queries.index(h).tolist()
        for k, part in enumerate(queries.parts):
            part, w, least = part.tolist(), int(queries.window[k]), int(queries.least[k])
            own = set(part)
            hit = np.cumsum([0, *[t in own for t in terms]])
            for lo in range(max(1, len(terms) - w + 1)):
                hi = min(lo + w, len(terms))
                if hit[hi] - hit[lo] < least:
                    continue
                n = semantic.common(part, terms[lo:hi])
                answer = part[-semantic.ANSWER_WORDS:]
                if n >= least and (n >= semantic.SURE_SHARE * len(part) or
                                   semantic.common(answer, terms[lo:hi]) >= semantic.ANSWER_SHARE * len(answer)):
                    found.add((doc, queries.item[k]))
                    break
    return found


@pytest.mark.parametrize("share", [0.0, 0.2, 0.3])
def test_recall_on_paraphrases(spark, share):
    rng = random.Random(int(share * 100))
    words = vocabulary(rng, 1500)
    weights = [1 / (i + 3) for i in range(len(words))]
    prose = lambda n: rng.choices(words, weights, k=n)
    items = [(i, prose(rng.randrange(14, 60))) for i in range(60)]
    docs = []
    for i in range(120):
        body = prose(rng.randrange(60, 300))
        if i % 2:
            item = items[rng.randrange(len(items))][1]
            at = rng.randrange(len(body))
            body[at:at] = reworded(rng, item, share, words)
        docs.append((i, " ".join(body)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in semantic.leaks(df, bench).collect()}
    want = brute(docs, semantic.Queries([(i, " ".join(w)) for i, w in items]))
    assert len(want) >= 40
    assert got <= want
    assert len(got) >= 0.95 * len(want), (len(got), len(want))


def test_index_leaves_out_no_pair(monkeypatch):
    """Every window that holds enough of an item in common order is among the index's pairs."""
    rng = random.Random(9)
    words = vocabulary(rng, 300)
    items = [(i, " ".join(rng.choices(words, k=rng.randrange(8, 40)))) for i in range(30)]
    queries = semantic.Queries(items)
    texts = [" ".join(rng.choices(words, k=rng.randrange(0, 60)) + reworded(rng, items[i][1].split(), 0.2, words) + rng.choices(words, k=20))
             for i in range(30) if len(items[i][1].split()) > 12] + ["", words[0]]
    raw = [t.encode() for t in texts]
    h, first = semantic._hashes(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    terms = queries.index(h)
    sizes, seen = np.diff(first), np.bincount(terms, minlength=len(queries.vocabulary) + 1)[:-1]
    for w in semantic.WINDOWS:
        own = np.flatnonzero(queries.window == w)
        if not len(own):
            continue
        count = np.where(sizes > 0, -(-np.maximum(sizes - w, 0) // (w // 4)) + 1, 0)
        begin = np.cumsum(count) - count
        window, item = semantic.Index(queries, own, seen).pairs(terms, first, begin, count, w)
        pairs = set(zip(window.tolist(), own[item].tolist()))
        for t in range(len(texts)):
            for j in range(int(count[t])):
                lo = first[t] + j * (w // 4)
                there = terms[lo:min(lo + w, first[t + 1])].tolist()
                for k in own.tolist():
                    if semantic.common(queries.parts[k].tolist(), there) >= queries.least[k]:
                        assert (int(begin[t]) + j, k) in pairs
