"""Quality rules by weak supervision: rules vote or abstain, expectation-maximisation weighs them.

Every rule sees a document's measures and votes good (``+``), bad (``-``) or
abstains (``0``). Under a model in which the votes of a document depend only on
whether it is good or which kind of bad it is, EM estimates each rule's
accuracies and the share of good documents from all documents' votes, without
labels. A document is kept if
its posterior probability of being good reaches ``threshold``.

The votes of a document are a string over ``+-0``, one place each rule, so the
corpus has at most ``3 ** (len(RULES) + 1)`` different strings: EM runs on their
counts, which is all that reaches the driver.

Defined cases: a null or empty text has no words, every count is 0, all ratio
rules abstain and the length rule votes bad. Repeated rows are judged row by
row, ties of the posterior with the threshold are kept, an empty table gives
an empty result, and a column of the input that has the name of a result
column is replaced by it.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words as W

SYMBOLS = b"#*$%&|<>"
_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS)] = True
_IS_UPPER = np.zeros(256, bool)
_IS_UPPER[65:91] = True
_IS_LOWER = np.zeros(256, bool)
_IS_LOWER[97:123] = True
_IS_SHOUT = np.zeros(256, bool)
_IS_SHOUT[list(b"!?")] = True

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
            "n_distinct_words", "n_upper", "n_lower", "n_shouts")

#: (name, measure as SQL, bad if above, good if below, least words): fixed values of this module.
RULES: tuple[tuple[str, str, float, float, int], ...] = (
    ("repeats", "try_divide(n_repeat_words, n_words)", 0.20, 0.10, 10),
    ("symbols", "try_divide(n_symbols, n_words)", 0.30, 0.10, 5),
    ("duplicate_lines", "try_divide(n_dup_lines, n_lines)", 0.50, 0.20, 5),
    ("capitals", "try_divide(n_upper, n_upper + n_lower)", 0.60, 0.30, 5),
    ("shouts", "try_divide(n_shouts, n_words)", 0.30, 0.10, 5),
    ("few_distinct", "1 - try_divide(n_distinct_words, n_words)", 0.85, 0.70, 20),
    ("word_length", "abs(try_divide(word_chars, n_words) - 6)", 8.0, 4.0, 5),
)
#: Votes of each sort that an estimate counts besides those seen.
SMOOTHING = 0.05
#: What a rule may say: bad, nothing, good.
VOTES = "-0+"
#: The last rule, by the number of words: bad below the first, good from the second on.
FEW_WORDS, ENOUGH_WORDS = 10, 30


def measures(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """``docs`` with the columns of MEASURES (longs), counted over whole texts."""
    return W.add_columns(docs, text, {m: T.LongType() for m in MEASURES}, _measure)


def _measure(buf: np.ndarray, off: np.ndarray) -> dict[str, np.ndarray]:
    start, end, first = W.split(buf, off)
    h = W.FIRST.runs(buf, start, end)
    doc = W.owner(first)
    by = {"n_words": np.diff(first)}
    lead = (buf & 0xC0) != 0x80
    for name, flags in (("word_chars", lead & ~W.IS_SPACE[buf]), ("n_symbols", _IS_SYMBOL[buf]),
                        ("n_upper", _IS_UPPER[buf]), ("n_lower", _IS_LOWER[buf]), ("n_shouts", _IS_SHOUT[buf])):
        by[name] = W.per_text(flags, off)
    by["n_lines"], by["n_dup_lines"] = _lines(buf, off, start)

    salt = W.mix(np.arange(1, len(off), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    by["n_distinct_words"] = _distinct(h ^ salt[doc], doc, len(off) - 1)

    win = W.FIRST.windows(h, 5)
    ok = W.inside(first, 5)
    at = np.flatnonzero(ok)
    keys = win[at] ^ salt[doc[at]]
    srt = np.sort(keys)
    twice = srt[1:][srt[1:] == srt[:-1]]
    if len(twice):
        at = at[np.isin(keys, twice)]
        by["n_repeat_words"] = W.per_text(W.covered(at, 5, len(h)), first)
    else:
        by["n_repeat_words"] = np.zeros(len(off) - 1, np.int64)
    return by


def _distinct(keys, doc, n):
    order = np.argsort(keys)
    k = keys[order]
    new = np.ones(len(k), bool)
    new[1:] = k[1:] != k[:-1]
    return np.bincount(doc[order][new], minlength=n)


def _lines(buf, off, word_start):
    """Lines that hold a word, and those of them equal to an earlier one of the text."""
    n = len(off) - 1
    cut = np.flatnonzero(buf == 10)
    begin = np.concatenate([off[:-1], cut + 1])
    begin.sort(kind="stable")
    # a line ends before its newline or where its text ends: one of each kind per line, in order
    stop = np.concatenate([cut, off[1:]])
    stop.sort(kind="stable")
    words_in = np.searchsorted(word_start, stop) - np.searchsorted(word_start, begin)
    has = words_in > 0
    b, e = begin[has], stop[has]
    if not len(b):
        return np.zeros(n, np.int64), np.zeros(n, np.int64)
    owner = np.searchsorted(off, b, "right") - 1
    h = W.FIRST.runs(buf, b, e)
    order = np.lexsort((h, owner))
    same = np.zeros(len(h), bool)
    same[1:] = (h[order][1:] == h[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    return np.bincount(owner, minlength=n), np.bincount(owner[order][same], minlength=n)


def base_failed() -> Column:
    """The base rule: fewer than 10 words, or over 20 % of them in windows of five that repeat."""
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def with_votes(measured: DataFrame, rules=RULES) -> DataFrame:
    """Adds ``votes``: one of ``+-0`` for each rule and one for the length."""
    parts = []
    for _, sql, bad, good, least in rules:
        x = F.expr(sql)
        parts.append(F.when((F.col("n_words") < least) | x.isNull(), "0")
                     .when(x > bad, "-").when(x < good, "+").otherwise("0"))
    length = (F.when(F.col("n_words") < FEW_WORDS, "-")
              .when(F.col("n_words") >= ENOUGH_WORDS, "+").otherwise("0"))
    return measured.drop("p_good", "good").withColumn("votes", F.concat(*parts, length))


def fit(counts: list[tuple[str, int]], *, rounds: int = 200,
        tolerance: float = 1e-9) -> tuple[np.ndarray, np.ndarray, dict[str, float]]:
    """(shares of the classes, accuracies, probability of good of each vote string) by EM.

    The classes are "good" (0) and one kind of bad document for each rule:
    bad documents are not alike, a rule finds its own kind, which only documents
    that it votes bad can be, and says little on the others. ``accuracies[c, j, v]`` is the chance that rule ``j`` votes
    ``VOTES[v]`` on a document of class ``c``. EM starts from the votes for
    bad, shared evenly among the kinds that got one, and each estimate counts
    SMOOTHING votes of each sort besides those seen.
    """
    if not counts:
        return np.empty(0), np.empty(0), {}
    kind = np.array([[VOTES.index(c) for c in s] for s, _ in counts])
    cast = (kind[:, :, None] == np.arange(len(VOTES))).astype(float)
    n = np.array([k for _, k in counts], float)
    bad = (kind == 0).astype(float)
    belongs = np.concatenate([(bad.sum(1, keepdims=True) == 0) * 1.0, bad], axis=1)
    belongs /= belongs.sum(1, keepdims=True)
    possible = np.concatenate([np.ones((len(n), 1), bool), bad > 0], axis=1)
    for _ in range(rounds):
        acc = np.einsum("pc,p,pjv->cjv", belongs, n, cast) + SMOOTHING
        acc /= acc.sum(2, keepdims=True)
        share = n @ belongs + 1
        share /= share.sum()
        log = np.where(possible, np.log(share) + np.einsum("cjv,pjv->pc", np.log(acc), cast), -np.inf)
        new = np.exp(log - log.max(1, keepdims=True))
        new /= new.sum(1, keepdims=True)
        moved, belongs = np.abs(new - belongs).max(), new
        if moved < tolerance:
            break
    return share, acc, {s: float(p) for (s, _), p in zip(counts, belongs[:, 0], strict=True)}


def judge(docs: DataFrame, *, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """``docs`` with MEASURES, ``votes``, ``p_good`` (double) and ``good`` (``p_good >= threshold``).

    The texts are measured twice, once to count the votes of all rows and
    once to judge each row. A caller that needs no text should drop it from
    ``with_votes(measures(docs))``, checkpoint that, and call ``score``.
    """
    return score(with_votes(measures(docs, text=text)), threshold=threshold)


def score(voted: DataFrame, *, threshold: float = 0.5) -> DataFrame:
    """Adds ``p_good`` and ``good`` to rows with ``votes`` (read twice)."""
    counts = [(r["votes"], r["count"]) for r in voted.groupBy("votes").count().collect()]
    _, _, posterior = fit(counts)
    spark = voted.sparkSession
    # at most 3 ** rules rows, whatever the corpus holds
    table = spark.createDataFrame(list(posterior.items()), "votes string, p_good double")
    return (voted.join(F.broadcast(table), "votes")
            .withColumn("good", F.col("p_good") >= F.lit(threshold)))
