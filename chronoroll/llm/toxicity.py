"""Toxicity scores: gradient-boosted trees over dense features, with isotonic calibration.

A text is described by a few rates: how dense words of a lexicon are, and how
dense where they are densest, how near they stand to a second-person word,
capitals, shouting, punctuation, and words with letters hidden behind digits
or signs. The lexicon is learned: words far likelier in toxic training texts
than in others, by smoothed log-odds of their document counts, together with
a short fixed list. Trees (Spark ML) are fitted on one part of the training
rows and an isotonic regression on the other part maps their probability to
a calibrated one. Only labels and texts of the training rows are used.

The fit uses at most ``MAX_TRAINING_ROWS`` labelled rows, those of the
smallest hash of their id; the lexicon has at most ``MAX_LEXICON`` words.
Every text is scored whole.

Defined cases: a null or empty text has all rates 0 and gets the score the
model gives to that; without a training row of either class every score is
the share of label 1 (0 without labels); a document labelled several times
counts as toxic if one label says so; null labels and ids are no training
rows; repeated rows are scored each; an empty table gives an empty result; a
column of the input named like a result column is replaced by it.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words as W

MAX_TRAINING_ROWS = 30_000
MAX_LEXICON = 400
#: Least toxic training texts with a word of the lexicon, and least log-odds.
LEAST_TEXTS, LEAST_ODDS = 4, 2.0
#: Words on each side that count as near, words of the window for the densest place.
NEAR, WINDOW = 6, 40

# ---- fixed values: insults that count without training, and second-person words
INSULTS = ("idiot", "idiots", "moron", "morons", "stupid", "worthless", "pathetic", "loser", "losers", "trash", "scum",
           "disgusting", "dumb", "imbecile", "filth", "vermin", "garbage", "clown", "hate", "ugly", "freak", "fool")
SECOND_PERSON = ("you", "your", "yours", "yourself", "you're", "ur", "tu", "toi", "te", "vous", "votre", "ton",
                 "du", "dich", "dir", "dein", "ihr", "euch", "usted", "ustedes", "vosotros", "tus")

FEATURES = ("lexicon_rate", "lexicon_hits", "lexicon_odds", "densest", "near_second_person", "second_person_rate",
            "insult_rate", "capital_rate", "shout_word_rate", "mark_rate", "obfuscated_rate", "obfuscated_insults", "size")

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), 0x27, *range(128, 256)]] = True
_NOT_LETTER = ~_LETTER
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_SIGN = np.zeros(256, bool)
_SIGN[list(b"*@$!|+")] = True
_MARK = np.zeros(256, bool)
_MARK[list(b"!?")] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LOWER = np.zeros(256, bool)
_LOWER[97:123] = True
#: A letter for the digit or sign that often stands for it.
_PLAIN = np.arange(256, dtype=np.uint8)
for _a, _b in zip(b"013457@$!|+", b"oieastasiit", strict=True):
    _PLAIN[_a] = _b
_WORD = W.Hash(37, fold_case=True)


def _hashes(words) -> np.ndarray:
    raw = [w.encode() for w in words]
    buf = np.frombuffer(b"".join(raw), np.uint8)
    end = np.cumsum([len(r) for r in raw])
    return _WORD.runs(buf, end - [len(r) for r in raw], end) if raw else np.empty(0, np.uint64)


class Features:
    """Rates of a block of texts for a learned lexicon."""

    def __init__(self, lexicon: dict[str, float]):
        words = {w: max(lexicon.get(w, 0.0), LEAST_ODDS) for w in [*lexicon, *INSULTS]}
        h = _hashes(words)
        order = np.argsort(h)
        self.known = h[order]
        self.odds = np.array(list(words.values()))[order]
        self.insults = np.sort(_hashes(INSULTS))
        self.persons = np.sort(_hashes(SECOND_PERSON))

    def __call__(self, buf: np.ndarray, off: np.ndarray) -> dict[str, np.ndarray]:
        n = len(off) - 1
        start, end, first = W.split(buf, off, _NOT_LETTER)
        h = _WORD.runs(buf, start, end)
        at = np.searchsorted(self.known, h).clip(0, len(self.known) - 1)
        hit = self.known[at] == h
        odds = np.where(hit, self.odds[at], 0.0)
        count = np.diff(first)
        size = np.maximum(count, 1)
        hits = W.per_text(hit, first)
        total = np.concatenate([[0.0], np.cumsum(odds)])
        person = _member(h, self.persons)
        near = np.zeros(len(h), bool)
        doc = W.owner(first)
        for d in range(1, NEAR + 1):
            same = doc[d:] == doc[:-d]
            near[d:] |= hit[d:] & person[:-d] & same
            near[:-d] |= hit[:-d] & person[d:] & same
        upper, lower = W.per_text(_UPPER[buf], off), W.per_text(_LOWER[buf], off)
        caps = np.concatenate([[0], np.cumsum(_UPPER[buf])])
        lows = np.concatenate([[0], np.cumsum(_LOWER[buf])])
        shout = (caps[end] - caps[start] >= 3) & (lows[end] - lows[start] == 0)
        out = {
            "lexicon_rate": hits / size, "lexicon_hits": np.log1p(hits), "lexicon_odds": (total[first[1:]] - total[first[:-1]]) / size,
            "densest": self._densest(hit, first), "near_second_person": W.per_text(near, first) / size,
            "second_person_rate": W.per_text(person, first) / size,
            "insult_rate": W.per_text(_member(h, self.insults), first) / size,
            "capital_rate": upper / np.maximum(upper + lower, 1), "shout_word_rate": W.per_text(shout, first) / size,
            "mark_rate": W.per_text(_MARK[buf], off) / size, "size": np.log1p(count),
        }
        out["obfuscated_rate"], out["obfuscated_insults"] = self._obfuscated(buf, off, n)
        return {k: np.asarray(out[k], float) for k in FEATURES}

    @staticmethod
    def _densest(hit, first):
        """Most hits in a window of WINDOW words, by text."""
        n = len(first) - 1
        out = np.zeros(n)
        at = np.flatnonzero(hit)
        if len(at):
            doc = np.searchsorted(first, at, "right") - 1
            reach = np.minimum(np.searchsorted(at, at + WINDOW), np.searchsorted(doc, doc, "right"))
            np.maximum.at(out, doc, reach - np.arange(len(at)))
        return out

    def _obfuscated(self, buf, off, n):
        """Words with a letter on both sides of digits or signs, and those of them that spell an insult."""
        start, end, first = W.split(buf, off)
        odd = np.concatenate([[0], np.cumsum(_DIGIT[buf] | _SIGN[buf])])
        letters = np.concatenate([[0], np.cumsum(_LETTER[buf])])
        mixed = (odd[end] - odd[start] > 0) & (letters[end] - letters[start] > 1)
        at = np.flatnonzero(mixed)
        if not len(at):
            return np.zeros(n), np.zeros(n)
        # strip signs that only end the word
        s, e = start[at], end[at]
        while (trim := _NOT_LETTER[buf[e - 1]] & (e - s > 1)).any():
            e = e - trim
        inner = odd[e] - odd[s] > 0
        spelled = _member(_WORD.runs(_PLAIN[buf], s, e), self.insults) & inner
        doc = np.searchsorted(first, at, "right") - 1
        size = np.maximum(np.diff(first), 1)
        return np.bincount(doc[inner], minlength=n) / size, np.bincount(doc[spelled], minlength=n).astype(float)


def _member(h, known):
    if not len(known):
        return np.zeros(len(h), bool)
    return known[np.searchsorted(known, h).clip(0, len(known) - 1)] == h


def learn_lexicon(train: DataFrame) -> dict[str, float]:
    """Word to log-odds, for at most MAX_LEXICON words of ``train`` (text, label)."""
    words = F.array_distinct(F.split(F.lower("text"), r"[^\p{L}']+"))
    sizes = train.agg(F.sum("label"), F.sum(1 - F.col("label"))).first()
    if not sizes[0] or not sizes[1]:
        return {}
    toxic, clean = float(sizes[0]), float(sizes[1])
    seen = (train.select("label", F.explode(words).alias("word")).where(F.length("word") > 2)
            .groupBy("word").agg(F.sum("label").alias("t"), F.count("*").alias("n")))
    odds = F.log((F.col("t") + 0.5) / (toxic + 1)) - F.log((F.col("n") - F.col("t") + 0.5) / (clean + 1))
    top = (seen.where(F.col("t") >= LEAST_TEXTS).select("word", odds.alias("odds")).where(F.col("odds") >= LEAST_ODDS)
           .orderBy(F.desc("odds"), "word").limit(MAX_LEXICON))
    return {r["word"]: r["odds"] for r in top.collect()}


def training_rows(docs: DataFrame, labels: DataFrame, usable: Column, *, doc_id: str = "doc_id", text: str = "text",
                  label: str = "toxic", limit: int = MAX_TRAINING_ROWS) -> DataFrame:
    """(id, text, label) of at most ``limit`` labelled documents for which ``usable`` holds."""
    known = (labels.where(F.col(doc_id).isNotNull() & F.col(label).isNotNull() & usable)
             .groupBy(F.col(doc_id).alias("id")).agg(F.max(F.col(label).cast("int")).cast("double").alias("label"))
             .orderBy(F.xxhash64("id"), "id").limit(limit))
    texts = docs.select(F.col(W.quoted(doc_id)).alias("id"), F.coalesce(F.col(W.quoted(text)).cast("string"), F.lit("")).alias("text"))
    return texts.join(F.broadcast(known), "id")


class Model:
    """Lexicon, trees and calibration; ``score`` adds ``score`` (0 to 1) to a frame."""

    def __init__(self, train: DataFrame, calibrate: Column):
        """``train``: (id, text, label); rows for which ``calibrate`` holds fit the calibration."""
        train = W.checkpointed(train.withColumn("calibrate", calibrate))
        self.lexicon = learn_lexicon(train.where(~F.col("calibrate")))
        rows = W.checkpointed(self._features(train).drop("text"))
        fit, rest = rows.where(~F.col("calibrate")), rows.where("calibrate")
        classes = {(bool(r[0]), r[1]): r[2] for r in rows.groupBy("calibrate", "label").count().collect()}
        n = sum(classes.values())
        self.share = sum(v for (_, y), v in classes.items() if y) / n if n else 0.0
        self.trees = self.curve = None
        if len({y for c, y in classes if not c}) < 2:
            return
        gather = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
        self.gather = gather
        self.trees = GBTClassifier(featuresCol="features", labelCol="label", maxIter=20, maxDepth=4, stepSize=0.2,
                                   minInstancesPerNode=10, seed=7).fit(gather.transform(fit.coalesce(8)))
        if len({y for c, y in classes if c}) == 2:
            self.curve = IsotonicRegression(featuresCol="raw", labelCol="label").fit(self._raw(rest))

    def _features(self, df: DataFrame) -> DataFrame:
        return W.add_columns(df, "text", {f: T.DoubleType() for f in FEATURES}, Features(self.lexicon))

    def _raw(self, df: DataFrame) -> DataFrame:
        rows = self.trees.transform(self.gather.transform(df)).withColumn("raw", vector_to_array("probability")[1])
        return rows.drop("features", "rawPrediction", "probability", "prediction")

    def score(self, docs: DataFrame, *, text: str = "text") -> DataFrame:
        """``docs`` without ``text``, with the calibrated ``score``."""
        kept = [n for n in docs.columns if n not in (text, "score")]
        rest = [F.col(W.quoted(n)).alias(f"c{i}") for i, n in enumerate(kept)]
        rows = docs.select(F.struct(F.lit(0).alias("none"), *rest).alias("own"), F.col(W.quoted(text)).cast("string").alias("text"))
        if self.trees is None:
            scored = rows.withColumn("score", F.lit(float(self.share)))
        else:
            scored = self._raw(self._features(rows).drop("text"))
            if self.curve is None:
                scored = scored.withColumn("score", F.col("raw"))
            else:
                # the trees' probability orders documents that the steps of the calibration put together
                scored = self.curve.transform(scored).withColumn("score", 0.99 * F.col("prediction") + 0.01 * F.col("raw"))
        return scored.select(*[F.col(f"own.c{i}").alias(n) for i, n in enumerate(kept)], F.col("score").cast("double"))
