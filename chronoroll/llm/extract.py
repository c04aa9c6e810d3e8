"""Main text of HTML pages by the maximum-scoring subsequence.

A page becomes a sequence of words and tags. Words score positive and tags
negative, and one linear scan finds the contiguous region with the largest
sum, whose visible words are the main text. The weights are log-odds learned
from labelled pages: those that mark their text with ``<article>`` or ``<main>``
say which words and tags stand inside it. They score every page; a word inside
such a mark scores ``MARK`` more. All visible text of the region is returned,
marked or not. Menus, headers,
footers, sidebars, notices, adverts, forms, scripts and reader comments,
known by their tag, role, class or id, neither score nor are returned.

The kinds of words and tags are fixed lists, so the counts that reach the
driver are bounded, whatever the corpus holds.

Defined cases: a null or empty page gives an empty text, and so does one
without a word outside the excluded elements; an element that is never closed
ends with its parent, a comment or script that is never closed with the page;
ties go to the earliest region; repeated rows are extracted each; an empty
table gives an empty result; a column of the input named like a result column
is replaced by it.
"""

from __future__ import annotations

import html as entities
import re
from math import log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words as W

#: What a word inside ``<article>`` or ``<main>`` scores besides its weight.
MARK = 2.0

# ---- fixed values: tags of HTML and the words that pages name their parts by
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre
search section summary table tbody td tfoot th thead title tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template svg iframe textarea title object canvas noframes noembed xmp math".split())
EXCLUDED = frozenset("nav footer aside form menu dialog button select head search".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
NAMES = frozenset("""ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies
consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login share sharing social
sidebar menu menus nav navbar navigation topnav breadcrumb breadcrumbs footer masthead comments comment commentlist disqus
replies reply respond related recommended recommendations widget widgets toolbar pagination pager skip""".split())
HEADER_NAMES = frozenset("header topbar".split())
ARTICLE_NAMES = frozenset("article post entry content story main".split())
CLOSED_BY_BLOCK = BLOCKS - {"option", "optgroup", "td", "th", "tr"}

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"""
                  r"""|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^<>"']++|"[^"<]*+"|'[^'<]*+')*+>|[^>]*+(?:>|\Z))""", re.S)
_NAMED = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_ROOT = ("", False, False, "word:plain")
_TEXT = frozenset(("article", "main", "body"))
_OUTER = _TEXT | {"html"}
_NOT_P = BLOCKS - {"p"}
_LISTS = frozenset("ul ol menu dir dl".split())
_TO_THE_END = frozenset("script style textarea xmp noframes noembed".split())
_END = {t: re.compile(f"</{t}", re.I) for t in RAW}
_SPLIT = re.compile(r"[^a-z0-9]+")


def _hidden(tag: str, attributes: str, in_article: bool) -> bool:
    """Whether an element with this start tag is none of the main text."""
    if tag in EXCLUDED or tag in RAW or tag == "header" and not in_article:
        return True
    if "=" not in attributes or tag in ("html", "body", "article", "main"):
        return False
    for key, *values in _NAMED.findall(attributes):
        parts = set(_SPLIT.split("".join(values).lower()))
        if key.lower() == "role":
            if parts & ROLES:
                return True
        elif parts & NAMES or parts & HEADER_NAMES and not parts & ARTICLE_NAMES:
            return True
    return False


def parse(page: str) -> list[tuple[str, int, int, str, bool, bool]]:
    """(kind, words, block, text, hidden, in the article) of each stretch of text and each tag.

    Kinds of text are ``word:`` and the element it stands in (link, heading,
    list item, else plain), kinds of tags ``tag:`` and a block tag's name or
    ``inline``; tags have no words.
    """
    out: list[tuple[str, int, int, str, bool, bool]] = []
    top = _ROOT
    stack: list[tuple[str, bool, bool, str]] = []
    block, at, n = 0, 0, len(page)
    while at < n:
        m = _TAG.search(page, at)
        stop = m.start() if m else n
        if stop > at:
            text = page[at:stop]
            out.append((top[3], len(text.split()), block, text, top[1], top[2]))
        if not m:
            break
        at = m.end()
        closing, tag, rest = m.groups()
        if not tag:
            continue
        tag = tag.lower()
        is_block = tag in BLOCKS
        if closing:
            if stack and stack[-1][0] == tag:
                stack.pop()
            else:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == tag:
                        del stack[i:]
                        break
                    if stack[i][0] in _TEXT and tag not in _OUTER:
                        break  # a stray end tag closes nothing outside the text
        else:
            if stack:
                if tag in CLOSED_BY_BLOCK:
                    _close(stack, "p", _NOT_P)
                if tag == "li":
                    _close(stack, "li", _LISTS)
                elif tag == "dt" or tag == "dd":
                    _close(stack, "dt", _LISTS)
                    _close(stack, "dd", _LISTS)
            _, hidden, marked, where = stack[-1] if stack else _ROOT
            marked = marked or tag == "article" or tag == "main"
            if tag in RAW and not (rest.endswith("/>") and tag in ("svg", "math")):
                end = _END[tag].search(page, at)
                if end:
                    at = end.start()
                elif tag in _TO_THE_END:
                    at = n
            if tag not in VOID and not rest.endswith("/>"):
                if tag == "a" or tag == "li":
                    where = "word:" + tag
                elif is_block:
                    where = "word:heading" if tag in HEADINGS else "word:plain"
                stack.append((tag, hidden or _hidden(tag, rest, marked and tag not in ("article", "main")), marked, where))
        top = stack[-1] if stack else _ROOT
        if is_block:
            block += 1
            out.append(("tag:" + tag, 0, block, "", False, False))
        else:
            if tag == "br":
                out.append(("word:plain", 0, block, " ", top[1], top[2]))
            out.append(("tag:inline", 0, block, "", False, False))
    return out


def _close(stack, tag, within) -> None:
    for i in range(len(stack) - 1, -1, -1):
        if stack[i][0] == tag:
            del stack[i:]
            return
        if stack[i][0] in within:
            return


def _label(items) -> str | None:
    """What marks the page's text: words inside article or main that aren't hidden."""
    return "yes" if any(n and marked and not hidden for _, n, _, _, hidden, marked in items) else None


def counts(page: str) -> dict[str, list[int]]:
    """Kind to [inside, outside] counts of a labelled page; nothing for the others."""
    items = parse(page)
    if not _label(items):
        return {}
    first = min(i for i, x in enumerate(items) if x[1] and x[5] and not x[4])
    last = max(i for i, x in enumerate(items) if x[1] and x[5] and not x[4])
    by: dict[str, list[int]] = {}
    for i, (kind, n, _, _, hidden, marked) in enumerate(items):
        word = kind.startswith("word:")
        inside = marked and not hidden if word else first < i < last
        by.setdefault(kind, [0, 0])[not inside] += n if word else 1
    return by


def weights(totals: dict[str, tuple[int, int]]) -> dict[str, float]:
    """Scores by kind: log-odds of standing inside, positive for words and negative for tags.

    Each kind counts one inside and one outside besides those seen; a kind
    of words that stands outside more often than inside scores little.
    """
    out = {}
    for kinds, low, high in ((["word:plain", "word:heading", "word:li", "word:a"], 0.02, 3.0),
                             (["tag:inline", *[f"tag:{t}" for t in sorted(BLOCKS)]], -6.0, -0.2)):
        inside = sum(totals.get(k, (0, 0))[0] for k in kinds) + 2
        outside = sum(totals.get(k, (0, 0))[1] for k in kinds) + 2
        for k in kinds:
            a, b = totals.get(k, (0, 0))
            s = log((a + 1) / inside) - log((b + 1) / outside)
            out[k] = min(max(s, low), high)
    return out


def best_region(scores: list[float]) -> tuple[int, int]:
    """(first, end) of the contiguous run with the largest positive sum; the earliest, (0, 0) if none."""
    best, lo, hi, run, start = 0.0, 0, 0, 0.0, 0
    for i, s in enumerate(scores):
        if run <= 0:
            run, start = 0.0, i
        run += s
        if run > best:
            best, lo, hi = run, start, i + 1
    return lo, hi


def main_text(page: str | None, score: dict[str, float]) -> str:
    """The visible blocks of the best region, white space collapsed, joined by two newlines."""
    items = parse(page or "")
    lo, hi = best_region([0.0 if hidden and n else n * (score[kind] + MARK * marked) if n else 0.0 if kind.startswith("word:") else score[kind]
                          for kind, n, _, _, hidden, marked in items])
    text: dict[int, list[str]] = {}
    for kind, _, block, raw, hidden, _ in items[lo:hi]:
        if kind.startswith("word:") and not hidden:
            text.setdefault(block, []).append(raw)
    joined = (" ".join(entities.unescape("".join(parts)).split()) for _, parts in sorted(text.items()))
    return "\n\n".join(b for b in joined if b)


def learn(pages: DataFrame, *, html: str = "html") -> dict[str, float]:
    """Weights from all labelled pages of the table."""
    src = pages.select(F.col(W.quoted(html)).cast("string").alias("html"))

    def run(batches):
        total: dict[str, list[int]] = {}
        for batch, _, _ in W.blocks(batches, "html"):
            for page in batch.column(0).to_pylist():
                for k, (a, b) in counts(page or "").items():
                    t = total.setdefault(k, [0, 0])
                    t[0] += a
                    t[1] += b
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array([t[0] for t in total.values()], pa.int64()),
                                          pa.array([t[1] for t in total.values()], pa.int64())], names=["kind", "a", "b"])

    found = src.mapInArrow(run, "kind string, a long, b long").groupBy("kind").agg(F.sum("a"), F.sum("b"))
    return weights({k: (a, b) for k, a, b in found.collect()})  # one row per kind


def extract(pages: DataFrame, score: dict[str, float], *, html: str = "html") -> DataFrame:
    """``pages`` without ``html``, with ``text`` and ``n_chars`` (its code points)."""
    kept = [n for n in pages.columns if n not in (html, "text", "n_chars")]
    rest = [F.col(W.quoted(n)).alias(f"c{i}") for i, n in enumerate(kept)]
    packed = pages.select(F.struct(F.lit(0).alias("none"), *rest).alias("row"), F.col(W.quoted(html)).cast("string").alias("html"))
    schema = T.StructType([packed.schema["row"], T.StructField("text", T.StringType())])

    def run(batches):
        for batch, _, _ in W.blocks(batches, "html"):
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array([main_text(p, score) for p in batch.column("html").to_pylist()], pa.string())],
                names=["row", "text"])

    done = packed.mapInArrow(run, schema)
    return done.select(*[F.col(f"row.c{i}").alias(n) for i, n in enumerate(kept)], "text", F.length("text").cast("long").alias("n_chars"))
