"""Secret scan: base patterns and windowed entropy, in DataFrame functions only.

Base kinds are patterns found leftmost and without overlap: ``assign``
(a credential name, ``:`` or ``=``, a value), ``access`` (access key ids)
and ``hex`` (long hexadecimal runs). The entropy kinds look at candidate
strings, the runs of one character class. A window of fixed length slides
over each candidate; its Shannon entropy follows from the counts of the
character that enters and of the one that leaves,

    sum(c log2 c)  +=  f(c_in + 1) - f(c_in)  +  f(c_out - 1) - f(c_out),

so no window is counted anew. Windows at or above the class's threshold that
overlap or touch become one span. A candidate that matches an allow-list
pattern gives none, and neither does a span that overlaps a base span.

Positions are code points, the end exclusive. Defined cases: a null or empty
text has no spans; overlapping base kinds are all reported; spans are ordered
by start, then by kind as listed in KINDS; repeated rows are scanned row by
row; an empty table gives an empty result; a column of the input that has the
name of a result column is replaced by it.
"""

from __future__ import annotations

from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: (kind, pattern, group that must have the least length, least length): fixed values of the contract.
BASE: tuple[tuple[str, str, int, int], ...] = (
    ("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6),
    ("access", r"AKIA[A-Z0-9]{16,}", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
)
#: (kind, pattern of candidates, what a candidate must hold besides, window, least bits a character).
CLASSES: tuple[tuple[str, str, tuple[str, ...], int, float], ...] = (
    ("entropy_hex", r"[0-9A-Fa-f]{20,}", ("[0-9]", "[A-Fa-f]"), 20, 2.8),
    ("entropy_key", r"[A-Za-z0-9+/_=-]{20,}", ("[0-9]", "[a-z]", "[A-Z]"), 20, 3.6),
    ("entropy_lower", r"[a-z0-9]{20,}", ("[0-9]", "[g-z]"), 20, 3.6),
    ("entropy_upper", r"[A-Z0-9]{20,}", ("[0-9]", "[G-Z]"), 20, 3.6),
)
#: Candidates that are no secrets: placeholders, plain counts, version-4 style ids, paths, names in one case.
ALLOW: tuple[str, ...] = (
    r"(?i)example|sample|placeholder|changeme|xxxxx|lorem",
    r"(?i)0123456789|abcdefghij",
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"^/?([A-Za-z][a-z]*[/_-])+[A-Za-z]?[a-z]*$",
)
KINDS = (*[k[0] for k in BASE], *[k[0] for k in CLASSES])
_SPAN = "array<struct<start:int,rank:int,stop:int>>"
_RUN = "array<struct<start:int,run:string>>"
#: Rows that a walk gathers in one array before it goes on with an empty one (see ``_walk``).
BLOCK = 256


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` worked out once: an expression used in a lambda is evaluated at each use."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _walk(rows: Column, state: dict[str, Column], out: str, step) -> Column:
    """What ``step`` appends to ``out`` (an array type) on its way over ``rows``; ``state`` are the other fields it keeps.

    An append copies the array, so one array for a long text would cost its square. The rows are taken in blocks:
    a block's results are gathered in an array of their own, and the arrays of the blocks are joined at the end.
    """
    def begin(fields, gathered):
        return F.struct(*[fields[n].alias(n) for n in state], F.array().cast(gathered).alias("out"))

    def over(every):
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(every) - 1) / BLOCK).cast("int")),
                             lambda k: F.slice(every, k * BLOCK + 1, F.lit(BLOCK)))
        done = F.aggregate(blocks, begin(state, f"array<{out}>"), lambda acc, block: _let(
            F.aggregate(block, begin(acc, out), step),
            lambda r: F.struct(*[r[n].alias(n) for n in state], F.concat(acc["out"], F.array(r["out"])).alias("out"))))
        return F.when(F.size(every) > 0, F.flatten(done["out"])).otherwise(F.array().cast(out))

    return _let(rows, over)


def _found(text: Column, pattern: str, group: int, least: int, rank: int) -> Column:
    """Spans of the matches whose ``group`` has at least ``least`` characters.

    The text between matches (``split``) and the matches themselves
    (``regexp_extract_all``) give the positions by their lengths.
    """
    p = F.lit(pattern)
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    hits = F.regexp_extract_all(text, p, F.lit(0))
    sizes = F.transform(hits, F.length)
    inner = sizes if group == 0 else F.transform(F.regexp_extract_all(text, p, F.lit(group)), F.length)
    steps = F.arrays_zip(gaps.alias("gap"), sizes.alias("size"), inner.alias("inner"))
    walked = _walk(
        F.filter(steps, lambda s: s["size"].isNotNull()), {"at": F.lit(0)}, _SPAN,
        lambda acc, s: F.struct(
            (acc["at"] + s["gap"] + s["size"]).alias("at"),
            F.when(s["inner"] >= least, F.concat(acc["out"], F.array(F.struct(
                (acc["at"] + s["gap"]).alias("start"), F.lit(rank).alias("rank"),
                (acc["at"] + s["gap"] + s["size"]).alias("stop"))))).otherwise(acc["out"]).alias("out")))
    return F.when(F.coalesce(text, F.lit("")).rlike(pattern), walked).otherwise(F.array().cast(_SPAN))


def _runs(text: Column, pattern: str) -> Column:
    """Start and text of every match, from the matches themselves (no substring of the whole text)."""
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    steps = F.arrays_zip(gaps.alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("run"))
    walked = _walk(
        F.filter(steps, lambda s: s["run"].isNotNull()), {"at": F.lit(0)}, _RUN,
        lambda acc, s: F.struct(
            (acc["at"] + s["gap"] + F.length(s["run"])).alias("at"),
            F.concat(acc["out"], F.array(F.struct((acc["at"] + s["gap"]).alias("start"), s["run"].alias("run")))).alias("out")))
    return F.when(text.rlike(pattern), walked).otherwise(F.array().cast(_RUN))


def _weight(c: Column) -> Column:
    """``c log2 c``, 0 at 0."""
    return F.when(c > 0, c * F.log2(F.greatest(c, F.lit(1.0)))).otherwise(F.lit(0.0))


def _dense(candidate: Column, window: int, bits: float) -> Column:
    """Merged (start, stop) of the windows of ``candidate`` with at least ``bits`` a character."""
    return _let(F.split(candidate, ""), lambda chars: _dense_chars(chars, F.length(F.array_join(chars, "")), window, bits))


def _dense_chars(chars: Column, n: Column, window: int, bits: float) -> Column:
    inside = lambda held, ch: (F.length(held) - F.length(F.replace(held, ch, F.lit("")))).cast("double")
    state = F.struct(F.lit("").alias("held"), F.lit(0.0).alias("sum"), F.array().cast("array<struct<a:int,b:int>>").alias("out"))

    def step(acc, i):
        full = F.length(acc["held"]) >= window
        old, new = F.substring(acc["held"], 1, 1), F.element_at(chars, i)
        rest = F.when(full, F.substr(acc["held"], F.lit(2))).otherwise(acc["held"])
        c_old = inside(acc["held"], old)
        c_new = inside(rest, new)
        total = (acc["sum"]
                 + F.when(full, _weight(c_old - 1) - _weight(c_old)).otherwise(F.lit(0.0))
                 + _weight(c_new + 1) - _weight(c_new))
        held = F.concat(rest, new)
        good = (F.length(held) == window) & (F.lit(log2(window)) - total / F.lit(float(window)) >= F.lit(bits))
        last = F.try_element_at(acc["out"], F.lit(-1))
        here = F.struct((i - window).alias("a"), i.alias("b"))
        joined = F.concat(F.slice(acc["out"], F.lit(1), F.greatest(F.size(acc["out"]) - 1, F.lit(0))),
                          F.array(F.struct(last["a"].alias("a"), i.alias("b"))))
        out = (F.when(~good, acc["out"])
               .when(last.isNotNull() & (last["b"] >= i - window), joined)
               .otherwise(F.concat(acc["out"], F.array(here))))
        return F.struct(held.alias("held"), total.alias("sum"), out.alias("out"))

    return F.aggregate(F.sequence(F.lit(1), n), state, step)["out"]


def _entropic(text: Column, pattern: str, needs: tuple[str, ...], window: int, bits: float, rank: int) -> Column:
    def spans(c):
        run = c["run"]
        fit = F.lit(True)
        for need in needs:
            fit = fit & run.rlike(need)
        for allowed in ALLOW:
            fit = fit & ~run.rlike(allowed)
        moved = _let(c["start"], lambda at: F.transform(_dense(run, window, bits), lambda w: F.struct(
            (at + w["a"]).alias("start"), F.lit(rank).alias("rank"), (at + w["b"]).alias("stop"))))
        return F.when(fit, moved).otherwise(F.array().cast(_SPAN))

    return F.flatten(F.transform(_runs(text, pattern), spans))


def _free(spans: Column) -> Column:
    """Spans of the entropy classes that no span of an earlier kind overlaps; ``spans`` are all, in order.

    Two passes: the furthest stop of each kind so far, then the nearest start of each kind behind.
    """
    ranks = range(len(BASE), len(KINDS))
    seen = "array<struct<start:int,rank:int,stop:int,hidden:boolean>>"

    def walk(rows, first, better, hides, keep):
        state = {f"m{r}": F.lit(first).cast("int") for r in ranks}

        def step(acc, s):
            hidden = s["hidden"]
            for r in ranks:
                hidden = hidden | ((s["rank"] == r) & hides(acc[f"m{r}"], s))
            here = F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["stop"].alias("stop"), hidden.alias("hidden"))
            return F.struct(*[F.when(s["rank"] < r, better(acc[f"m{r}"], s)).otherwise(acc[f"m{r}"]).alias(f"m{r}") for r in ranks],
                            F.when(keep(s, hidden), F.concat(acc["out"], F.array(here))).otherwise(acc["out"]).alias("out"))

        return _walk(rows, state, seen, step)

    all_of = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["stop"].alias("stop"), F.lit(False).alias("hidden")))
    # a span that is hidden itself still hides others
    ahead = walk(all_of, -1, lambda m, s: F.greatest(m, s["stop"]), lambda m, s: m > s["start"], lambda s, hidden: F.lit(True))
    behind = walk(F.reverse(ahead), 1 << 30, lambda m, s: F.least(m, s["start"]), lambda m, s: m < s["stop"],
                  lambda s, hidden: ~hidden & (s["rank"] >= len(BASE)))
    return F.transform(behind, lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["stop"].alias("stop")))


def scan(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """``docs`` with ``base_spans`` and ``spans``: arrays of (kind, start, stop), in order."""
    t = F.coalesce(F.col(text), F.lit(""))
    rows = docs.withColumn("base_spans", F.array_sort(F.concat(
        *[_found(t, p, g, n, i) for i, (_, p, g, n) in enumerate(BASE)])))
    more = F.concat(*[_entropic(t, p, needs, w, bits, len(BASE) + i)
                      for i, (_, p, needs, w, bits) in enumerate(CLASSES)])
    # all spans are a column of their own, so that both walks see what was worked out once
    held = "every_span"
    while held in rows.columns:
        held += "_"
    rows = rows.withColumn(held, F.array_sort(F.concat("base_spans", more)))
    rows = rows.withColumn("spans", F.array_sort(F.concat("base_spans", _free(F.col(held))))).drop(held)
    kinds = F.array(*[F.lit(k) for k in KINDS])
    for c in ("base_spans", "spans"):
        rows = rows.withColumn(c, F.transform(c, lambda s: F.struct(
            F.element_at(kinds, s["rank"] + 1).alias("kind"), s["start"].alias("start"), s["stop"].alias("stop"))))
    return rows


def listed(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def redacted(text: Column, spans: Column, mark: str = "[REDACTED]") -> Column:
    """``text`` with every span, overlapping ones together, replaced by ``mark``."""
    def gap(stretch, origin, lo, hi):
        return F.substr(stretch, lo - origin + 1, F.greatest(hi - lo, F.lit(0)))

    def over(every):
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(every) - 1) / BLOCK).cast("int")),
                             lambda k: F.slice(every, k * BLOCK + 1, F.lit(BLOCK)))

        def block_of(acc, block):
            stop = F.array_max(F.transform(block, lambda s: s["stop"]))
            stretch = gap(text, F.lit(0), acc["at"], stop)

            def step(inner, s):
                return (F.when(s["stop"] <= inner["at"], inner)
                        .when(s["start"] < inner["at"], F.struct(
                            s["stop"].alias("at"), inner["origin"].alias("origin"), inner["stretch"].alias("stretch"), inner["out"].alias("out")))
                        .otherwise(F.struct(
                            s["stop"].alias("at"), inner["origin"].alias("origin"), inner["stretch"].alias("stretch"),
                            F.concat(inner["out"], gap(inner["stretch"], inner["origin"], inner["at"], s["start"]), F.lit(mark)).alias("out"))))

            start = F.struct(acc["at"].alias("at"), acc["at"].alias("origin"), stretch.alias("stretch"), F.lit("").alias("out"))
            return _let(F.aggregate(block, start, step), lambda r: F.struct(
                r["at"].alias("at"), F.concat(acc["out"], F.array(r["out"])).alias("out")))

        begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
        return F.aggregate(blocks, begin, block_of, lambda acc: F.concat(F.array_join(acc["out"], ""), F.substr(text, acc["at"] + 1)))

    return F.when(F.size(spans) > 0, _let(spans, over)).otherwise(text)
