"""URL filter: host-suffix and path-prefix expressions joined on short hash prefixes.

A rule is a host, a path prefix and a verdict. It fits a URL whose host is the
rule's or a subdomain of it and whose path starts with the rule's path. Every
URL is expanded into its expressions, each suffix of the host (at label
borders) followed by each prefix of the path whose length some rule has, and
these meet the rules in an equi-join on the first ``SHORT`` hexadecimal digits
of their SHA-256. The full digest then confirms a match, and the longest rule
wins (equal lengths: the longer host, then ``block``).

Each URL carries a row id through the join, so the matches of one row meet
again by that id, after a partial aggregate in the task that expanded it: a
host that holds most rows is never a key of a shuffle.

Defined cases: a null URL or one without ``://`` has an empty host and path
and fits no rule, nor does a rule without a host fit anything; repeated rows
are judged row by row; rules that repeat a host and path count once, ``block``
first; an empty table gives an empty result, no rules give the default
verdict; a column of the input named like a result column is replaced by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words as W

SHORT = 8


def lower_ascii(c: Column) -> Column:
    """A-Z in lower case, all else unchanged."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return lower_ascii(rest)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def suffixes(host: Column) -> Column:
    """The host and all its parents at label borders."""
    labels = F.split(host, r"\.", -1)
    n = F.size(labels)
    return F.when(host == "", F.array().cast("array<string>")).otherwise(
        F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(labels, i, n), ".")))


def judge(pages: DataFrame, rules: DataFrame, *, url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (host and path, or null) and ``verdict``.

    ``rules`` has string columns ``host``, ``path`` and ``verdict``.
    """
    good = rules.where((F.col("host") != "") & F.col("path").isNotNull())
    good = good.groupBy(lower_ascii(F.col("host")).alias("host"), "path").agg(F.max("verdict").alias("verdict"))
    # no more different lengths than the longest path has characters, whatever the number of rules
    lengths = sorted(r[0] for r in good.select(F.length("path")).distinct().collect())
    digest = F.sha2(F.concat("host", "path").cast("binary"), 256)
    known = good.select(
        F.substring(digest, 1, SHORT).alias("_short"), digest.alias("_digest"),
        F.struct((F.length("host") + F.length("path")).alias("size"), F.length("host").alias("host_size"),
                 F.col("verdict"), F.concat("host", "path").alias("rule")).alias("_rule"))

    taken = {"host", "path", "rule", "verdict"}
    own = [c for c in pages.columns if c not in taken]
    rows = (pages.select(*[F.col(W.quoted(c)) for c in own], host_of(F.col(W.quoted(url))).alias("host"),
                         path_of(F.col(W.quoted(url))).alias("path"))
            .withColumn("_row", F.monotonically_increasing_id()))
    prefixes = F.filter(F.array(*[F.lit(n) for n in lengths]).cast("array<int>"), lambda n: n <= F.length("path"))
    expressions = F.flatten(F.transform(suffixes(F.col("host")), lambda h: F.transform(
        prefixes, lambda n: F.concat(h, F.substr(F.col("path"), F.lit(1), n)))))
    asked = rows.select("*", F.explode_outer(expressions).alias("_expression"))
    asked = asked.withColumn("_asked", F.sha2(F.col("_expression").cast("binary"), 256))
    met = asked.join(known, F.substring("_asked", 1, SHORT) == F.col("_short"), "left")
    best = F.max(F.when(F.col("_digest") == F.col("_asked"), F.col("_rule")))
    keep = [*own, "host", "path"]
    out = met.groupBy("_row").agg(*[F.first(F.col(W.quoted(c))).alias(c) for c in keep], best.alias("_best"))
    return out.select(*[F.col(W.quoted(c)) for c in keep], F.col("_best.rule").alias("rule"),
                      F.coalesce("_best.verdict", F.lit(default)).alias("verdict"))
