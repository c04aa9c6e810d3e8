"""Distinct counts that can be merged: exact bitmaps, and set expressions of theta sketches.

A count of distinct values per hour says nothing about the day. Stored as
bitmaps it does: ids are split in buckets of 32,768, each bucket of a group is
one bitmap of 4 KB, and bitmaps of a coarser bucket or fewer dimensions are
their bitwise or. Exact, whatever the order of the loads; meant for ids that
are dense (numbered from a sequence). Sparse ids cost a bitmap each at worst,
which compresses to a few bytes.

Theta sketches are merged by union too, and two of them can be intersected or
subtracted: users of one kind of event and not of another.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKET, BITMAP = "_bucket", "_bitmap"


def _keys(keys: list[str]) -> list[Column]:
    return [F.col(f"`{k}`") for k in keys]


def bitmap_states(df: DataFrame, keys: list[str], column: str) -> DataFrame:
    """One row per group and bucket of ids: ``keys``, ``_bucket``, ``_bitmap``.

    ``column`` is an integer column; nulls are no values, a group without a
    value has no state.
    """
    x = F.col(f"`{column}`").cast("long")
    rows = df.where(x.isNotNull()).select(*_keys(keys), F.bitmap_bucket_number(x).alias(BUCKET), F.bitmap_bit_position(x).alias("_at"))
    return rows.groupBy(*_keys(keys), BUCKET).agg(F.bitmap_construct_agg("_at").alias(BITMAP))


def merge_bitmaps(states: DataFrame, keys: list[str]) -> DataFrame:
    """Stored states merged to fewer or coarser ``keys`` (A10)."""
    return states.groupBy(*_keys(keys), BUCKET).agg(F.bitmap_or_agg(BITMAP).alias(BITMAP))


def count_bitmaps(states: DataFrame, keys: list[str], name: str = "n_distinct") -> DataFrame:
    """The exact distinct count of each group of ``keys``, from states of any finer keys."""
    return merge_bitmaps(states, keys).groupBy(*_keys(keys)).agg(F.sum(F.bitmap_count(BITMAP)).alias(name))


def theta_sets(states: DataFrame, keys: list[str], sketch: str, a: Column, b: Column, lg_k: int = 12) -> DataFrame:
    """Sketches of the values in rows of ``a`` and of ``b``, per group of ``keys`` (A2).

    ``states`` holds stored theta states, ``a`` and ``b`` are conditions on
    its rows. Columns ``a``, ``b``, ``both`` (in either), ``common`` (in both)
    and ``only_a`` are states again: they merge, intersect and count like any.
    A side without rows is the empty set.
    """
    s = F.col(f"`{sketch}`")
    sides = states.groupBy(*_keys(keys)).agg(F.theta_union_agg(F.when(a, s), lg_k).alias("a"), F.theta_union_agg(F.when(b, s), lg_k).alias("b"))
    return sides.select(*_keys(keys), "a", "b", F.theta_union("a", "b", lg_k).alias("both"),
                        F.theta_intersection("a", "b").alias("common"), F.theta_difference("a", "b").alias("only_a"))


def theta_counts(sets: DataFrame, names: list[str]) -> DataFrame:
    """The named sketch columns as estimates."""
    return sets.select(*[F.theta_sketch_estimate(c).alias(c) if c in names else F.col(f"`{c}`") for c in sets.columns])
