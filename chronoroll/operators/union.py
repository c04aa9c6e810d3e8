"""Union of several frames.

``union_by_position`` keeps the reference's behaviour (columns matched by
position, names from the first frame, duplicates kept). ``union_by_name``
is the safe mode: columns matched by name, missing ones filled with null.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def union_by_position(frames: list[DataFrame]) -> DataFrame:
    if not frames:
        raise ValueError("nothing to union")
    return reduce(lambda a, b: a.union(b), frames)


def union_by_name(frames: list[DataFrame], allow_missing: bool = True) -> DataFrame:
    if not frames:
        raise ValueError("nothing to union")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)
