"""Joins that bear with hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

#: A key is hot if it holds more rows than this and more than one in
#: ten thousand of all, so there are at most 10,000 hot keys.
HOT = 100_000
SHARE = 10_000


def join_values(rows: DataFrame, values: DataFrame, on: Sequence[str], n: str = "n") -> DataFrame:
    """Inner join of ``rows`` with one row of ``values`` per key, whose column
    ``n`` tells how many rows hold that key and is dropped.

    Hot keys, at most ``SHARE`` of them, are broadcast and their rows stay
    where they are; all others are joined by shuffling.
    """
    on = list(on)
    total = values.agg(F.sum(n)).first()[0] or 0
    limit = max(HOT, total // SHARE)
    hot = values.where(F.col(n) > limit)
    if hot.isEmpty():
        return rows.join(values.drop(n), on)
    few = F.broadcast(hot.drop(n))
    rest = rows.join(F.broadcast(hot.select(*on)), on, "left_anti").join(values.where(F.col(n) <= limit).drop(n), on)
    return rows.join(few, on).unionByName(rest)
