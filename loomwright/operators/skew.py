"""Joins and broadcasts that hold when one key has a third of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows a side may have to be broadcast. The size is counted before, never assumed.
BROADCAST_ROWS = 100_000
#: A key with more than one in HOT_SHARE rows is hot, so there can be at most HOT_SHARE hot keys.
HOT_SHARE = 1_000


def fits(frame: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether ``frame`` has at most ``rows`` rows; counts no further than that."""
    return frame.limit(rows + 1).count() <= rows


def bounded(frame: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``frame`` with a broadcast hint if it is counted to be small, else as it is (a shuffle join follows)."""
    return F.broadcast(frame) if fits(frame, rows) else frame


def lookup(left: DataFrame, right: DataFrame, key: str, counts: DataFrame, how: str = "left", share: int = HOT_SHARE) -> DataFrame:
    """Join ``left`` with ``right``, which has one row a key, however skewed ``left`` is.

    ``counts(key, n)`` has the rows of ``left`` by key. Keys with more than one in ``share`` of all
    rows number ``share`` at most, so their part of ``right`` is broadcast and no hot group is
    shuffled; the other keys are joined by shuffle. Null keys join nothing: they are kept by a left
    join and dropped by an inner one. ``right`` must not share columns with ``left`` but for ``key``.
    """
    limit = counts.agg((F.sum("n") / share).alias("limit")).scalar()
    hot = F.broadcast(counts.filter(F.col("n") > limit).select(key).withColumn("_hot", F.lit(True)))
    tagged = left.join(hot, key, "left")
    head = tagged.filter("_hot").drop("_hot")
    tail = tagged.filter("_hot is null").drop("_hot")
    few = F.broadcast(right.join(hot, key, "left_semi"))
    return head.join(few, key, how).unionByName(tail.join(right, key, how))


def salted(column: Column | str, salts: int) -> Column:
    """A salt from 0 to ``salts`` - 1 that depends on the row's own value, so a rerun gives the same."""
    return F.pmod(F.xxhash64(column), F.lit(salts)).cast("int")
