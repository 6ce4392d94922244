"""Joins whose left side may have a third of its rows under one key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmesh.storage import BROADCAST_ROWS, materialize

#: A key is hot if it has more than one in so many of the left rows: there are never more hot keys than this.
HOT_SHARE = 1000


def join_hot(left: DataFrame, right: DataFrame, key: str, how: str = "inner", limit: int = BROADCAST_ROWS) -> DataFrame:
    """``left.join(right, key, how)`` ("inner" or "left"). ``left`` has no null key and ``right`` few
    rows a key; both should be materialised.

    A right side that a count shows to be small is broadcast. Otherwise the right rows of hot keys are
    broadcast to the left rows where they lie, and the other keys, each with a small share of the
    rows, meet by a shuffle.
    """
    if right.limit(limit + 1).count() <= limit:
        return left.join(F.broadcast(right), key, how)
    least = left.count() // HOT_SHARE
    hot = F.broadcast(materialize(left.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > least).select(key), "hot"))
    of_hot = left.join(hot, key, "left_semi").join(F.broadcast(right.join(hot, key, "left_semi")), key, how)
    others = left.join(hot, key, "left_anti").join(right.join(hot, key, "left_anti"), key, how)
    return of_hot.unionByName(others)
