"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmesh.storage import materialize


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))"), F.expr("bit_xor(xxhash64(v, u, 7L))")).first())


def components(links: DataFrame) -> DataFrame:
    """``doc, component`` for every end of a link (columns a, b): the smallest id that is reachable,
    except the smallest ids themselves.

    Alternating stars: each round hangs larger neighbours, then smaller ones, on the smallest
    neighbour, until every node hangs on the smallest of its component. Rounds grow with the
    logarithm of the longest path; tables between rounds are written to the shared folder.
    """
    edges = materialize(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    state = _state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        edges = materialize(
            small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v"))).distinct(),
            "edges",
        )
        before, state = state, _state(edges)
        if state == before:
            return edges.select(F.col("u").alias("doc"), F.col("v").alias("component"))
