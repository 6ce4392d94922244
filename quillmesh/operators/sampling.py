"""Deterministic samples: evenly spaced, and stratified by largest remainder."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillmesh.storage import materialize


def allocation(sizes: DataFrame, n: int, group: str) -> DataFrame:
    """``group, size, take``: ``n`` slots in proportion to size (columns group, size), the rest to
    the largest fractions, ties by group. Groups are few: they come from one aggregation."""
    every = Window.partitionBy()
    total = F.sum("size").over(every)
    wanted = F.least(F.lit(n).cast("long"), total)
    rows = sizes.where("size > 0").select(group, "size", wanted.alias("wanted"), total.alias("total"))
    base = F.floor(F.col("size") * F.col("wanted") / F.col("total"))
    rows = rows.withColumn("base", base).withColumn("part", (F.col("size") * F.col("wanted")) % F.col("total"))
    open_place = F.row_number().over(Window.orderBy((F.col("base") < F.col("size")).desc(), F.desc("part"), group))
    left = F.col("wanted") - F.sum("base").over(every)
    return rows.withColumn("more", (open_place <= left).cast("long")).select(group, "size", (F.col("base") + F.col("more")).alias("take"))


def _numbered(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """``rows`` with their place ``at`` (from 0) in the order within each key.

    Ranges of the order are numbered each for itself and moved by the counts of the ranges before,
    so that a large group isn't sorted by one task.
    """
    # written, as the ranges of a second run could differ
    ranged = materialize(rows.repartitionByRange(*keys, *order).withColumn("__part", F.spark_partition_id()), "ranged")
    inner = Window.partitionBy("__part", *keys).orderBy(*order)
    counted = ranged.groupBy("__part", *keys).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counted.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    if not keys:
        joined = ranged.join(F.broadcast(starts), "__part")
    else:
        joined = ranged.join(starts, ["__part", *keys])
    return joined.withColumn("at", F.col("__before") + F.row_number().over(inner) - 1).drop("__part", "__before")


def evenly_spaced(rows: DataFrame, n: int, order: list[str]) -> DataFrame:
    """Rows at the places floor(i * size / n) of the order."""
    numbered = materialize(_numbered(rows, [], order), "numbered")
    size = numbered.count()
    take = min(n, size)
    places = numbered.sparkSession.range(take).select(F.expr(f"id * {size} div {max(take, 1)}").alias("at"))
    return numbered.join(F.broadcast(places), "at", "left_semi").drop("at")


def stratified(rows: DataFrame, n: int, group: str, order: list[str]) -> DataFrame:
    """An evenly spaced sample of each group, ``n`` rows in all, sizes by ``allocation``."""
    numbered = materialize(_numbered(rows.where(F.col(group).isNotNull()), [group], order), "numbered")
    takes = allocation(numbered.groupBy(group).agg(F.count(F.lit(1)).alias("size")), n, group).where("take > 0")
    places = takes.select(group, F.explode(F.transform(F.sequence(F.lit(0).cast("long"), F.col("take") - 1), lambda i: F.floor(i * F.col("size") / F.col("take")))).alias("at"))
    return numbered.join(F.broadcast(places), [group, "at"], "left_semi").drop("at")
