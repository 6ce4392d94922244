"""Running sums and budgets over an order that no single task has to hold."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmesh.storage import materialize, small_side


def running_sums(rows: DataFrame, keys: list[str], order: list[str], amounts: list[str]) -> DataFrame:
    """``rows`` with ``used_<amount>``: for each of ``amounts`` the sum over the rows of the key up to
    and with the row itself, in ``order``, which should be total. Null amounts count as 0, null keys as a key.

    Rows are cut into ranges of (keys, order). Each range is summed for itself, and takes over the sums
    of those before it, which are one row a range and key. So one key may hold all rows.
    """
    # written, as the ranges of a second run could differ
    ranged = materialize(rows.repartitionByRange(*keys, *order).withColumn("__range", F.spark_partition_id()), "ranged")
    totals = ranged.groupBy("__range", *keys).agg(*[F.coalesce(F.sum(a), F.lit(0)).alias(f"__{a}") for a in amounts])
    before = Window.partitionBy(*keys).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    names = {k: f"__key_{k}" for k in keys}
    starts = totals.select(
        F.col("__range").alias("__of"),
        *[F.col(k).alias(names[k]) for k in keys],
        *[F.coalesce(F.sum(f"__{a}").over(before), F.lit(0)).alias(f"__{a}") for a in amounts],
    )
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(names[k])) for k in keys], F.col("__range") == F.col("__of"))
    inside = Window.partitionBy("__range", *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    joined = ranged.join(small_side(materialize(starts, "starts")), same)
    sums = {f"used_{a}": F.col(f"__{a}") + F.coalesce(F.sum(a).over(inside), F.lit(0)) for a in amounts}
    return joined.withColumns(sums).drop("__range", "__of", *names.values(), *[f"__{a}" for a in amounts])


def within_budget(rows: DataFrame, keys: list[str], order: list[str], amount: str, budget: Column | float, whole: bool = True) -> DataFrame:
    """``rows`` with ``used_<amount>`` and ``accepted``: the first rows of each key, in order, until the
    budget is spent. With ``whole`` the sum stays within the budget; else a row is accepted while the
    sum before it is below the budget, so that the last one may exceed it. Amounts aren't negative.
    """
    budget = budget if isinstance(budget, Column) else F.lit(budget)
    summed = running_sums(rows, keys, order, [amount])
    used = F.col(f"used_{amount}")
    fits = used <= budget if whole else used - F.coalesce(F.col(amount), F.lit(0)) < budget
    return summed.withColumn("accepted", fits)
