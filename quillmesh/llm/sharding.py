"""Sharding by sampled splitters (operator 5), law ``bytes``.

The order is by content hash and id, so that equal texts are neighbours. A size-weighted sample
gives the boundaries of many ranges; ranges that turn out overfull are subdivided by denser samples;
exact sums over the ranges then put every row at its byte position, which decides its shard.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillmesh.storage import materialize, small_side

SHARDS = 24
#: Bytes that a record takes besides its text.
RECORD_BYTES = 8
#: Expected sampled rows per range; the sample on the driver is about this times the ranges.
SAMPLES_PER_RANGE = 8
#: Ranges per shard: at least, and at most (the driver holds one boundary for each).
RANGES_PER_SHARD = (32, 2048)
ROWS_PER_RANGE = 500_000
#: Equal texts stay in one shard if together they have at most this part of a shard's bytes.
KEPT_TOGETHER = 0.04


def _sample(rows: DataFrame, expected: float, total: int) -> pd.DataFrame:
    """Keys drawn with a chance in proportion to size, by a hash of the row so that retries agree."""
    chance = F.col("size") * F.lit(expected / total)
    drawn = F.pmod(F.xxhash64("id", "k", F.lit(17)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    return rows.where(drawn < chance).select("k", "id", F.greatest(chance, F.lit(1.0)).alias("weight")).toPandas()


def _splitters(sample: pd.DataFrame, ranges: int) -> list[tuple[int, int]]:
    """Keys at the weighted quantiles of a sample."""
    sample = sample.fillna({"id": np.iinfo(np.int64).min}).sort_values(["k", "id"])
    at = sample["weight"].cumsum().to_numpy()
    if not len(at):
        return []
    cuts = np.searchsorted(at, at[-1] * np.arange(1, ranges) / ranges)
    return [(int(k), int(i)) for k, i in zip(sample["k"].to_numpy()[cuts], sample["id"].to_numpy()[cuts])]


def _ranged(rows: DataFrame, splitters: list[tuple[int, int]]) -> DataFrame:
    """``rows`` with the number of splitters not above their key, as ``r``."""
    keys = np.array([k for k, _ in splitters], dtype=np.int64)
    ids = np.array([i for _, i in splitters], dtype=np.int64)
    hashes, starts, counts = np.unique(keys, return_index=True, return_counts=True)
    sent = rows.sparkSession.sparkContext.broadcast((keys, ids, hashes, starts, counts))

    @F.pandas_udf("int")
    def position(k: pd.Series, i: pd.Series) -> pd.Series:
        keys, ids, hashes, starts, counts = sent.value
        k, i = k.to_numpy(), i.to_numpy()
        out = np.searchsorted(keys, k, "left")
        if len(hashes):
            same = np.minimum(np.searchsorted(hashes, k), len(hashes) - 1)
            at_splitter = hashes[same] == k
            for h in np.unique(same[at_splitter]):
                rows, s, n = np.flatnonzero(at_splitter & (same == h)), starts[h], counts[h]
                out[rows] = s + np.searchsorted(ids[s : s + n], i[rows], "right")
        return pd.Series(out.astype(np.int32))

    return rows.withColumn("r", position("k", F.coalesce("id", F.lit(np.iinfo(np.int64).min))))


def split_ranges(rows: DataFrame, ranges: int, total: int) -> DataFrame:
    """``rows`` (id, k, size) with the id ``r`` of their range, ranges ordered by (k, id)."""
    splitters = sorted(set(_splitters(_sample(rows, SAMPLES_PER_RANGE * ranges, total), ranges)))
    fair = total / ranges
    for _ in range(3):
        ranged = _ranged(rows, splitters)
        overfull = ranged.groupBy("r").agg(F.sum("size").alias("b"), F.max("size").alias("most")).where((F.col("b") > 2 * fair) & (F.col("b") > 2 * F.col("most"))).toPandas()
        if overfull.empty:
            break
        inside = ranged.where(F.col("r").isin([int(r) for r in overfull["r"]]))
        parts = int(np.ceil(overfull["b"].sum() / fair)) * 2
        more = _splitters(_sample(inside, 4 * SAMPLES_PER_RANGE * parts, int(overfull["b"].sum())), parts)
        if set(more) <= set(splitters):
            break
        splitters = sorted({*splitters, *more})
    return _ranged(rows, splitters)


def shard_by_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS, record_bytes: int = RECORD_BYTES) -> DataFrame:
    """One row per input row: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``.

    * ``size`` is the text's UTF-8 bytes (null: none) plus ``record_bytes``.
    * Shards' bytes differ by about a record, or by ``KEPT_TOGETHER`` of a shard where a group of
      equal texts is kept whole; larger groups are split over neighbouring shards.
    * ``slot`` counts from 0 in each shard without gaps. A null id sorts first; repeated rows each
      get a slot (in an order that may differ between runs, as nothing tells them apart).
    * Fewer rows than shards leave shards empty; an empty table gives no row.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = materialize(
        docs.select(F.col(id_col).cast("long").alias("id"), (F.octet_length(text) + record_bytes).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("crc"), F.xxhash64(text).alias("k")),
        "records",
    )
    total, n = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
    least, most = RANGES_PER_SHARD
    ranges = shards * min(most, max(least, n // (shards * ROWS_PER_RANGE)))
    ranged = materialize(split_ranges(rows, ranges, max(total, 1)), "ranged")

    sums = ranged.groupBy("r").agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("c")).toPandas().sort_values("r")
    sums["base"], sums["before"] = sums["b"].cumsum() - sums["b"], sums["c"].cumsum() - sums["c"]
    bases = rows.sparkSession.createDataFrame([(int(r), int(b), int(c)) for r, b, c in zip(sums["r"], sums["base"], sums["before"])], "r int, base long, before long")
    inside = Window.partitionBy("r").orderBy("k", F.col("id").asc_nulls_first())
    placed = materialize(
        ranged.withColumn("cum", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("nth", F.row_number().over(inside))
        .join(F.broadcast(bases), "r")
        .select("id", "size", "crc", "k", (F.col("base") + F.col("cum") - F.col("size")).alias("at"), (F.col("before") + F.col("nth") - 1).alias("rank")),
        "placed",
    )
    share = total / shards
    groups = placed.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("b"), F.min("at").alias("first")).where((F.col("n") > 1) & (F.col("b") <= KEPT_TOGETHER * share))
    groups = small_side(materialize(groups.select("k", (F.col("first") + F.col("b") / 2).alias("middle")), "groups"))
    middle = F.coalesce("middle", F.col("at") + F.col("size") / 2)
    sharded = materialize(placed.join(groups, "k", "left").withColumn("shard", F.least(F.lit(shards - 1), F.floor(middle * shards / max(total, 1))).cast("int")), "sharded")
    first = sharded.groupBy("shard").agg(F.min("rank").alias("first_rank"))
    return sharded.join(F.broadcast(first), "shard").select(
        F.col("id").alias("doc_id"),
        "size",
        F.col("crc").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("rank") - F.col("first_rank")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op5_sampled_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_by_bytes(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op5_sampled_splitters": op5_sampled_splitters}
ORACLE: dict[str, str] = {}
