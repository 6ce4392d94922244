"""Cutting lineage through tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side of a join is broadcast only when a count shows that it has no more rows than this.
BROADCAST_ROWS = 100_000
#: Bits of a filter that is broadcast instead of a larger side, for each of its rows and at most.
ROW_BITS, FILTER_BITS = 16, 1 << 26

_local_root: str | None = None


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; only a local session may go without that setting."""
    global _local_root
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not (spark.conf.get("spark.master", "local") + "[").startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if _local_root is None:
        _local_root = "file://" + tempfile.mkdtemp(prefix="spark-")
    return _local_root


#: Paths given out inside each open ``clearing``.
_given: list[list[str]] = []


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_folder(spark)}/quillmesh/{name}-{uuid.uuid4().hex}"
    if _given:
        _given[-1].append(path)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Remove a written table; its readers must be done."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def clearing(spark: SparkSession) -> Iterator[None]:
    """Tables that operators write inside are removed at the end. What is to last must have been
    computed and written by then, to a path from before."""
    _given.append([])
    try:
        yield
    finally:
        for path in _given.pop():
            remove(spark, path)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the tables that are written inside go as soon as each is written. They would
    else stay until the driver happens to collect its garbage, all of a run beside each other."""
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, "true")
    try:
        yield
    finally:
        spark.conf.unset(setting) if before is None else spark.conf.set(setting, before)


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: computed once, and safe when executors go."""
    spark = df.sparkSession
    path = new_path(spark, name)
    with shuffles_removed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if counting shows that it is small. ``df`` should be materialised."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def sifted(rows: DataFrame, key: Column, side: DataFrame, side_key: Column) -> tuple[DataFrame, DataFrame]:
    """The rows whose key may be one of ``side``'s, with all that are, and the others. ``side`` should
    be materialised; a bit filter of its keys is broadcast, so that ``rows`` stay where they lie."""
    bits = min(FILTER_BITS, 1 << max(16, (side.count() * ROW_BITS).bit_length()))
    place = lambda k: F.pmod(F.xxhash64(k.cast("string")), F.lit(bits))
    words = side.select(place(side_key).alias("p")).groupBy(F.expr("p div 64").alias("w")).agg(F.expr("bit_or(shiftleft(1L, cast(p % 64 AS int)))").alias("b"))
    words = side.sparkSession.range(bits // 64).join(words, F.col("id") == F.col("w"), "left").select(F.struct("id", F.coalesce("b", F.lit(0).cast("long")).alias("b")).alias("x"))
    words = F.broadcast(materialize(words.agg(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["b"]).alias("__bits")), "bits"))
    rows = rows.withColumn("__place", place(key))
    hit = F.expr("shiftrightunsigned(__bits[cast(__place div 64 AS int)], cast(__place % 64 AS int)) % 2 <> 0")
    return tuple(rows.join(words, hit, how).drop("__place") for how in ("left_semi", "left_anti"))


def without(rows: DataFrame, gone: DataFrame, same: Column, key: Column, gone_key: Column) -> DataFrame:
    """``rows`` without those that meet a row of ``gone`` (materialised) by ``same``, which holds for
    equal keys only. However many are gone, no more than rows that may be among them are shuffled."""
    if gone.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return rows.join(F.broadcast(gone), same, "left_anti")
    suspects, others = sifted(rows, key, gone, gone_key)
    return others.unionByName(suspects.join(gone, same, "left_anti"))
