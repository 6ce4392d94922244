"""Tables that change: upserts by bucket, and appends that happen once."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from quillmesh.operators import artifacts
from quillmesh.storage import materialize

BUCKETS = 64
_BUCKET = "bucket_of_"
_WRITER, _BATCH = "written_by", "written_batch"


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at a path, or None if there is none yet."""
    try:
        return spark.read.option("recursiveFileLookup", "false").parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def _replace_partitions(rows: DataFrame, path: str, by: Sequence[str]) -> None:
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def _check_columns(rows: DataFrame, existing: DataFrame, path: str) -> None:
    if dict(existing.dtypes) != dict(rows.dtypes):
        raise ValueError(f"the table at {path} has {existing.dtypes}, not {rows.dtypes}")


def _same(left: DataFrame, right: DataFrame, columns: Sequence[str]):
    return reduce(and_, [left[c].eqNullSafe(right[c]) for c in columns])


# --- upserts ------------------------------------------------------------------------------------


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A table written by ``upsert``."""
    rows = spark.read.parquet(path)
    return rows.drop(*[c for c in rows.columns if c.startswith(_BUCKET)])


def upsert(changes: DataFrame, path: str, keys: Sequence[str], order: Sequence[str], buckets: int = BUCKETS) -> list[int]:
    """Insert rows or replace those of the same keys; of several changes to a key the last by
    ``order`` counts. Returns the touched buckets.

    The table is partitioned by a hash of the keys; only the buckets that changes fall into are read
    and rewritten, each swapped in whole when the job commits. Changes that were already applied
    change nothing, so an interrupted upsert is repaired by repeating it. One upsert runs at a time.
    Null keys are keys. A table of other columns or of another number of buckets is refused.
    """
    spark, column = changes.sparkSession, f"{_BUCKET}{buckets}"
    newest = artifacts.latest(changes, list(keys), list(order)).select(changes.columns)
    newest = materialize(newest.withColumn(column, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")), "changes")
    touched = sorted(r[0] for r in newest.select(column).distinct().collect())  # no more than there are buckets
    if not touched:
        return []
    merged, existing = newest, _stored(spark, path)
    if existing is not None:
        if column not in existing.columns:
            raise ValueError(f"the table at {path} doesn't have {buckets} buckets")
        _check_columns(changes, existing.drop(column), path)
        old = existing.where(F.col(column).isin(touched))
        merged = old.join(newest, (old[column] == newest[column]) & _same(old, newest, keys), "left_anti").select(newest.columns).unionByName(newest)
    # the old buckets are read until the new ones are complete
    merged = materialize(merged, "merged")
    _replace_partitions(merged.repartition(column), path, [column])
    return touched


# --- appends ------------------------------------------------------------------------------------


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """A table written by ``append_once``."""
    return spark.read.parquet(path).drop(_WRITER, _BATCH)


def append_once(rows: DataFrame, path: str, writer: str, batch: int, keys: Sequence[str]) -> bool:
    """Add a batch of rows to a table that only grows. Returns whether anything was added.

    A batch is known by its writer and number: it is one folder, put in place by one rename when its
    job commits, so that it is there whole or not at all, and a batch that is already there adds nothing.
    Several writers may write at once: they have folders of their own.
    Rows are never changed: a row whose keys are stored with other values (or twice in the batch with
    different values) is an error, and one that is stored already, by any writer, isn't stored again.
    A table of other columns is refused.
    """
    if not re.fullmatch(r"[A-Za-z0-9._-]+", writer):
        raise ValueError(f"not a name of a writer: {writer!r}")
    spark, by = rows.sparkSession, f"writer-{writer}"
    existing = _stored(spark, path)
    fresh = materialize(rows.dropDuplicates(), "batch")
    twice = fresh.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if not twice.isEmpty():
        raise ValueError(f"different rows with the same {', '.join(keys)}: {twice.first().asDict()}")
    if existing is not None:
        _check_columns(rows, existing.drop(_WRITER, _BATCH), path)
        if not existing.where((F.col(_WRITER) == by) & (F.col(_BATCH) == batch)).isEmpty():
            return False
        mine = fresh.withColumn("__mine", F.lit(True))
        met = existing.join(mine, _same(existing, mine, keys), "inner")
        if not met.where(~_same(existing, mine, rows.columns)).isEmpty():
            raise ValueError(f"rows in {path} are never changed: a stored row with the same {', '.join(keys)} has other values")
        fresh = fresh.join(existing, _same(fresh, existing, keys), "left_anti")
    fresh = fresh.select(*rows.columns, F.lit(by).alias(_WRITER), F.lit(batch).cast("long").alias(_BATCH))
    if fresh.isEmpty():
        return False
    _replace_partitions(fresh, path, [_WRITER, _BATCH])
    return True


def ledger_sink(stream: DataFrame, path: str, writer: str, checkpoint: str, keys: Sequence[str]) -> DataStreamWriter:
    """A stream into an append-only table. A batch that is replayed after a failure adds nothing, also
    if the table was written before the stream's own checkpoint was."""
    return stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda rows, batch: append_once(rows, path, writer, batch, keys) and None)
