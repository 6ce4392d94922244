"""Exact deduplication with DataFrame functions only (operator 3).

A 128-bit hash of the whole text finds the groups; texts are shuffled only for rows whose hash
occurs more than once, and there they are compared byte by byte (grouping by the text itself, with
map-side partial aggregation, so that a hot group sends one row per task).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmesh.storage import materialize, small_side


def content_hash(text: Column) -> Column:
    """128 bits of the text's UTF-8 bytes."""
    return F.unhex(F.md5(text))


def exact_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "largest",
    fingerprint: Callable[[Column], Column] = content_hash,
) -> DataFrame:
    """One row per input row: ``id, keep_id, group_size, kept, text_sha256``.

    * Texts are equal when their bytes are; null counts as empty. Other columns are not looked at.
    * ``keep`` is "largest" or "smallest": the id that stays in each group.
    * A row without an id loses to any row with one; a group with null ids only has a null
      ``keep_id`` and keeps its rows.
    * Repeated rows (same id and text) count in ``group_size`` and share one fate.
    * An empty table gives an empty result.
    * ``fingerprint`` may collide: only equal bytes make a group.
    """
    best = {"largest": F.max, "smallest": F.min}[keep]
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    hashed = texts.withColumn("h", fingerprint(F.col("t")))
    prints = materialize(hashed.select("id", "h", F.sha2("t", 256).alias("sha")), "fingerprints")
    repeated = materialize(prints.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h"), "repeated")
    suspects = hashed.join(small_side(repeated), "h", "left_semi")

    classes = suspects.groupBy("h", "t").agg(best("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    by_hash = materialize(
        classes.groupBy("h").agg(F.count(F.lit(1)).alias("texts"), F.max("keep_id").alias("keep_id"), F.max("group_size").alias("group_size")),
        "classes",
    )
    one_text = by_hash.where("texts = 1").select("h", "keep_id", "group_size", F.lit(True).alias("grouped"))
    joined = prints.join(small_side(one_text), "h", "left")
    collided = by_hash.where("texts > 1").select("h")
    columns = ["id", "sha", "keep_id", "group_size", "grouped"]
    out = joined.select(columns)
    if not collided.isEmpty():
        split = suspects.join(small_side(collided), "h", "left_semi")
        exact = split.join(split.groupBy("h", "t").agg(best("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")), ["h", "t"])
        out = joined.join(small_side(collided), "h", "left_anti").select(columns).unionByName(
            exact.select("id", F.sha2("t", 256).alias("sha"), "keep_id", "group_size", F.lit(True).alias("grouped"))
        )
    keep_id = F.when(F.col("grouped"), F.col("keep_id")).otherwise(F.col("id"))
    return out.select(
        F.col("id").alias(id_col),
        keep_id.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("id").eqNullSafe(keep_id).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE = {
    "op3_exact_dedup": """
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
        SELECT doc_id,
               max(doc_id) OVER (PARTITION BY t) AS keep_id,
               count(*) OVER (PARTITION BY t) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY t) AS kept,
               sha256(t) AS text_sha256
        FROM d
    """
}
QUERIES = {"op3_exact_dedup": op3_exact_dedup}
