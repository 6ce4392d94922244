"""One row per distinct text, so that copies are worked on once."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillmesh.storage import materialize, small_side, without


class Distinct(NamedTuple):
    #: doc, h (128-bit hash): one row per input row
    prints: DataFrame
    #: h, key, rows: one row per distinct text; key is a long of its own
    classes: DataFrame
    #: key, text: the text of each class, once
    texts: DataFrame


def distinct_texts(docs: DataFrame, id_col: str, text_col: str) -> Distinct:
    """Classes of equal texts (by md5). The key is the smallest id of the class, or, where that is
    null or stands for another text too, a negative number from the hash."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("h", F.unhex(F.md5("text")))
    prints = materialize(rows.select("doc", "h"), "prints")
    found = prints.groupBy("h").agg(F.min("doc").alias("rep"), F.count(F.lit(1)).alias("rows"))
    named = found.withColumn("texts", F.count(F.lit(1)).over(Window.partitionBy("rep", F.when(F.col("rep").isNull(), F.col("h")))))
    own = F.col("rep").isNull() | (F.col("texts") > 1)
    hashed = -F.shiftrightunsigned(F.xxhash64("h"), 1) - 1
    classes = materialize(named.select("h", "rep", "rows", F.when(own, hashed).otherwise(F.col("rep")).alias("key"), own.alias("own")), "classes")
    copies = prints.join(small_side(classes.where("rows > 1").select("h", "rep")), "h").where(~F.col("doc").eqNullSafe(F.col("rep")))
    copies = materialize(copies.select(F.col("doc").alias("copy"), F.col("h").alias("copy_h")).distinct(), "copies")
    texts = without(rows, copies, F.col("doc").eqNullSafe(F.col("copy")) & (F.col("h") == F.col("copy_h")), F.col("doc"), F.col("copy"))
    odd = small_side(classes.where("own").select("h", "key"))
    texts = texts.join(odd, "h", "left").select(F.coalesce("key", "doc").alias("key"), "text")
    same = F.col("doc").eqNullSafe(F.col("rep"))
    repeated = prints.groupBy("h", "doc").agg(F.count(F.lit(1)).alias("n")).where("n > 1").join(classes.where("rows > 1").select("h", "rep", "key"), "h").where(same).select("key")
    repeated = materialize(repeated, "repeated")
    if not repeated.isEmpty():
        repeated = small_side(repeated)
        once = texts.join(repeated, "key", "left_semi").dropDuplicates(["key"])
        texts = texts.join(repeated, "key", "left_anti").unionByName(once)
    return Distinct(prints, classes.select("h", "key", "rows"), texts)
