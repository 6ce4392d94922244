"""Local files as captured artifacts, and what tables take on disk."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_files(spark: SparkSession, path: str, most_bytes: int) -> DataFrame:
    """``source_url, content, byte_size, sha256`` of files of at most ``most_bytes``; larger ones have a
    null content and an ``error_message``. Larger files aren't read."""
    files = spark.read.format("binaryFile").load(path)
    fits = F.col("length") <= most_bytes
    small = files.where(fits).select("path", "content")
    sizes = files.select(F.col("path").alias("source_url"), F.col("length").alias("byte_size"))
    error = F.format_string("file size %d exceeds the %d-byte limit", F.col("byte_size"), F.lit(most_bytes))
    rows = sizes.join(small.withColumnRenamed("path", "source_url"), "source_url", "left")
    return rows.select("source_url", "content", "byte_size", F.sha2("content", 256).alias("sha256"), F.when(F.col("byte_size") > most_bytes, error).alias("error_message"))


def table_stats(tables: dict[str, DataFrame]) -> DataFrame:
    """``table, rows, files, bytes`` of tables read from files."""
    out = None
    for name, rows in sorted(tables.items()):
        by_file = rows.groupBy("_metadata.file_path").agg(F.count(F.lit(1)).alias("n"), F.max("_metadata.file_size").alias("size"))
        one = by_file.agg(F.lit(name).alias("table"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"))
        out = one if out is None else out.unionByName(one)
    return out
