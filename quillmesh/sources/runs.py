"""Run folders: manifests and artifact lists as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmesh.functions import urls

MANIFEST = "run_id long, root_source_url string, status string, started_at string, completed_at string, artifacts long"
ARTIFACT = "source_url string, raw_location string, content_type string, checksum string, content_size long"


def manifests(spark: SparkSession, root: str) -> DataFrame:
    """``manifest.json`` of all runs under ``root/<site>/<run>``, newest first. Files that can't be
    read as JSON are left out."""
    rows = spark.read.schema(f"{MANIFEST}, _corrupt_record string").option("multiLine", True).json(f"{root}/*/*/manifest.json")
    good = rows.select("*", F.col("_metadata.file_path").alias("file")).where("_corrupt_record IS NULL AND run_id IS NOT NULL")
    return good.drop("_corrupt_record").orderBy(F.desc("started_at"), "run_id")


def artifact_lists(spark: SparkSession, root: str) -> DataFrame:
    """Artifacts of all runs with the file name that the viewer shows and their category."""
    rows = spark.read.schema(ARTIFACT).option("multiLine", True).json(f"{root}/*/*/program2/artifacts.json")
    category = urls.viewed_category(F.col("content_type"), F.col("raw_location"))
    suffix = urls.viewed_extension(F.col("content_type"), F.col("raw_location"))
    return rows.select("*", category.alias("category"), urls.file_name(F.col("source_url"), F.col("checksum"), suffix).alias("file_name"))
