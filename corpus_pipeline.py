"""The corpus pipeline: documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept; all but the
last return rows of ``docs`` with their columns unchanged. Rows are told apart by id and text, so
null ids are no obstacle; extra columns go along. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmesh.llm.decontaminate import contaminated
from quillmesh.llm.exact_dedup import exact_duplicates
from quillmesh.llm.packing import pack_documents
from quillmesh.llm.quality import quality
from quillmesh.llm.sketch_join import near_duplicates
from quillmesh.session import ship_package
from quillmesh.storage import clearing, materialize, new_path, remove, shuffles_removed, small_side, without

#: Word shingles and similarity (a percentage) of near duplicates.
SHINGLE_WORDS, SIMILARITY = 5, 80


def _without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """``docs`` without the rows whose id and text hash are in ``dropped`` (doc_id, text_hash)."""
    gone = materialize(dropped.select(F.col("doc_id").alias("__dropped_id"), F.col("text_hash").alias("__dropped_hash")).distinct(), "dropped")
    same = F.col("doc_id").eqNullSafe(F.col("__dropped_id")) & (F.unhex(F.md5(F.coalesce("text", F.lit("")))) == F.col("__dropped_hash"))
    return without(docs, gone, same, F.col("doc_id"), F.col("__dropped_id"))


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents whose perplexity the classifier rejects go, as do those without a word."""
    verdicts = quality(docs, ship_package(spark).read.parquet(f"{sf_dir}/labels.parquet"))
    return _without(docs, verdicts.where("NOT keep"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: of equal texts the largest id stays, and of rows with the same id and text one."""
    found = materialize(exact_duplicates(docs).select(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__sha"), "kept"), "copies")
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.sha2(F.coalesce("text", F.lit("")), 256) == F.col("__sha"))
    gone = materialize(found.where("NOT kept").drop("kept").distinct(), "dropped")
    left = without(docs, gone, same, F.col("doc_id"), F.col("__id"))
    repeated = materialize(found.where("kept").groupBy("__id", "__sha").count().where("count > 1").drop("count"), "repeated")
    if repeated.isEmpty():
        return left
    repeated = small_side(repeated)
    return left.join(repeated, same, "left_anti").unionByName(left.join(repeated, same, "left_semi").dropDuplicates(["doc_id", "text"]))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: of each component of near duplicates the smallest id stays, with the smallest text
    hash if that id has several texts there. Rows without an id go where a linked row has one."""
    found = near_duplicates(docs, k=SHINGLE_WORDS, num=SIMILARITY, den=100).where("n_shingles > 0 AND component_id IS NOT NULL")
    found = materialize(found.select("doc_id", "component_id", F.col("text_hash").alias("lowered_hash")), "near")
    several = F.col("doc_id").isNull() | (F.col("doc_id") != F.col("component_id"))
    twice = found.where("doc_id = component_id").groupBy("doc_id").agg(F.min("lowered_hash").alias("first"), F.max("lowered_hash").alias("last")).where("first <> last")
    twice = found.where("doc_id = component_id").join(twice.select("doc_id", "first"), "doc_id").where("lowered_hash <> first")
    dropped = found.where(several).select("doc_id", "lowered_hash").unionByName(twice.select("doc_id", "lowered_hash")).distinct()
    gone = materialize(dropped.select(F.col("doc_id").alias("__dropped_id"), F.col("lowered_hash").alias("__dropped_hash")), "dropped")
    lowered = F.translate(F.coalesce("text", F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    same = F.col("doc_id").eqNullSafe(F.col("__dropped_id")) & (F.unhex(F.md5(lowered)) == F.col("__dropped_hash"))
    return without(docs, gone, same, F.col("doc_id"), F.col("__dropped_id"))


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents with a passage of the benchmark go."""
    found = contaminated(docs, ship_package(spark).read.parquet(f"{sf_dir}/benchmark.parquet"))
    return _without(docs, found)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: the pieces of all documents and their places in sequences."""
    ship_package(spark)
    return pack_documents(docs)


STAGES = [
    ("quality classifier", keep_quality),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_benchmark),
    ("packing", pack),
]

#: SQL can't express the model, the tokenizer or the components.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of a folder of tables. What a stage wrote for itself is removed when
    its result is written, and that when the next stage's is; the last two results stay."""
    docs = ship_package(spark).read.parquet(f"{sf_dir}/documents.parquet")
    spent = None
    for name, stage in STAGES[:-1]:
        path = new_path(spark, name.replace(" ", "-"))
        with clearing(spark), shuffles_removed(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if spent is not None:
            remove(spark, spent)
        docs, spent = spark.read.schema(docs.schema).parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
