"""Content-addressed artifacts, upserts, manifests and data-quality checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmesh.functions import text as tx
from quillmesh.functions import urls

SHA256 = "^[0-9a-f]{64}$"


def content_type(declared, content):
    """The declared type unless it says nothing; else PDF by its magic, else octet-stream."""
    stated = F.lower(F.trim(F.split_part(F.coalesce(declared, F.lit("")), F.lit(";"), F.lit(1))))
    magic = F.when(F.substring(content, 1, 5) == F.lit(b"%PDF-"), "application/pdf").otherwise("application/octet-stream")
    return F.when(stated.isin("", "application/octet-stream"), magic).otherwise(stated)


def within_limit(captured: DataFrame, most_bytes: int) -> DataFrame:
    """Responses whose declared length (if a number) and actual length are within the limit."""
    declared = F.expr("try_cast(content_length AS bigint)")
    return captured.where((F.coalesce(declared, F.lit(0)) <= most_bytes) & (F.octet_length("content") <= most_bytes))


def first_seen(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The first row of each key: insert-if-absent. A partial aggregate, so hot keys are no matter."""
    best = F.min_by(F.struct(*rows.columns), F.struct(*order)).alias("x")
    return rows.groupBy(F.col(key).alias("__key")).agg(best).select("x.*")


def latest(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key: an upsert as a rewrite."""
    best = F.max_by(F.struct(*rows.columns), F.struct(*order)).alias("x")
    return rows.groupBy(*[F.col(k).alias(f"__{k}") for k in keys]).agg(best).select("x.*")


def upsert(existing: DataFrame, changes: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return latest(existing.unionByName(changes), keys, order)


def absent(rows: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Rows whose key isn't in the other table yet."""
    return rows.join(existing.select(key), key, "left_anti")


def is_allowed(content_type_column, allowed: list[str]):
    """Whether a resolved content type is exactly one of the allowed."""
    return F.coalesce(content_type_column.isin(*allowed), F.lit(False))


def find(rows: DataFrame, order: list[str], required: bool = False, **wanted) -> DataFrame:
    """The first row with the wanted values, or none; an error if one is ``required``."""
    for name, value in wanted.items():
        rows = rows.where(F.col(name).eqNullSafe(value))
    found = rows.orderBy(*order).limit(1)
    if required and found.isEmpty():
        raise LookupError(f"no row with {wanted}")
    return found


def content_groups(rows: DataFrame, id_col: str, content: str) -> DataFrame:
    """``sha256, first_id, copies, byte_size`` of distinct contents."""
    sized = rows.select(F.col(id_col).alias("id"), tx.sha256_text(F.col(content)).alias("sha256"), F.octet_length(F.coalesce(content, F.lit(""))).alias("size"))
    return sized.groupBy("sha256").agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("copies"), F.max("size").cast("long").alias("byte_size"))


def category_counts(artifacts: DataFrame, category) -> DataFrame:
    """Artifacts and bytes by category, and in all."""
    rows = artifacts.select(category.alias("category"), F.col("byte_size"))
    total = F.when(F.grouping("category") == 1, "ALL").otherwise(F.col("category"))
    return rows.rollup("category").agg(F.count(F.lit(1)).alias("artifacts"), F.sum("byte_size").alias("bytes"), total.alias("name")).select(F.col("name").alias("category"), "artifacts", "bytes")


def search(artifacts: DataFrame, term: str, category: str = "ALL") -> DataFrame:
    """Artifacts with the term in URL, place or checksum (any case), of one category or all."""
    hit = F.lit(False)
    for column in ("source_url", "raw_location", "checksum"):
        hit = hit | F.contains(F.lower(F.coalesce(column, F.lit(""))), F.lit(term.lower()))
    found = artifacts.where(hit)
    return found if category == "ALL" else found.where(urls.viewed_category(F.col("content_type"), F.col("raw_location")) == category)


def violations(artifacts: DataFrame, evidence: DataFrame) -> DataFrame:
    """``rule, rows``: rows that break a declared constraint. Every rule is listed."""
    rules = [
        (artifacts, "checksum is not sha-256", ~F.coalesce(F.col("checksum").rlike(SHA256), F.lit(False))),
        (artifacts, "byte size is negative", F.col("byte_size") < 0),
        (artifacts, "source url is empty", F.coalesce(F.col("source_url"), F.lit("")) == ""),
        (evidence, "claim is empty", F.coalesce(F.col("claim"), F.lit("")) == ""),
        (evidence, "value is empty", F.coalesce(F.col("value"), F.lit("")) == ""),
        (evidence, "canonical text is empty", F.coalesce(F.col("canonical_text"), F.lit("")) == ""),
    ]
    out = None
    for table in (artifacts, evidence):
        mine = [(name, rule) for t, name, rule in rules if t is table]
        counted = table.agg(*(F.count_if(rule).alias(name) for name, rule in mine))
        part = counted.unpivot([], [name for name, _ in mine], "rule", "rows")
        out = part if out is None else out.unionByName(part)
    return out
