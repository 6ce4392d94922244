"""Exact cosine retrieval in both directions, and what is reported about its results."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from quillmesh.storage import materialize

#: Bytes of vectors in a block, of vectors that are sent to all tasks, and scores that a task holds.
BLOCK_BYTES, BROADCAST_BYTES, SCORES_TOGETHER = 2_000_000, 64_000_000, 1_000_000
_FOUND = "query_id long, target_id long, similarity double"


def l2_normalised(vector: Column) -> Column:
    """The vector at length 1; a zero vector stays as it is."""
    norm = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    return F.when(norm == 0, F.transform(vector, lambda x: x.cast("double"))).otherwise(F.transform(vector, lambda x: x.cast("double") / norm))


def require_dimension(vectors: DataFrame, column: str, dimension: int) -> DataFrame:
    """``vectors``, failing on the first row whose vector has another dimension."""
    wrong = F.concat(F.lit(f"expected {dimension} dimensions, got "), F.size(column))
    return vectors.withColumn(column, F.when(F.size(column) == dimension, F.col(column)).otherwise(F.raise_error(wrong)))


def require_finite(vectors: DataFrame, column: str) -> DataFrame:
    """``vectors``, failing on the first row whose vector has an element that is null, NaN or infinite."""
    odd = F.exists(column, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.withColumn(column, F.when(odd, F.raise_error(F.lit("a vector has an element that is no finite number"))).otherwise(F.col(column)))


def _unit(vectors) -> np.ndarray:
    m = np.array(list(vectors), dtype=np.float64)
    norm = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, norm, out=np.zeros_like(m), where=norm > 0)


def _nearest(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k largest of each row, ties by id, as (row, column) pairs."""
    n = scores.shape[1]
    if n > 4 * k:
        cut = np.partition(scores, n - k, axis=1)[:, n - k : n - k + 1]
    else:
        cut = np.full((len(scores), 1), -np.inf)
    rows, columns = np.nonzero(scores >= cut)
    order = np.lexsort((ids[columns], -scores[rows, columns], rows))
    rows, columns = rows[order], columns[order]
    first = np.searchsorted(rows, np.arange(len(scores)))
    keep = np.arange(len(rows)) - first[rows] < k
    return np.column_stack([rows[keep], columns[keep]])


class _Best:
    """The k most similar targets so far of each query, ties by id."""

    def __init__(self, queries: np.ndarray, k: int):
        self.queries, self.k = queries, k
        self.scores, self.targets = np.full((len(queries), k), -np.inf), np.zeros((len(queries), k), np.int64)

    def add(self, part: slice, vectors: np.ndarray, targets: np.ndarray, matrix: np.ndarray) -> None:
        """Compare a part of the queries with targets."""
        scores = np.round(vectors @ matrix.T, 9)
        scores[self.queries[part, None] == targets] = -np.inf
        rows = np.flatnonzero(scores.max(axis=1) >= self.scores[part, -1])
        found = _nearest(scores[rows], targets, self.k)
        place = np.arange(len(found)) - np.searchsorted(found[:, 0], found[:, 0])
        more, ids = np.full((len(rows), self.k), -np.inf), np.zeros((len(rows), self.k), np.int64)
        more[found[:, 0], place], ids[found[:, 0], place] = scores[rows[found[:, 0]], found[:, 1]], targets[found[:, 1]]
        rows += part.start
        more, ids = np.hstack([self.scores[rows], more]), np.hstack([self.targets[rows], ids])
        order = np.lexsort((ids, -more), axis=-1)[:, : self.k]
        self.scores[rows], self.targets[rows] = np.take_along_axis(more, order, 1), np.take_along_axis(ids, order, 1)

    def rows(self) -> Iterator[pd.DataFrame]:
        step = max(1, 100_000 // self.k)
        for at in range(0, len(self.queries), step):
            row, column = np.nonzero(np.isfinite(self.scores[at : at + step]))
            row += at
            yield pd.DataFrame({"query_id": self.queries[row], "target_id": self.targets[row, column], "similarity": self.scores[row, column]})


def _compare(best: _Best, vectors: np.ndarray, targets: np.ndarray, matrix: np.ndarray, few: str) -> None:
    """Compare all queries with all targets, the ``few`` in parts that keep to SCORES_TOGETHER."""
    if few == "queries":
        step = max(1, SCORES_TOGETHER // len(targets))
        for at in range(0, len(vectors), step):
            best.add(slice(at, at + step), vectors[at : at + step], targets, matrix)
    else:
        step = max(1, SCORES_TOGETHER // len(vectors))
        for at in range(0, len(targets), step):
            best.add(slice(0, None), vectors, targets[at : at + step], matrix[at : at + step])


def _packed(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``ids, data``: unit vectors in blocks of at most BLOCK_BYTES, as matrices of doubles."""

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, parts, size = [], [], 0

        def block() -> pd.DataFrame:
            return pd.DataFrame({"ids": [np.concatenate(ids).tobytes()], "data": [np.concatenate(parts).tobytes()]})

        for pdf in frames:
            if not len(pdf):
                continue
            own, matrix = pdf[id_col].to_numpy(np.int64), _unit(pdf[vector_col])
            step = max(1, BLOCK_BYTES // max(1, matrix.shape[1] * 8))
            for at in range(0, len(own), step):
                more = matrix[at : at + step]
                if size and size + more.nbytes > BLOCK_BYTES:
                    yield block()
                    ids, parts, size = [], [], 0
                ids.append(own[at : at + step])
                parts.append(more)
                size += more.nbytes
        if size:
            yield block()

    return vectors.mapInPandas(pack, "ids binary, data binary")


def _search_sent(frames: Iterator[pd.DataFrame], sent, id_col: str, vector_col: str, k: int, few: str) -> Iterator[pd.DataFrame]:
    ids, matrix = sent.value
    best = _Best(ids, k)
    for pdf in frames:
        if not len(pdf) or not len(ids):
            continue
        own, vectors = pdf[id_col].to_numpy(np.int64), _unit(pdf[vector_col])
        if few == "queries":
            _compare(best, matrix, own, vectors, few)
        else:
            found = _Best(own, k)
            _compare(found, vectors, ids, matrix, few)
            yield from found.rows()
    if few == "queries":
        yield from best.rows()


def _search_blocks(frames: Iterator[pd.DataFrame], k: int, few: str) -> Iterator[pd.DataFrame]:
    for pdf in frames:
        for large_ids, large_data, small_ids, small_data in zip(pdf["ids"], pdf["data"], pdf["small_ids"], pdf["small_data"]):
            ids, own = np.frombuffer(small_ids, np.int64), np.frombuffer(large_ids, np.int64)
            matrix, vectors = np.frombuffer(small_data).reshape(len(ids), -1), np.frombuffer(large_data).reshape(len(own), -1)
            q, query_vectors, t, target_vectors = (ids, matrix, own, vectors) if few == "queries" else (own, vectors, ids, matrix)
            best = _Best(q, k)
            _compare(best, query_vectors, t, target_vectors, few)
            yield from best.rows()


def top_k(queries: DataFrame, targets: DataFrame, k: int, id_col: str = "vec_id", vector_col: str = "embedding", few: str = "queries") -> DataFrame:
    """``query_id, rank, target_id, similarity``: for each query its k most similar other targets.

    Cosine in double precision, ranked by the similarity at 9 decimals and then the id; zero vectors
    have similarity 0. Both sides become blocks of bounded size, and every pair of blocks is one matrix
    product in a task. ``few`` names the smaller side: if it is within ``BROADCAST_BYTES`` it is sent
    to all tasks, which read the larger side in small batches and keep k rows a query; else blocks meet
    blocks on the executors, and k rows a query and pair of blocks are shuffled. Null vectors and ids take no part. Vectors of uneven dimensions are an
    error, and so are elements that are null, NaN or infinite.
    """
    usable = f"{id_col} IS NOT NULL AND {vector_col} IS NOT NULL"
    queries, targets = queries.where(usable).select(id_col, vector_col), targets.where(usable).select(id_col, vector_col)
    small, large = (queries, targets) if few == "queries" else (targets, queries)
    elements, least, most = small.agg(F.coalesce(F.sum(F.size(vector_col).cast("long")), F.lit(0)), F.min(F.size(vector_col)), F.max(F.size(vector_col))).first()
    size = elements * 8
    if least != most:
        raise ValueError(f"vectors of {least} to {most} dimensions")
    if most is not None:
        small, large = (require_finite(require_dimension(x, vector_col, most), vector_col) for x in (small, large))
    blocks = _packed(small.coalesce(max(1, size // BLOCK_BYTES)), id_col, vector_col)
    if size <= BROADCAST_BYTES:
        parts = blocks.collect()
        ids = np.concatenate([np.empty(0, np.int64), *(np.frombuffer(p["ids"], np.int64) for p in parts)])
        matrix = np.concatenate([np.empty(0), *(np.frombuffer(p["data"]) for p in parts)]).reshape(len(ids), most or 0)
        sent = queries.sparkSession.sparkContext.broadcast((ids, matrix))
        found = large.mapInPandas(lambda frames: _search_sent(frames, sent, id_col, vector_col, k, few), _FOUND)
    else:  # each pair of blocks meets once; blocks are packed once
        blocks = materialize(blocks.select(F.col("ids").alias("small_ids"), F.col("data").alias("small_data")), "small-blocks")
        found = materialize(_packed(large, id_col, vector_col), "large-blocks").crossJoin(blocks).mapInPandas(lambda frames: _search_blocks(frames, k, few), _FOUND)

    order = Window.partitionBy("query_id").orderBy(F.desc("similarity"), "target_id")
    ranked = found.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "target_id", F.round("similarity", 6).alias("similarity"))


def timed(ranked: DataFrame, action: Callable[[DataFrame], None]) -> dict[str, float]:
    """Run ``action`` (such as writing) on ranked hits and return ``queries, rows, seconds,
    ms_per_query``. Queries and rows are counted in the same pass, so nothing runs twice."""
    seen, began = Observation("retrieval"), time.perf_counter()
    action(ranked.observe(seen, F.count_if(F.col("rank") == 1).alias("queries"), F.count(F.lit(1)).alias("rows")))
    seconds = time.perf_counter() - began
    found = seen.get
    return {**found, "seconds": seconds, "ms_per_query": 1000 * seconds / found["queries"] if found["queries"] else None}


def hit_frequency(ranked: DataFrame, types: DataFrame, most: int = 10) -> DataFrame:
    """``evidence_type, target_id, hits, place``: the targets hit most by each type of query."""
    counted = ranked.join(types, "query_id").groupBy("evidence_type", "target_id").agg(F.count(F.lit(1)).alias("hits"))
    place = F.row_number().over(Window.partitionBy("evidence_type").orderBy(F.desc("hits"), "target_id")).cast("long")
    return counted.withColumn("place", place).where(F.col("place") <= most)


def type_share(ranked: DataFrame, types: DataFrame) -> DataFrame:
    """``evidence_type, hits, share_pct``: what types of target the results have."""
    counted = ranked.join(types, "target_id").groupBy("evidence_type").agg(F.count(F.lit(1)).alias("hits"))
    total = counted.agg(F.sum("hits").alias("total"))
    return counted.join(F.broadcast(total)).select("evidence_type", "hits", F.round(100 * F.col("hits") / F.col("total"), 4).alias("share_pct"))


def duplicate_rate(rows: DataFrame, text: str = "text") -> DataFrame:
    """One row: rows, distinct texts, rows in groups of several, rows beyond the first of a group."""
    groups = rows.groupBy(F.sha2(text, 256).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    total, kinds = F.sum("n"), F.count(F.lit(1))
    return groups.agg(
        total.alias("n_rows"),
        kinds.alias("n_distinct"),
        F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)).alias("rows_in_groups"),
        (total - kinds).alias("extra_rows"),
        F.round((total - kinds) / total, 6).alias("extra_rate"),
    )


def duplicate_leaderboard(rows: DataFrame, id_col: str = "doc_id", text: str = "text", most: int = 20) -> DataFrame:
    """The texts repeated most, named by their first id."""
    groups = rows.groupBy(F.sha2(text, 256).alias("text_sha256")).agg(F.count(F.lit(1)).alias("n"), F.min(id_col).alias("first_id"))
    return groups.where("n > 1").orderBy(F.desc("n"), "first_id").limit(most)


def embed(rows: DataFrame, embedder, dimension: int, id_col: str = "evidence_id", text_col: str = "text", batch: int = 64) -> DataFrame:
    """``id, embedding, embedded_text_checksum``: unit vectors of texts by an injected function from a
    list of texts to a list of vectors, called with at most ``batch`` texts in the rows' order.

    A wrong number of vectors or a wrong dimension is an error. Equal texts are embedded once.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for at in range(0, len(pdf), batch):
                part = pdf.iloc[at : at + batch]
                vectors = embedder(list(part["text"]))
                if len(vectors) != len(part) or any(len(v) != dimension for v in vectors):
                    raise ValueError(f"expected {len(part)} vectors of {dimension} dimensions")
                yield pd.DataFrame({"checksum": part["checksum"], "embedding": [v.tolist() for v in _unit(vectors)]})

    keyed = rows.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.sha2(text_col, 256).alias("checksum"))
    texts = keyed.groupBy("checksum").agg(F.min("text").alias("text"))
    vectors = texts.mapInPandas(run, "checksum string, embedding array<double>")
    return keyed.drop("text").join(vectors, "checksum").select(F.col("id").alias(id_col), "embedding", F.col("checksum").alias("embedded_text_checksum"))
