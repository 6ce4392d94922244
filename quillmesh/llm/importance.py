"""Importance resampling towards a target distribution (operator 12).

Hashed n-gram features of documents and of the target give log ratios (gains); a document's weight
is the sum of its features' gains, and adding Gumbel noise to it makes the highest scores a sample
without replacement in proportion to the importance weights.

Terms come from Arrow kernels. Words are dictionary indices; an n-gram is a pair of an (n-1)-gram's
index and the index shifted by n-1; CRCs are computed once for each different pair of a slice.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillmesh.llm.terms import slices, split_terms
from quillmesh.llm.words import freeing
from quillmesh.storage import materialize

#: What lies between words, after A-Z are lower-cased: ASCII other than digits and letters.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS = 10_000
MOST_WORDS = 1
LEAST_WORDS, PERCENT, SEED = 20, 10, 2024


def features(texts: pa.Array, most: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row and bucket of every n-gram of 1 to ``most`` words, and the number of words of each row."""
    row, index, words = split_terms(texts, SEPARATORS)
    plain = [w.encode("utf-8", "surrogatepass") for w in words.to_pylist()]
    crcs = np.array([zlib.crc32(w) for w in plain], np.int64)
    grams, found = index, [(row, crcs[index] % buckets)]
    for n in range(2, most + 1):
        inside = row[n - 1 :] == row[: max(len(row) - n + 1, 0)]
        # the pair of the gram that starts here and the word n - 1 places on
        pairs = grams[: len(inside)][inside] * len(plain) + index[n - 1 :][inside]
        different, code = np.unique(pairs, return_inverse=True)
        pair_crcs = [zlib.crc32(b" " + plain[w], c) for c, w in zip(crcs[different // max(len(plain), 1)].tolist(), (different % max(len(plain), 1)).tolist())]
        crcs = np.array(pair_crcs, np.int64)
        # grams stay aligned with the places where they start; places too near a row's end have none
        grams = np.zeros(len(inside), np.int64)
        grams[inside] = code
        found.append((row[: len(inside)][inside], crcs[code] % buckets))
    rows, kinds = (np.concatenate(x) for x in zip(*found))
    return rows, kinds, np.bincount(row, minlength=len(texts))


@freeing
def _bucket_counts(batches: Iterator[pa.RecordBatch], most: int, buckets: int) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(buckets, np.int64)
    for part in slices(batches, 0):
        counts += np.bincount(features(part.column(0), most, buckets)[1], minlength=buckets)
    used = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(counts[used])], ["bucket", "c"])


def bucket_counts(texts: DataFrame, most: int, buckets: int) -> np.ndarray:
    """Features in each bucket over all texts (a table of one column)."""
    counted = texts.mapInArrow(lambda x: _bucket_counts(x, most, buckets), "bucket int, c long").groupBy("bucket").agg(F.sum("c").alias("c"))
    out = np.zeros(buckets, np.int64)
    for r in counted.collect():  # no more rows than buckets
        out[r["bucket"]] = r["c"]
    return out


def bucket_gains(documents: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of the smoothed target share over the smoothed share of documents) of each bucket."""
    s, t, n = documents.astype(float), target.astype(float), float(len(documents))
    return np.floor(1000 * np.log((t + 1) * (s.sum() + n) / ((s + 1) * (t.sum() + n)))).astype(np.int64)


@freeing
def _weights(batches: Iterator[pa.RecordBatch], most: int, sent) -> Iterator[pa.RecordBatch]:
    gains = sent.value
    for part in slices(batches, 1):
        row, bucket, words = features(part.column(1), most, len(gains))
        count = np.bincount(row, minlength=part.num_rows)
        # whole numbers far below 2**53, so that sums of doubles are exact
        weight = np.bincount(row, gains.take(bucket).astype(float), part.num_rows).astype(np.int64)
        yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(words), pa.array(count), pa.array(weight)], ["doc_id", "carried", "words", "n_features", "weight"])


def gumbel(doc_id: Column, seed: int) -> Column:
    """floor(1000 times a Gumbel variate), from the first 32 bits of sha256("seed:id"); a null id counts as an empty text."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def importance_resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_col: str = "text",
    carry: Sequence[str] = (),
    most_words: int = MOST_WORDS,
    buckets: int = BUCKETS,
    least_words: int = LEAST_WORDS,
    percent: int = PERCENT,
    seed: int = SEED,
) -> DataFrame:
    """One row per input row: ``doc_id, n_features, weight, score, rank``, then the columns ``carry``
    of ``docs``. Drawn are the rows with a rank, 1 to floor(percent * N / 100) of the N rows with
    ``least_words`` words.

    * Words are runs of digits, letters and non-ASCII signs, A-Z lower-cased; null has none.
    * Ties of scores go to the smaller id, null last; then to fewer features, the smaller weight, and
      any of the (then equal) rows. Repeated rows are drawn one by one.
    * A null id has the noise of an empty id. An empty target, or no document, gives gains by smoothing alone.
    * An empty table gives an empty result.
    """
    spark = docs.sparkSession
    kept = F.struct(*[F.col(c) for c in carry]) if carry else F.struct(F.lit(None).cast("int").alias("none"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), kept.alias("carried"))
    gains = bucket_gains(bucket_counts(rows.select("text"), most_words, buckets), bucket_counts(target.select(F.col(target_col).alias("text")), most_words, buckets))
    sent = spark.sparkContext.broadcast(gains)  # as long as there are buckets
    kind = rows.schema["carried"].dataType.simpleString()
    weighed = rows.mapInArrow(lambda x: _weights(x, most_words, sent), f"doc_id long, carried {kind}, words long, n_features long, weight long")
    weighed = weighed.withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed)).withColumn("place", F.monotonically_increasing_id())
    scored = materialize(weighed, "scored")  # places are those that were written

    enough = F.col("words") >= least_words
    drawn = scored.where(enough).count() * percent // 100
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features"), F.asc("weight"), F.asc("place")]
    ranged = materialize(scored.where(enough).repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "ranged")
    # one row a range
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    at = F.col("before") + F.row_number().over(Window.partitionBy("part").orderBy(*order))
    ranked = ranged.join(F.broadcast(starts), "part").withColumn("rank", at).withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")).cast("long"))
    columns = ["doc_id", "n_features", "weight", "score", "rank", *[F.col(f"carried.`{c}`").alias(c) for c in carry]]
    return ranked.select(columns).union(scored.where(~enough).withColumn("rank", F.lit(None).cast("long")).select(columns))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_resample(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


ORACLE = {
    "op12_importance_resampling": r"""
        WITH steps AS (SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t FROM range(256) r(i)),
        d AS (SELECT row_number() OVER () AS row_no, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
        b AS (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark),
        dw AS (SELECT row_no, unnest(words) AS w FROM d),
        kinds AS (SELECT w, hex(encode(w)) AS x FROM (SELECT w FROM dw UNION SELECT w FROM b)),
        bytes AS (SELECT w, list_transform(range(length(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT) AS v FROM kinds),
        bucketed AS (SELECT w, xor(list_reduce(list_prepend(4294967295, v), lambda c, y: xor(c >> 8, t[(xor(c, y) & 255) + 1])), 4294967295) % 10000 AS bucket FROM bytes, steps),
        s AS (SELECT bucket, count(*) AS s FROM dw JOIN bucketed USING (w) GROUP BY bucket),
        t AS (SELECT bucket, count(*) AS t FROM b JOIN bucketed USING (w) GROUP BY bucket),
        n AS (SELECT (SELECT count(*) FROM dw) AS s_all, (SELECT count(*) FROM b) AS t_all),
        gains AS (SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (s_all + 10000)::DOUBLE / ((coalesce(s, 0) + 1)::DOUBLE * (t_all + 10000)::DOUBLE)))::BIGINT AS gain FROM s FULL JOIN t USING (bucket), n),
        weights AS (SELECT row_no, sum(gain)::BIGINT AS weight FROM dw JOIN bucketed USING (w) JOIN gains USING (bucket) GROUP BY row_no),
        scored AS (SELECT doc_id, len(words)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
            coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score FROM d LEFT JOIN weights USING (row_no)),
        ranked AS (SELECT *, CASE WHEN n_features >= 20 THEN row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST, n_features, weight) END AS place FROM scored)
        SELECT doc_id, n_features, weight, score, CASE WHEN place <= (SELECT count(*) * 10 // 100 FROM scored WHERE n_features >= 20) THEN place END AS rank FROM ranked
    """
}
QUERIES = {"op12_importance_resampling": op12_importance_resampling}
