"""N-gram Jaccard self-join by parity sketches (operator 4).

Sets of near sizes share a size band. A band's sketch has more blocks than two linked sets can
differ in elements, and the elements of a set fall into blocks by hash; a block holds the XOR of its
elements' hashes, so that each element in only one of two sets changes one block at most. Linked
sets therefore agree in a block, which is what they are joined on. Candidates are hung on the
smallest id of each block value, tested by a 1024-bit parity sketch (its Hamming distance is a lower
bound of the symmetric difference) and then exactly. Where a block value still holds several
components, pairs between components are tested, in blocks of bounded size: in each round the
nearest few of each component, in the last all of them.

Block values are the bulk of what is moved. They go from the texts to their buckets by one shuffle,
cut to 32 bits beside the bucket's number (values that agree by chance make candidates, no links),
and only those that meet are written. Candidates meet as texts, which are smaller than their sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmesh.llm.links import components
from quillmesh.llm.texts import distinct_texts
from quillmesh.llm.words import ascii_words, freeing, mix, shingles, sorted_groups, word_hashes
from quillmesh.storage import BROADCAST_ROWS, materialize, sifted, small_side

BAND_RATIO = 1.4
#: A set with too many empty blocks also uses the next of these hash functions.
SEEDS = 4
SKETCH_BITS = 1024
#: Keys that a task holds before it sends them on.
HELD_KEYS = 500_000
#: Text whose block values meet in one bucket.
BYTES_PER_BUCKET = 4_000_000
#: Members of a block value that are compared with as many others in one task.
GROUP_BLOCK = 512
#: Pairs per component and block value that the rounds test; None: all.
NEAREST = (4, None)
#: About so many texts are compared with one that is sent to their task.
TEXTS_A_PART = 1000

#: Packed block values and their ids; where a task holds a value several times, with ``hubs``; or sizes and sketches.
EMITTED = "bucket int, keys binary, docs binary, hubs binary, doc long, n long, sketch array<long>"
MET = "key long, doc long, hub long, n long, sketch array<long>"
_KINDS = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}


def _batch(schema: str, **columns) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    fields = [x.split() for x in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(columns[c], _KINDS[k]) if c in columns else pa.nulls(n, _KINDS[k]) for c, k in fields], [c for c, _ in fields])


def packed(x: np.ndarray) -> bytes:
    """Numbers as their first bytes, their second bytes, ...: high bytes that repeat then compress well."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes()


def unpacked(data: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind).ravel()


def _steps(x: np.ndarray) -> np.ndarray:
    return np.diff(x, prepend=np.int64(0))


class Bands:
    """Size bands and their blocks for Jaccard of at least ``num / den``."""

    def __init__(self, num: int, den: int):
        if not 0 < num < den:
            raise ValueError("the threshold must lie between 0 and 1")
        self.num, self.den = num, den
        self.starts, self.blocks, self.spare = [1], [], []
        self._reach(1)

    def differ(self, size: int) -> int:
        """Elements by which a set of this size can differ from a linked one at least as large."""
        return size * (self.den - self.num) // self.num

    def _reach(self, size: int) -> None:
        while self.starts[-1] <= size:
            start, unit = self.starts[-1], -(-self.num // (self.den - self.num))
            end = unit * max(start // unit + 1, math.ceil(start * BAND_RATIO / unit) if start > 1 else 1)
            blocks = self.differ(end - 1) + 1
            empty = blocks * math.exp(-start / blocks)
            spare = int(empty + 2.5 * math.sqrt(empty)) if blocks > 8 else 0
            self.starts.append(end)
            self.blocks.append(blocks + spare)
            self.spare.append(spare)

    def of(self, size: int) -> list[int]:
        """The bands in which a set of this size can be the smaller or the larger of two."""
        self._reach(size)
        top = int(np.searchsorted(self.starts, size, "right")) - 1
        return [b for b in range(top, -1, -1) if b == top or size * self.num <= (self.starts[b + 1] - 1) * self.den]


def block_keys(items: np.ndarray, bands: Bands) -> np.ndarray:
    """The block values of a set in all its bands.

    Any two linked sets have one in common: at the first seed that leaves either with at most the
    spare number of empty blocks, its other blocks outnumber the elements in which the two differ.
    The last seed also sends empty blocks.
    """
    out = []
    for band in bands.of(len(items)):
        m, spare = bands.blocks[band], bands.spare[band]
        for seed in range(SEEDS):
            salt = np.uint64((band * SEEDS + seed + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1))
            x = mix(items ^ salt)
            block = ((x >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)
            order = np.argsort(block, kind="stable")
            block = block[order]
            first = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
            parity = np.bitwise_xor.reduceat(x[order], first)
            filled = block[first]
            out.append(mix(parity ^ mix(filled + salt)))
            if m - len(filled) <= spare:
                break
            if seed == SEEDS - 1:
                out.append(mix(mix(np.setdiff1d(np.arange(m, dtype=np.uint64), filled) + salt)))
    return np.concatenate(out)


def parity_sketch(items: np.ndarray) -> np.ndarray:
    bits = np.bincount((items & np.uint64(SKETCH_BITS - 1)).astype(np.int64), minlength=SKETCH_BITS) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


@freeing
def _emit(batches: Iterator[pa.RecordBatch], k: int, bands: Bands, buckets: int) -> Iterator[pa.RecordBatch]:
    """Sizes and sketches of all sets; block values by bucket, each once from this task with its
    smallest id; and the task's own members of values that it holds more than once. The last and the
    sizes only pass through a bucket, any one."""
    keys, docs, held = [], [], 0

    def flush() -> Iterator[pa.RecordBatch]:
        key, doc = np.concatenate(keys), np.concatenate(docs)
        key = ((key >> np.uint64(40)) % np.uint64(buckets)).view(np.int64) << 32 | (key & np.uint64(0xFFFFFFFF)).view(np.int64)
        order = np.lexsort((doc, key))
        key, doc = key[order], doc[order]
        first = np.concatenate([[True], key[1:] != key[:-1]])
        hub = doc[np.flatnonzero(first)][np.cumsum(first) - 1]
        more = np.flatnonzero(~first & (doc != hub))
        for part in range(0, len(more), 20_000):
            own = more[part : part + 20_000]
            yield _batch(EMITTED, bucket=[int(mix(doc[own[:1]].view(np.uint64))[0]) % buckets], keys=[packed(key[own])], docs=[packed(doc[own])], hubs=[packed(hub[own])])
        key, doc = key[first], doc[first]
        order = np.lexsort((doc, key >> 32))
        key, doc = key[order], doc[order]
        bucket = key >> 32
        edge = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]]))
        yield _batch(
            EMITTED,
            bucket=bucket[edge[:-1]].astype(np.int32),
            keys=[packed(key[a:b].astype(np.uint32)) for a, b in zip(edge, edge[1:])],
            docs=[packed(_steps(doc[a:b])) for a, b in zip(edge, edge[1:])],
        )

    for batch in batches:
        ids, sizes, sketches = [], [], []
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            items = shingles(word_hashes(ascii_words(text.as_py())), k)
            ids.append(doc)
            sizes.append(len(items))
            sketches.append(parity_sketch(items))
            if len(items):
                found = block_keys(items, bands)
                keys.append(found)
                docs.append(np.full(len(found), doc, np.int64))
                held += len(found)
                if held >= HELD_KEYS:
                    yield from flush()
                    keys, docs, held = [], [], 0
        if ids:
            spread = (mix(np.array(ids, np.int64).view(np.uint64)) % np.uint64(buckets)).astype(np.int32)
            yield _batch(EMITTED, bucket=spread, doc=ids, n=sizes, sketch=[s.tolist() for s in sketches])
    if held:
        yield from flush()


@freeing
def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members of the block values that several tasks sent, hung on the smallest id; and what passes through."""
    for group in sorted_groups(batches, "bucket"):
        sizes = group.filter(pc.is_valid(group["n"]))
        if sizes.num_rows:
            yield from sizes.append_column("key", pa.nulls(sizes.num_rows, pa.int64())).append_column("hub", pa.nulls(sizes.num_rows, pa.int64())).select(["key", "doc", "hub", "n", "sketch"]).combine_chunks().to_batches()
        several = pc.is_valid(group["hubs"])
        for row in group.filter(several).select(["keys", "docs", "hubs"]).to_pylist():
            yield _batch(MET, key=unpacked(row["keys"], np.int64), doc=unpacked(row["docs"], np.int64), hub=unpacked(row["hubs"], np.int64))
        sent = group.filter(pc.and_(pc.is_valid(group["keys"]), pc.invert(several)))
        if not sent.num_rows:
            continue
        bucket = np.int64(sent["bucket"][0].as_py())
        key = np.concatenate([unpacked(x, np.uint32) for x in sent["keys"].to_pylist()])
        doc = np.concatenate([np.cumsum(unpacked(x, np.int64)) for x in sent["docs"].to_pylist()])
        order = np.lexsort((doc, key))
        key, doc = key[order], doc[order]
        first = np.concatenate([[True], key[1:] != key[:-1]])
        hub = doc[np.flatnonzero(first)][np.cumsum(first) - 1]
        more = doc != hub
        yield _batch(MET, key=bucket << 32 | key[more].astype(np.int64), doc=doc[more], hub=hub[more])


@freeing
def _compared(batches: Iterator[pa.RecordBatch], k: int, num: int, den: int) -> Iterator[pa.RecordBatch]:
    """Links of rows (a, chunk, b, text) in that order: of the texts of one ``a`` and chunk its own
    comes first, with no ``b``, and the others' are compared with it."""
    own = np.empty(0, np.uint64)
    for batch in batches:
        found = []
        for a, b, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3)):
            items = shingles(word_hashes(ascii_words(text.as_py())), k)
            if b is None:
                own = items
                continue
            both = len(np.intersect1d(own, items, assume_unique=True))
            if both * den >= (len(own) + len(items) - both) * num:
                found.append((a, b))
        yield _batch("a long, b long", a=[a for a, _ in found], b=[b for _, b in found])


def _near(na: Column, nb: Column, num: int, den: int) -> Column:
    return (na * den >= nb * num) & (nb * den >= na * num)


def _hamming(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)


def _close(pairs: DataFrame, meta: DataFrame, num: int, den: int) -> DataFrame:
    """``a, b, apart``: the pairs (a, b) that sizes and sketches don't exclude."""
    left = meta.select(F.col("doc").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
    right = meta.select(F.col("doc").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))
    sized = pairs.join(left, "a").join(right, "b").where(_near(F.col("na"), F.col("nb"), num, den)).withColumn("apart", _hamming(F.col("sa"), F.col("sb")))
    close = sized.where(F.col("apart") * (den + num) <= (F.col("na") + F.col("nb")) * (den - num))
    return materialize(close.select("a", "b", "apart"), "close")


def _linked(close: DataFrame, texts: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """The pairs of ``close`` (a, b; materialised) whose whole sets link. Each ``a`` is sent to the texts
    that are compared with it, once for about ``TEXTS_A_PART`` of them."""
    chunks = close.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / TEXTS_A_PART).cast("int").alias("chunks"))
    dealt = materialize(close.select("a", "b").join(chunks, "a").select("a", "b", F.pmod(F.xxhash64("b", "a"), "chunks").cast("int").alias("chunk")), "dealt")
    own = dealt.select(F.col("a").alias("doc"), "a", "chunk", F.lit(None).cast("long").alias("b")).distinct()
    wanted = materialize(own.unionByName(dealt.select(F.col("b").alias("doc"), "a", "chunk", "b")), "wanted")
    if wanted.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)
    else:
        texts, _ = sifted(texts, F.col("doc"), wanted.select("doc").distinct(), F.col("doc"))
    rows = texts.join(wanted, "doc").select("a", "chunk", "b", "text")
    rows = rows.repartition("a", "chunk").sortWithinPartitions("a", "chunk", F.col("b").asc_nulls_first())
    return materialize(rows.mapInArrow(lambda x: _compared(x, k, num, den), "a long, b long"), "links")


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs whose ends are not yet in one component."""
    named = pairs
    for end in ("a", "b"):
        label = labels.select(F.col("doc").alias(end), F.col("component").alias(f"of_{end}"))
        named = named.join(label, end, "left").withColumn(f"of_{end}", F.coalesce(f"of_{end}", end))
    return named.where("of_a <> of_b").drop("of_a", "of_b")


def _nth(label: np.ndarray) -> np.ndarray:
    """How many equal elements come before each."""
    order = np.argsort(label, kind="stable")
    first = np.concatenate([[True], label[order][1:] != label[order][:-1]])
    out = np.empty(len(label), np.int64)
    at = np.arange(len(label))
    out[order] = at - np.maximum.accumulate(np.where(first, at, 0))
    return out


@freeing
def _between(batches: Iterator[pa.RecordBatch], num: int, den: int, nearest: int | None) -> Iterator[pa.RecordBatch]:
    """Pairs of one block value that lie in different components and that size and sketch admit:
    the nearest ones of each component, or all."""
    for group in sorted_groups(batches, "part"):
        side = group.column("side").to_numpy()
        doc, label, n = (group.column(c).to_numpy() for c in ("doc", "label", "n"))
        # bitwise_count takes signed numbers by their absolute value
        sketch = np.array(group.column("sketch").to_pylist(), np.int64).view(np.uint64)
        low = np.flatnonzero(side != 1)
        high = np.flatnonzero(side != 0)
        apart = np.zeros((len(low), len(high)), np.int32)
        for w in range(sketch.shape[1]):
            apart += np.bitwise_count(sketch[low, w][:, None] ^ sketch[high, w][None, :])
        na, nb = n[low][:, None], n[high][None, :]
        good = (apart * (den + num) <= (na + nb) * (den - num)) & (label[low][:, None] != label[high][None, :]) & (na * den >= nb * num) & (nb * den >= na * num)
        i, j = np.nonzero(good)
        if nearest and len(i):
            order = np.argsort(apart[i, j], kind="stable")
            i, j = i[order], j[order]
            once = _nth(label[low[i]] * np.int64(1_000_003) ^ label[high[j]]) == 0
            i, j = i[once], j[once]
            chosen = np.minimum(_nth(label[low[i]]), _nth(label[high[j]])) < nearest
            i, j = i[chosen], j[chosen]
        a, b = doc[low[i]], doc[high[j]]
        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])


def _leftover_pairs(hung: DataFrame, pairs: DataFrame, labels: DataFrame, meta: DataFrame, num: int, den: int, nearest: int | None) -> DataFrame:
    """Pairs between components that still share a block value. ``pairs`` are those of ``hung``: a value
    is in several components where one of them is."""
    split = small_side(materialize(_apart(pairs, labels), "split"))
    ends = hung.select("key", F.least("doc", "hub").alias("a"), F.greatest("doc", "hub").alias("b"))
    mixed = small_side(materialize(ends.join(split, ["a", "b"], "left_semi").select("key").distinct(), "mixed"))
    ends = ends.join(mixed, "key", "left_semi")
    members = materialize(ends.select("key", F.col("a").alias("doc")).unionByName(ends.select("key", F.col("b").alias("doc"))).distinct(), "members")
    # of two members, the larger was tested against the smaller; values with the same members are tested once
    sets = members.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.bit_xor(F.xxhash64("doc")).alias("x"), F.bit_xor(F.xxhash64("doc", F.lit(7))).alias("y")).where("size > 2")
    chosen = materialize(sets.groupBy("size", "x", "y").agg(F.min("key").alias("key")).select("key", "size"), "chosen")
    named = members.join(small_side(chosen), "key").join(labels, "doc", "left")
    named = materialize(named.select("key", "doc", F.coalesce("component", "doc").alias("label"), "size"), "named")
    blocks = F.ceil(F.col("size") / GROUP_BLOCK).cast("int")
    mine = F.pmod(F.xxhash64("doc", "key"), blocks).cast("int")
    spread = (
        named.join(meta, "doc")
        .withColumn("mine", mine)
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .withColumn("side", F.when(F.col("mine") == F.col("other"), 2).when(F.col("mine") < F.col("other"), 0).otherwise(1))
        .withColumn("part", F.xxhash64("key", F.least("mine", "other"), F.greatest("mine", "other")))
        .select("part", "side", "doc", "label", "n", "sketch")
    )
    return spread.repartition("part").sortWithinPartitions("part").mapInArrow(lambda x: _between(x, num, den, nearest), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 3, num: int = 90, den: int = 100) -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id, text_hash`` (of 128 bits of the
    text with A-Z lower-cased).

    * A text's set are its distinct ``k``-word shingles (A-Z lower-cased); fewer words are one
      shingle; no words, or null, an empty set that links with nothing.
    * Sets link when ``den * intersection >= num * union``; ``component_id`` is the smallest id among
      the rows of all texts reachable by links. Shingles are compared by 64-bit, copies of a text by
      128-bit hashes.
    * Rows link by their text: rows that repeat an id with other texts may lie in several components.
      Rows with a null id link like others, but their id is no ``component_id``, which is null where
      no linked row has an id. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    lowered = F.translate(F.coalesce(F.col(text_col), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    prints, classes, texts = distinct_texts(docs.select(F.col(id_col).alias("doc"), lowered.alias("text")), "doc", "text")
    texts = texts.withColumnRenamed("key", "doc")

    bands = Bands(num, den)
    size = docs.agg(F.coalesce(F.sum(F.octet_length(F.col(text_col))), F.lit(0))).first()[0]
    buckets = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), size // BYTES_PER_BUCKET)
    emitted = texts.mapInArrow(lambda x: _emit(x, k, bands, buckets), EMITTED)
    met = materialize(emitted.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_meet, MET), "met")
    meta = met.where("n IS NOT NULL").select("doc", "n", "sketch").dropDuplicates(["doc"])
    hung = met.where("hub IS NOT NULL").select("key", "doc", "hub")

    # whole sets are compared with the nearest hub first, then only between different components
    pairs = materialize(hung.select(F.least("doc", "hub").alias("a"), F.greatest("doc", "hub").alias("b")).distinct(), "pairs")
    close = _close(pairs, meta, num, den)
    nearest = materialize(close.groupBy("b").agg(F.min(F.struct("apart", "a")).alias("x")).select("x.a", "b"), "nearest")
    labels = components(_linked(nearest, texts, k, num, den))
    rest = _apart(close.select("a", "b").join(nearest, ["a", "b"], "left_anti"), labels)
    tested = pairs
    for nearest in NEAREST:
        more = materialize(_leftover_pairs(hung, pairs, labels, meta, num, den, nearest).join(tested, ["a", "b"], "left_anti"), "leftover")
        if rest is None and more.isEmpty():
            continue
        left = _close(more, meta, num, den).select("a", "b")
        if rest is not None:
            left, rest = materialize(left.unionByName(rest), "rest"), None
        tested = tested.unionByName(more)
        if not left.isEmpty():
            found = _linked(left, texts, k, num, den)
            if not found.isEmpty():
                labels = _merged(labels, found)

    by_key = classes.join(meta.select(F.col("doc").alias("key"), "n"), "key", "left").join(labels.withColumnRenamed("doc", "key"), "key", "left")
    by_key = by_key.select("h", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("component", "key").alias("component"))
    known = materialize(prints.groupBy("h").agg(F.min("doc").alias("rep")).join(by_key, "h"), "known")
    several = known.groupBy("component").agg(F.min("rep").alias("least"), F.count(F.lit(1)).alias("texts")).where("texts > 1").drop("texts")
    named = known.join(several, "component", "left").select("h", F.col("n").alias("n_shingles"), F.coalesce("least", "rep").alias("least"))
    return prints.join(named, "h").select(F.col("doc").alias("doc_id"), "n_shingles", F.when(F.col("n_shingles") == 0, F.col("doc")).otherwise(F.col("least")).alias("component_id"), F.col("h").alias("text_hash"))


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Components of earlier ones and new links."""
    return components(labels.select(F.col("doc").alias("a"), F.col("component").alias("b")).unionByName(links))


def op4_parity_sketch_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("text_hash")


QUERIES = {"op4_parity_sketch_join": op4_parity_sketch_join}
ORACLE: dict[str, str] = {
    "op4_parity_sketch_join": r"""
        WITH RECURSIVE d AS (
          SELECT row_number() OVER (ORDER BY doc_id) AS r, doc_id,
                 list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
          FROM documents),
        s AS (SELECT r, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
              ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS g FROM d),
        e AS (SELECT r, unnest(g) AS gram FROM s),
        common AS (SELECT a.r AS a, b.r AS b, count(*) AS n FROM e a JOIN e b ON a.gram = b.gram AND a.r < b.r GROUP BY ALL),
        link AS (SELECT a, b FROM common JOIN s x ON x.r = a JOIN s y ON y.r = b WHERE 100 * n >= 90 * (len(x.g) + len(y.g) - n)),
        either AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
        reach AS (SELECT r, r AS other FROM s UNION SELECT reach.r, either.b FROM reach JOIN either ON reach.other = either.a)
        SELECT s.doc_id, len(s.g)::BIGINT AS n_shingles, least_id AS component_id
        FROM s JOIN (SELECT reach.r, min(s.doc_id) AS least_id FROM reach JOIN s ON s.r = reach.other GROUP BY 1) USING (r)
    """
}
