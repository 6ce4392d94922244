"""Benchmark decontamination by latent semantic retrieval (operator 9).

TF-IDF rows of the benchmark's passages get a latent space of ``RANK`` dimensions by distributed
randomised SVD; document frequencies are counted over all documents. Each document's windows are
projected into the space, and passages whose cosine with a window reaches ``COSINE`` are candidates.
A weighted longest common subsequence of passage and text around the window, and of the passage's
answer (its last sentence), decides.

A passage of more words than a window is cut into parts that each have a row of their own; the
windows of all its parts are candidates for the whole passage. Large benchmarks are searched in
groups of passages, each with its own space.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain, repeat
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmesh.llm.texts import distinct_texts
from quillmesh.llm.words import freeing, trim
from quillmesh.storage import materialize, small_side

WINDOW, STRIDE = 48, 16
#: Dimensions of the latent space, and those sought beyond that number while it is computed.
RANK, OVERSAMPLING, POWER_ROUNDS = 64, 16, 2
#: Words of less inverse document frequency are left out of the vectors of passages that have others.
LEAST_IDF = 1.5
#: Latent cosine of a window and a passage's part from which on the passage is a candidate.
COSINE = 0.6
#: A window whose vector reaches less far along the part's can't hold enough of it to match.
REACHED = 0.4
#: A window that reaches the first of the length needs the second of that cosine only.
COPIED, SHARE = 0.95, 0.6
#: Weighted share of a passage found in order, alone, or with that share of its answer.
WHOLE, PART, ANSWER = 0.6, 0.4, 0.6
#: About so many passages are searched at once.
PASSAGES_TOGETHER = 20_000
#: Words of documents, and cosines, that a task computes together.
WORDS_TOGETHER, COSINES_TOGETHER = 60_000, 1_000_000
FEATURES_TOGETHER = 512


def words_of(text: str | None) -> list[str]:
    """Lower-cased runs of letters and digits."""
    text = (text or "").lower()
    for c in set(text):
        if not c.isalnum():
            text = text.replace(c, " ")
    return text.split()


def answer_of(text: str | None) -> list[str]:
    """Words of the last sentence that has three; of a single sentence, its last eight words."""
    sentences = [w for w in map(words_of, re.split(r"[.!?\n]+", text or "")) if len(w) >= 3]
    return sentences[-1] if len(sentences) > 1 else words_of(text)[-8:]


def parts_of(words: list[str]) -> list[list[str]]:
    """Cuts of about the same length, none longer than a window."""
    n = -(-len(words) // WINDOW)
    return [words[len(words) * i // n : len(words) * (i + 1) // n] for i in range(n)]


class Passage(NamedTuple):
    item: int
    words: list[str]
    weights: np.ndarray  # of the words
    answer: list[str]
    answer_weights: np.ndarray
    by_word: dict[str, float]  # the summed weight of each different word
    total: float
    step: int  # windows that start in one stretch of so many words are candidates together


def weighed(item: int, words: list[str], answer: list[str], of) -> Passage:
    """A passage whose words have the weights that ``of`` gives a list of them."""
    weights, by_word = of(words), {}
    for w, x in zip(words, weights.tolist()):
        by_word[w] = by_word.get(w, 0.0) + x
    return Passage(item, words, weights, answer, of(answer), by_word, float(weights.sum()), max(STRIDE, len(words) // 8 // STRIDE * STRIDE))


class Space(NamedTuple):
    passages: list[Passage]
    owners: np.ndarray  # the passage of each part
    ids: dict[str, int]  # features; -1 is none
    vectors: np.ndarray  # of each feature in the latent space, and of none
    counts: np.ndarray  # whether a feature is in a part's vector, and of none
    parts: np.ndarray  # unit vectors of the parts in the latent space, a column each
    lengths: np.ndarray  # of the parts in the latent space
    cosines: np.ndarray  # that a window must have with each part


@freeing
def _frequencies(batches: Iterator[pa.RecordBatch], vocabulary) -> Iterator[pa.RecordBatch]:
    ids = vocabulary.value
    counts = np.zeros(len(ids), np.int64)
    for batch in batches:
        for text, rows in zip(batch.column(0), batch.column(1).to_pylist()):
            found = [i for w in set(words_of(text.as_py())) if (i := ids.get(w)) is not None]
            counts[found] += rows
    held = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(counts[held])], ["id", "n"])


@freeing
def _partial(rows: Iterator[pd.DataFrame], sent, right: bool) -> Iterator[pd.DataFrame]:
    """Of a part of the matrix A and a factor M: A'(AM) by features, or (AM)'(AM)."""
    factor = sent.value
    total = np.zeros((factor.shape[1],) * 2 if right else factor.shape)
    for pdf in rows:
        for ids, values in zip(pdf["ids"], pdf["values"]):
            ids, values = np.asarray(ids, np.int64), np.asarray(values, float)
            y = values @ factor[ids]
            if right:
                total += np.outer(y, y)
            else:
                total[ids] += np.outer(values, y)
    step = len(total) if right else FEATURES_TOGETHER
    for at in range(0, len(total), step):
        yield pd.DataFrame({"part": [at], "data": [total[at : at + step].tobytes()]})


def _added(key, pdf: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(x) for x in pdf["data"])
    return pd.DataFrame({"part": [int(key[0])], "data": [total.tobytes()]})


def randomised_svd(rows: DataFrame, features: int, rank: int, rounds: int = POWER_ROUNDS, seed: int = 7) -> np.ndarray:
    """The leading right singular vectors (features by at most ``rank``) of sparse rows (ids, values).

    Only products of the distributed rows with a small factor are computed; their sums by blocks of
    features come to the driver, as large as the result itself.
    """
    sc = rows.sparkSession.sparkContext
    width = min(features, rank + OVERSAMPLING)

    def product(factor: np.ndarray, right: bool) -> np.ndarray:
        sent = sc.broadcast(factor)
        parts = rows.mapInPandas(lambda x: _partial(x, sent, right), "part long, data binary").groupBy("part").applyInPandas(_added, "part long, data binary").toPandas().sort_values("part")
        return np.concatenate([np.frombuffer(x).reshape(-1, factor.shape[1]) for x in parts["data"]])

    basis = np.random.default_rng(seed).standard_normal((features, width))
    for _ in range(1 + rounds):
        basis, _ = np.linalg.qr(product(basis, False))
    values, vectors = np.linalg.eigh(product(basis, True))
    order = np.argsort(values)[::-1][:rank]
    return basis @ vectors[:, order[values[order] > 1e-12 * max(values.max(), 1e-300)]]


def least_cosines(words: list[int]) -> np.ndarray:
    """``COSINE`` for parts as long as a window. Around a shorter one stand other words: of a window it
    fills by a third, a third of the squared length is its own, so the cosine goes with the root."""
    return (COSINE * np.sqrt(np.minimum(1.0, np.array(words) / WINDOW))).astype(np.float32)


def latent_space(benchmark: DataFrame, texts: DataFrame, total: int, id_col: str, text_col: str, rank: int = RANK) -> Space:
    """The passages and their latent space; ``texts`` (text, rows) give document frequencies."""
    spark = benchmark.sparkSession
    taken = benchmark.select(F.col(id_col).cast("long").alias("item"), F.col(text_col).alias("text")).where("item IS NOT NULL AND text IS NOT NULL").toPandas()
    passages = sorted(p for p in ((int(i), words_of(t), answer_of(t)) for i, t in zip(taken["item"], taken["text"])) if p[1])
    vocabulary = {w: i for i, w in enumerate(sorted({w for _, ws, _ in passages for w in ws}))}
    counted = np.zeros(len(vocabulary))
    if vocabulary:
        sent = spark.sparkContext.broadcast(vocabulary)
        found = texts.mapInArrow(lambda x: _frequencies(x, sent), "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
        counted[found["id"]] = found["n"]
    weights = np.maximum(np.log((total + 1.0) / (counted + 0.5)), 0.05)
    of = lambda ws: weights[[vocabulary[w] for w in ws]]
    passages = [weighed(i, ws, answer, of) for i, ws, answer in passages]
    owners, rows, sizes, counts = [], [], [], np.zeros(len(vocabulary), bool)
    for owner, passage in enumerate(passages):
        least = LEAST_IDF if (passage.weights >= LEAST_IDF).any() else 0.0
        for ws in parts_of(passage.words):
            found, n = np.unique([i for w in ws if weights[i := vocabulary[w]] >= least], return_counts=True)
            if len(found):
                found = found.astype(np.int64)
                owners.append(owner)
                sizes.append(len(ws))
                rows.append((found.tolist(), (n * weights[found]).tolist()))
                counts[found] = True
    if not rows:
        return Space(passages, np.empty(0, np.int64), vocabulary, np.zeros((len(vocabulary) + 1, 0), np.float32), np.zeros(len(vocabulary) + 1, bool), np.zeros((0, 0), np.float32), np.empty(0, np.float32), np.empty(0, np.float32))
    space = randomised_svd(spark.createDataFrame(rows, "ids array<int>, values array<double>"), len(vocabulary), rank)
    latent = np.array([np.asarray(v) @ space[i] for i, v in rows])
    lengths = np.maximum(np.linalg.norm(latent, axis=1), 1e-12)
    used = np.where(counts, weights, 0.0)
    vectors = np.vstack([used[:, None] * space, np.zeros(space.shape[1])]).astype(np.float32)
    parts = np.ascontiguousarray((latent / lengths[:, None]).T, np.float32)
    return Space(passages, np.array(owners), vocabulary, vectors, np.append(counts, False), parts, lengths.astype(np.float32), least_cosines(sizes))


def weighted_lcs(a: list[str], b: list[str], weights: np.ndarray) -> float:
    """The heaviest common subsequence; ``weights`` are of the words of ``a``."""
    place = {w: i for i, w in enumerate(dict.fromkeys(a))}
    x, y = np.array([place[w] for w in a]), np.array([place.get(w, -1) for w in b])
    best = np.zeros(len(x) + 1)
    for c in y[y >= 0]:
        matched = np.concatenate([[0.0], np.where(x == c, best[:-1] + weights, 0.0)])
        best = np.maximum.accumulate(np.maximum(best, matched))
    return float(best[-1])


def candidates(texts: list[list[str]], space: Space) -> Iterator[tuple[int, int, int, float]]:
    """(text, first word of a window, part, cosine) of all windows that are near a part.

    Texts are laid out in stretches of STRIDE words with blank ones behind each, so that a window is
    the sum of neighbouring stretches and none crosses into another text.
    """
    lengths = np.array([len(ws) for ws in texts], np.int64)
    starts = lengths // STRIDE + 1
    wide = WINDOW // STRIDE
    base = np.cumsum(starts + wide) - (starts + wide)
    n = int(lengths.sum())
    ids = np.fromiter(map(space.ids.get, chain.from_iterable(texts), repeat(-1)), np.int64, n)
    at = np.flatnonzero(space.counts[ids])
    if not len(at):
        return
    text = np.repeat(np.arange(len(texts)), lengths)[at]
    stretch = base[text] + (at - (np.cumsum(lengths) - lengths)[text]) // STRIDE
    first = np.flatnonzero(np.concatenate([[True], stretch[1:] != stretch[:-1]]))
    sums = np.zeros((int((starts + wide).sum()), space.vectors.shape[1]), np.float32)
    filled = np.zeros(len(sums), bool)
    sums[stretch[first]] = np.add.reduceat(space.vectors[ids[at]], first, axis=0)
    filled[stretch[first]] = True
    count = len(sums) - wide + 1
    rows = np.flatnonzero(np.logical_or.reduce([filled[i : count + i] for i in range(wide)]))
    step = max(1, COSINES_TOGETHER // max(1, len(space.lengths)))
    for i in range(0, len(rows), step):
        part = rows[i : i + step]
        window = sum(sums[part + k] for k in range(wide))
        reach = window @ space.parts
        norm = np.maximum(np.linalg.norm(window, axis=1, keepdims=True), 1e-12)
        rows_near, parts_near = np.nonzero(reach >= REACHED * space.lengths)
        reached, cosine, least = reach[rows_near, parts_near], reach[rows_near, parts_near] / norm[rows_near, 0], space.cosines[parts_near]
        # a window that reaches nearly all of a part may hold much else
        good = (cosine >= least) | ((reached >= COPIED * space.lengths[parts_near]) & (cosine >= SHARE * least))
        rows_near, parts_near, cosine = rows_near[good], parts_near[good], cosine[good]
        owner = np.searchsorted(base, part[rows_near], "right") - 1
        first_word = (part[rows_near] - base[owner]) * STRIDE
        yield from zip(owner.tolist(), first_word.tolist(), parts_near.tolist(), cosine.tolist())


def region_of(passage: Passage, start: int, words: int) -> tuple[int, int]:
    """Where a match is sought whose candidate windows start at ``start`` or within a step of it."""
    length = len(passage.words)
    return max(0, start - length), min(words, start + passage.step - STRIDE + WINDOW + length)


def decide(passage: Passage, region: list[str], known: float = 0.0) -> tuple[float, float] | None:
    """The shares of passage and answer found in order, if they are a match and more than ``known``."""
    by_word = passage.by_word
    if sum(map(by_word.__getitem__, by_word.keys() & region)) < max(PART, known) * passage.total:
        return None  # no subsequence can be heavier than the words that occur
    whole = weighted_lcs(passage.words, region, passage.weights) / passage.total
    if whole < PART or whole <= known:
        return None
    part = weighted_lcs(passage.answer, region, passage.answer_weights) / max(passage.answer_weights.sum(), 1e-12)
    return (whole, part) if whole >= WHOLE or part >= ANSWER else None


MATCH = "key long, item_id long, cosine double, passage_share double, answer_share double, start_word int, end_word int"


@freeing
def _matches(batches: Iterator[pa.RecordBatch], sent) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int32(), pa.int32()]
    names = [x.split()[0] for x in MATCH.split(", ")]
    space: Space = sent.value

    def found(keys: list[int], texts: list[list[str]]) -> pa.RecordBatch:
        near: dict[tuple[int, int, int], float] = {}
        owners, steps = space.owners.tolist(), [p.step for p in space.passages]
        for text, start, part, cosine in candidates(texts, space):
            owner = owners[part]
            at = text, owner, start - start % steps[owner]
            near[at] = max(cosine, near.get(at, cosine))
        best: dict[tuple[int, int], tuple] = {}
        for (text, owner, start), cosine in sorted(near.items()):
            known = best[text, owner][1] if (text, owner) in best else 0.0
            if known > 0.99:
                continue
            a, b = region_of(space.passages[owner], start, len(texts[text]))
            shares = decide(space.passages[owner], texts[text][a:b], known)
            if shares:
                best[text, owner] = (cosine, *shares, a, b)
        out = [(keys[text], space.passages[owner].item, *x) for (text, owner), x in best.items()]
        columns = list(zip(*out)) if out else [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    keys, texts, held = [], [], 0
    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            words = words_of(text.as_py())
            if words and len(space.lengths):
                keys.append(key)
                texts.append(words)
                held += len(words)
            if held >= WORDS_TOGETHER:
                yield found(keys, texts)
                keys, texts, held = [], [], 0
    if keys:
        yield found(keys, texts)


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", rank: int = RANK) -> DataFrame:
    """One row per document row and benchmark passage found in it: ``doc_id, item_id, cosine,
    passage_share, answer_share, start_word, end_word`` (the region of the best match), ``text_hash``
    (of 128 bits).

    * Words are runs of letters and digits, lower-cased; nulls have none and match nothing, nor do
      passages without an id. Rows that repeat are each reported; equal passages with several ids
      are all reported, an id's several passages as one. Empty tables give no row.
    * Any number of passages is searched, in groups of about ``PASSAGES_TOGETHER``.
    """
    prints, classes, texts = distinct_texts(docs, id_col, text_col)
    total = prints.count()
    # texts with their number of copies, for document frequencies over all rows
    copied = small_side(classes.where("rows > 1").select("key", "rows"))
    weighted = texts.join(copied, "key", "left").select("text", F.coalesce("rows", F.lit(1)).alias("rows"))
    groups = max(1, -(-benchmark.count() // PASSAGES_TOGETHER))
    found = None
    for group in range(groups):
        own = benchmark.where(F.pmod(F.xxhash64(F.col(item_col)), F.lit(groups)) == group)
        sent = docs.sparkSession.sparkContext.broadcast(latent_space(own, weighted, total, item_col, item_text_col, rank))
        trim()
        rows = materialize(texts.mapInArrow(lambda x, sent=sent: _matches(x, sent), MATCH), "matches")
        found = rows if found is None else found.unionByName(rows)
    best = F.max_by(F.struct("cosine", "passage_share", "answer_share", "start_word", "end_word"), F.struct("passage_share", "cosine", "start_word")).alias("x")
    once = found.groupBy("key", "item_id").agg(best).select("key", "item_id", "x.*")
    named = once.join(classes.select("h", "key"), "key").drop("key")
    return prints.join(small_side(materialize(named, "leaks")), "h").withColumnsRenamed({"doc": "doc_id", "h": "text_hash"})


def op9_latent_retrieval(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


QUERIES = {"op9_latent_retrieval": op9_latent_retrieval}
ORACLE: dict[str, str] = {}
