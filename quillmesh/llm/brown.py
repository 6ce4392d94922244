"""Brown class-based bigram model (operator 1).

p(w | v) = p(class(w) | class(v)) * p(w | class(w)). Classes come from exchange clustering:

* the most frequent words are exchanged one by one until no move raises the likelihood of their bigrams;
* then, in distributed rounds, every word of the dictionary moves to the class that is best for the
  classes of all its neighbours, left and right, the other words' classes held. The dictionary has
  every word with at least ``LEAST_SHARE`` of all tokens, so no more than one over that;
* each other word that occurs often enough for a class gets the best one for the words that it follows.
  These words, of any number, live in a table and meet the texts by a join. As a context they, and rarer
  words, are one class.

Words that occur less than ``LEAST_COUNT`` times are the rare class, which keeps part of its probability
for the one event "unknown word". Counts are of all training text.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmesh.llm.texts import distinct_texts
from quillmesh.llm.words import ascii_words, freeing, trim
from quillmesh.storage import materialize

#: The end of a text as a token; no word is empty.
END = b""
CORE = 1024
CLASSES = 48
#: Words with such a share of all tokens are in the dictionary, which tasks hold.
LEAST_SHARE = 5e-7
#: Words that occur less often have no class of their own, so that the rare class is never empty.
LEAST_COUNT = 3
EXCHANGE_ROUNDS, DISTRIBUTED_ROUNDS = 12, 2
#: Weight of the class's own probability in a transition.
TRANSITION_PRIOR = 20.0
HELD_WORDS = 100_000
#: Texts whose words a task holds at a time.
TEXTS_TOGETHER = 200
#: Neighbours that a task counts before it sends the counts on.
HELD_CODES = 1_000_000


class Ids(dict):
    """Ids of words; -1 for others."""

    def __missing__(self, word: bytes) -> int:
        return -1


class Model(NamedTuple):
    ids: Ids
    classes: np.ndarray  # class of each id; the last class is that of rare words
    transitions: np.ndarray  # log10 p(class | class)
    emissions: np.ndarray  # log10 p(word | class) of each id
    base: np.ndarray  # log10 of the unigram base of each id


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return (b.slice(at, TEXTS_TOGETHER) for b in batches for at in range(0, b.num_rows, TEXTS_TOGETHER))


@freeing
def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def sent(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())], ["word", "c"])

    counts: Counter = Counter()
    for batch in batches:
        for text in batch.column(0):
            counts.update(ascii_words(text.as_py()))
            counts[END] += 1
            if len(counts) >= HELD_WORDS:
                yield sent(counts)
                counts = Counter()
    yield sent(counts)


def _sequence(texts: pa.Array, ids: Ids) -> tuple[np.ndarray, np.ndarray, list[list[bytes]]]:
    """Ids of all texts of a batch, each followed by the end; where each text starts; the words."""
    words = [ascii_words(t.as_py()) for t in texts]
    lengths = np.array([len(w) + 1 for w in words], np.int64)
    starts = np.cumsum(lengths) - lengths
    out = np.full(int(lengths.sum()), ids[END], np.int64)
    for w, s in zip(words, starts):
        out[s : s + len(w)] = np.fromiter(map(ids.__getitem__, w), np.int64, len(w))
    return out, starts, words


#: ids of some texts, each followed by the end, or a word outside the dictionary after an id
ENCODED = "ids binary, word binary, prev int, n long"


@freeing
def _encode(batches: Iterator[pa.RecordBatch], sent) -> Iterator[pa.RecordBatch]:
    ids = sent.value
    names, kinds = ["ids", "word", "prev", "n"], [pa.binary(), pa.binary(), pa.int32(), pa.int64()]

    def others(counts: Counter) -> pa.RecordBatch:
        words, prev = zip(*counts)
        return pa.RecordBatch.from_arrays([pa.nulls(len(words), kinds[0]), pa.array(words, kinds[1]), pa.array(prev, kinds[2]), pa.array(counts.values(), kinds[3])], names)

    held: Counter = Counter()
    for batch in _sliced(batches):
        found, starts, words = _sequence(batch.column(0), ids)
        yield pa.RecordBatch.from_arrays([pa.array([found.astype(np.int32).tobytes()], kinds[0]), *(pa.nulls(1, k) for k in kinds[1:])], names)
        before = np.concatenate([[ids[END]], found[:-1]])
        for w, s in zip(words, starts):
            own = np.flatnonzero(found[s : s + len(w)] < 0)
            held.update(zip(map(w.__getitem__, own.tolist()), before[s + own].tolist()))
        if len(held) >= HELD_WORDS:
            yield others(held)
            held = Counter()
    if held:
        yield others(held)


def _sums(codes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(np.concatenate(codes), return_counts=True)


@freeing
def _codes(batches: Iterator[pa.RecordBatch], end: int, code_of) -> Iterator[pa.RecordBatch]:
    """Counts of the codes of all neighbouring ids; ``code_of`` gives an array for two of ids."""
    held, n = [], 0
    for batch in batches:
        for data in batch.column(0):
            ids = np.frombuffer(data.as_py(), np.int32).astype(np.int64)
            if len(ids):
                held.append(code_of(np.concatenate([[end], ids[:-1]]), ids))
                n += len(held[-1])
            if n >= HELD_CODES:
                code, count = _sums(held)
                yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(count)], ["code", "n"])
                held, n = [], 0
    if held:
        code, count = _sums(held)
        yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(count)], ["code", "n"])


def _counted(encoded: DataFrame, end: int, code_of) -> DataFrame:
    return encoded.mapInArrow(lambda x: _codes(x, end, code_of), "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def exchange(bigrams: np.ndarray, classes: int, rounds: int = EXCHANGE_ROUNDS) -> np.ndarray:
    """Classes of words by exchange: each word in turn moves to the class that raises the class
    bigram likelihood most, until a round moves none. Ties go to the lowest class."""
    n = len(bigrams)
    of = np.arange(n) % classes
    one = np.eye(classes)[of]
    right, left = bigrams @ one, bigrams.T @ one
    cells = one.T @ right
    for _ in range(rounds):
        moves = 0
        for w in range(n):
            a, own = of[w], bigrams[w, w]
            r, l = right[w].copy(), left[w].copy()
            r[a] -= own
            l[a] -= own
            cells[a] -= r
            cells[:, a] -= l
            cells[a, a] -= own
            rows, columns = cells.sum(1), cells.sum(0)
            gain = (_xlogx(cells + r) - _xlogx(cells)).sum(1) + (_xlogx(cells.T + l) - _xlogx(cells.T)).sum(1)
            d = np.diagonal(cells)
            gain += _xlogx(d + r + l + own) + _xlogx(d) - _xlogx(d + r) - _xlogx(d + l)
            gain -= _xlogx(rows + r.sum() + own) - _xlogx(rows) + _xlogx(columns + l.sum() + own) - _xlogx(columns)
            b = int(np.argmax(gain))
            if gain[b] <= gain[a] + 1e-9:
                b = a
            cells[b] += r
            cells[:, b] += l
            cells[b, b] += own
            if b != a:
                of[w] = b
                moves += 1
                right[:, a] -= bigrams[:, w]
                right[:, b] += bigrams[:, w]
                left[:, a] -= bigrams[w]
                left[:, b] += bigrams[w]
        if not moves:
            break
    return of


@freeing
def _best_class(batches: Iterator[pa.RecordBatch], gains: np.ndarray, sizes: np.ndarray) -> Iterator[pa.RecordBatch]:
    """For each word (key, contexts, counts) the class of the highest likelihood: ``gains`` has a row for
    each context (log probability with each class; those before the word come first, one more than
    there are classes), ``sizes`` the log of the classes' tokens. Where the word before has no class
    as yet, the word's own class makes no difference to it."""
    for batch in (b.slice(at, 1000) for b in batches for at in range(0, b.num_rows, 1000)):
        words, contexts, counts = (batch.column(i) for i in range(3))
        row = np.repeat(np.arange(len(words)), np.diff(contexts.offsets.to_numpy()))
        cells = contexts.flatten().to_numpy(), counts.flatten().to_numpy().astype(float)
        table = np.zeros((len(words), len(gains)))
        np.add.at(table, (row, cells[0]), cells[1])
        followed = table[:, : len(sizes) + 1].sum(1, keepdims=True)
        best = np.argmax(table @ gains - followed * sizes, axis=1)
        yield pa.RecordBatch.from_arrays([words, pa.array(best.astype(np.int32))], [batch.schema.names[0], "class"])


def _gathered(rows: DataFrame, key: str) -> DataFrame:
    """``key, contexts, counts``: all contexts of a word, of which there are few, in one row."""
    return rows.groupBy(key).agg(F.collect_list(F.struct("context", "n")).alias("x")).select(key, F.col("x.context").alias("contexts"), F.col("x.n").alias("counts"))


def exchange_round(encoded: DataFrame, classes: int, word_class: np.ndarray, c: np.ndarray) -> np.ndarray:
    """New classes of all dictionary words, each the best for its neighbours' present classes. ``classes``
    stands for the class of other words; -1 (and the last place, for ids of -1) for none as yet."""
    width, end, m = 2 * (classes + 1), 0, len(c)

    def code_of(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        left, right = word_class[a], word_class[b]
        one, two = (b >= 0) & (left >= 0), (a >= 0) & (right >= 0)
        return np.concatenate([b[one] * width + left[one], a[two] * width + classes + 1 + right[two]])

    rows = materialize(_counted(encoded, end, code_of), "contexts")
    rows = rows.select(F.floor(F.col("code") / width).cast("int").alias("id"), (F.col("code") % width).cast("int").alias("context"), "n")

    def pair_of(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        left, right = word_class[a], word_class[b]
        both = (left >= 0) & (right >= 0)
        return left[both] * (classes + 1) + right[both]

    pairs = _counted(encoded, end, pair_of).toPandas()
    cells = np.full((classes + 1, classes + 1), 0.5)
    cells[pairs["code"] // (classes + 1), pairs["code"] % (classes + 1)] += pairs["n"]
    after = np.log(cells / cells.sum(1, keepdims=True))
    # rows: classes before the word, then classes behind it
    gains = np.vstack([after[:, :classes], after[:classes].T])
    known = np.flatnonzero(word_class[:m] >= 0)
    sizes = np.log(np.bincount(word_class[known], c[known], classes + 1)[:classes] + 1.0)
    chosen = _gathered(rows, "id").mapInArrow(lambda x: _best_class(x, gains, sizes), "id int, class int").toPandas()
    out = word_class.copy()
    out[chosen["id"]] = chosen["class"]
    # a word without any neighbour that has a class
    out[:m][out[:m] < 0] = int(np.argmax(sizes))
    return out


def train(texts: DataFrame, core: int = CORE, classes: int = CLASSES, least_share: float = LEAST_SHARE) -> tuple[Model, DataFrame, dict]:
    """The model, the other words with their classes (word, c, class), and the constants of training
    text (column text)."""
    spark = texts.sparkSession
    counts = materialize(texts.mapInArrow(_count_words, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c")), "words")
    total, kinds = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    is_end = F.length("word") == 0
    least = max(LEAST_COUNT, least_share * total)
    frequent = counts.where((F.col("c") >= least) & ~is_end).toPandas()
    frequent["word"] = frequent["word"].map(bytes)
    frequent = frequent.sort_values(["c", "word"], ascending=[False, True])
    ends = counts.where(is_end).select("c").first()
    words = [END, *frequent["word"]]
    c = np.array([ends[0] if ends else 0, *frequent["c"]], float)
    ids = Ids({w: i for i, w in enumerate(words)})
    sent = spark.sparkContext.broadcast(ids)
    m, rare = len(words), classes
    written = materialize(texts.mapInArrow(lambda x: _encode(x, sent), ENCODED), "encoded")
    encoded = written.where("ids IS NOT NULL").select("ids")

    size = min(core, m)
    pairs = _counted(encoded, 0, lambda a, b: (a * core + b)[(a >= 0) & (a < core) & (b >= 0) & (b < core)]).toPandas()
    bigrams = np.zeros((size, size))
    bigrams[pairs["code"] // core, pairs["code"] % core] = pairs["n"]
    # tables by id take id -1 (a word outside the dictionary) at their end
    word_class = np.full(m + 1, -1, np.int64)
    word_class[:size] = exchange(bigrams, classes)
    word_class[m] = rare
    for _ in range(DISTRIBUTED_ROUNDS):
        word_class = exchange_round(encoded, classes, word_class, c)

    moved = _counted(encoded, 0, lambda a, b: word_class[a] * (classes + 1) + word_class[b]).toPandas()
    cells = np.zeros((classes + 1, classes + 1))
    cells[moved["code"] // (classes + 1), moved["code"] % (classes + 1)] = moved["n"]

    # other words: their class by the classes that they follow
    gains = np.log((cells[:, :classes] + 0.5) / (cells.sum(1, keepdims=True) + 0.5 * classes))
    sizes = np.log(np.bincount(word_class[:m], c, classes + 1)[:classes] + 1.0)
    class_of = spark.createDataFrame([(i if i < m else -1, int(x)) for i, x in enumerate(word_class)], "prev int, context int")
    after = written.where("word IS NOT NULL").join(F.broadcast(class_of), "prev").groupBy("word", "context").agg(F.sum("n").alias("n"))
    after = materialize(after, "after")
    outside = counts.where((F.col("c") < least) & ~is_end)
    classed = _gathered(after, "word").join(outside.where(F.col("c") >= LEAST_COUNT).select("word"), "word", "left_semi")
    classed = materialize(classed.mapInArrow(lambda x: _best_class(x, gains, sizes), "word binary, class int"), "classed")
    others = materialize(outside.join(classed, "word", "left").select("word", "c", F.coalesce("class", F.lit(rare)).alias("class")), "others")
    shifted = after.join(others.where(F.col("class") != rare).select("word", "class"), "word").groupBy("context", "class").agg(F.sum("n").alias("n")).toPandas()
    for a, b, n in zip(shifted["context"], shifted["class"], shifted["n"]):
        cells[a, b] += n
        cells[a, rare] -= n

    tokens = others.where(F.col("class") != rare).groupBy("class").agg(F.sum("c").alias("c")).toPandas()
    in_class = np.bincount(word_class[:m], np.maximum(c, 0.5), classes + 1)
    in_class[tokens["class"]] += tokens["c"]
    share = (cells.sum(0) + 0.5) / (cells.sum() + 0.5 * (classes + 1))
    used = in_class > 0
    used[rare] = True
    share = np.where(used, share, 0) / share[used].sum()
    transitions = np.log10(np.maximum((cells + TRANSITION_PRIOR * share) / (cells.sum(1, keepdims=True) + TRANSITION_PRIOR), 1e-300))
    emissions = np.log10(np.maximum(c, 0.5) / in_class[word_class[:m]])
    base = np.log10((c + 0.5) / (total + 0.5 * (kinds + 1)))

    tokens, rare_kinds, once, twice = others.where(F.col("class") == rare).agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1)), F.count_if(F.col("c") == 1), F.count_if(F.col("c") == 2)).first()
    discount = (once + 0.5) / (once + 2 * twice + 1.0)
    constants = {"total": total, "kinds": kinds, "rare": rare, "rare_tokens": tokens, "rare_kinds": rare_kinds, "discount": discount, "in_class": in_class.tolist()}
    padded = [np.append(x, 0.0) for x in (emissions, base)]
    return Model(ids, word_class, transitions, *padded), others, constants


@freeing
def _score(batches: Iterator[pa.RecordBatch], sent) -> Iterator[pa.RecordBatch]:
    """Of each text, the score of its dictionary words, and its other words with the class before."""
    model: Model = sent.value
    names = ["key", "n", "known", "base", "score", "word", "before"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary(), pa.int32()]
    for batch in _sliced(batches):
        ids, starts, words = _sequence(batch.column(1), model.ids)
        cls = model.classes[ids]
        before = np.concatenate([[model.classes[model.ids[END]]], cls[:-1]])
        known = ids >= 0
        score = np.add.reduceat(np.where(known, model.transitions[before, cls] + model.emissions[ids], 0.0), starts)
        base = np.add.reduceat(model.base[ids], starts)
        counted = np.add.reduceat(known.astype(np.int64), starts)
        ends = np.append(starts[1:], len(ids)) - 1
        keys = batch.column(0).to_pylist()
        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip((keys, ends - starts + 1, counted, base, score), kinds)] + [pa.nulls(len(keys), k) for k in kinds[5:]], names)
        rows = []
        for key, text, s in zip(keys, words, starts):
            own = np.flatnonzero(~known[s : s + len(text)])
            rows.extend((key, n, w, v) for (w, v), n in Counter(zip(map(text.__getitem__, own.tolist()), before[s + own].tolist())).items())
        if rows:
            k, n, w, v = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(k, pa.int64()), pa.array(n, pa.int64()), *(pa.nulls(len(k), t) for t in kinds[2:5]), pa.array(w, pa.binary()), pa.array(v, pa.int32())], names)


def score_texts(texts: DataFrame, model: Model, others: DataFrame, constants: dict) -> DataFrame:
    """``key, n_tokens, n_known, base_score, score`` of texts (columns key, text; keys are unique)."""
    spark = texts.sparkSession
    sent = spark.sparkContext.broadcast(model)
    trim()
    parts = materialize(texts.mapInArrow(lambda x: _score(x, sent), "key long, n long, known long, base double, score double, word binary, before int"), "scores")
    x = constants
    weight = float(max(x["rare_tokens"], 1))
    unknown = np.log10(x["discount"] * x["rare_kinds"] / weight) if x["rare_kinds"] else 0.0
    moves = [(a, b, float(p), float(x["in_class"][b])) for a, row in enumerate(model.transitions) for b, p in enumerate(row)]
    moves = spark.createDataFrame(moves, "before int, class int, move double, tokens double")
    c, cls = F.coalesce("c", F.lit(0)), F.coalesce("class", F.lit(x["rare"]))
    rare = F.when(c > 0, F.log10((c - x["discount"]) / weight)).otherwise(F.lit(float(unknown)))
    emission = F.col("move") + F.when(F.col("class") == x["rare"], rare).otherwise(F.log10(F.col("c") / F.col("tokens")))
    base = F.log10((c + 0.5) / (x["total"] + 0.5 * (x["kinds"] + 1)))
    met = parts.where("word IS NOT NULL").select("key", "n", "word", "before").join(others, "word", "left").withColumn("class", cls).join(F.broadcast(moves), ["before", "class"])
    more = met.groupBy("key").agg(F.sum(F.when(c > 0, F.col("n")).otherwise(0)).alias("more"), F.sum(F.col("n") * base).alias("other_base"), F.sum(F.col("n") * emission).alias("other_score"))
    whole = parts.where("word IS NULL").select("key", "n", "known", "base", "score").dropDuplicates(["key"])
    zero = F.lit(0.0)
    # the end is in every model, but nothing is known if nothing was learned
    known = F.col("known") if x["total"] else F.lit(0).cast("long")
    return whole.join(more, "key", "left").select(
        "key",
        F.col("n").alias("n_tokens"),
        (known + F.coalesce("more", F.lit(0))).alias("n_known"),
        (F.col("base") + F.coalesce("other_base", zero)).alias("base_score"),
        (F.col("score") + F.coalesce("other_score", zero)).alias("score"),
    )


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % divisor


def class_model_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 5, held: int = 1, **sizes: float) -> DataFrame:
    """One row per input row: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score,
    perplexity``.

    * Tokens are A-Z-lower-cased words and one end per text; null is an empty text.
    * The model learns from rows whose id's crc32 modulo ``folds`` is not ``held``; copies and
      repeated rows count each time. ``score`` is log10 of the text's probability; all unknown
      words are one event, as in ``base_score``. Perplexity is per token.
    * Without training rows every word is unknown. An empty table gives an empty result.
    """
    out = remainder(F.col(id_col), folds) == held
    model, others, constants = train(docs.where(~out).select(F.col(text_col).alias("text")), **sizes)
    prints, classes, texts = distinct_texts(docs, id_col, text_col)
    scores = classes.select("h", "key").join(score_texts(texts, model, others, constants), "key")
    return prints.join(scores, "h").select(
        F.col("doc").alias("doc_id"),
        (remainder(F.col("doc"), folds) == held).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(int(constants["total"])).cast("long").alias("train_tokens"),
        "base_score",
        "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )


def op1_brown_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return class_model_scores(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op1_brown_classes": op1_brown_classes}
ORACLE: dict[str, str] = {}
