"""Language identification by segmentation-marginalised unigrams (operator 10).

Each language has a probability for every piece of a fixed public vocabulary. A word's likelihood is
the sum, by the forward algorithm, over all ways to segment it into pieces; a text's is the product
over its words. Piece probabilities are learned by expectation maximisation over word counts of
labelled texts, also over all segmentations.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmesh.llm.brown import remainder
from quillmesh.llm.packing import vocabulary
from quillmesh.llm.texts import distinct_texts
from quillmesh.llm.words import CACHES, freeing
from quillmesh.storage import materialize

#: Longer words are summed in log space, where nothing underflows.
PLAIN_LENGTH = 32
#: Characters of words that are worked on together.
CHARACTERS_TOGETHER = 200_000
#: Probability of a character that no piece covers.
UNCOVERED = 1e-9
#: Words of all languages whose expectations are summed together.
WORDS_TOGETHER = 20_000
EM_ROUNDS = 3
SMOOTHING = 0.05
#: About so many labelled texts are learned from (a sample by hash of the id).
TRAINING_TEXTS = 20_000
CACHED_WORDS = 100_000
_BASE, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def parts(text: str) -> list[str]:
    """Lower-cased words, each after a word start mark."""
    return ["▁" + word for word in text.lower().split()]


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


def load_pieces(path: str) -> list[str]:
    """All pieces of the vocabulary that lower-cased text can have."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    every = (model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_byte(i) or model.is_unknown(i)))
    return sorted({p for p in every if p and p == p.lower()})


def _codes(words: list[str]) -> np.ndarray:
    """Code points of words of one length, a row each."""
    return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(words), -1).astype(np.uint64)


class Lattice:
    """Finds the pieces of many words of one length at once, along the pieces' prefixes."""

    def __init__(self, pieces: list[str]):
        self.size = len(pieces)
        prefixes: dict[int, list] = {}
        for i, piece in enumerate(pieces):
            value = 0
            for at, c in enumerate(piece, 1):
                value = (value * int(_BASE) + ord(c) + 1) % 2**64
                entry = prefixes.setdefault(value, [self.size, False])
                if at == len(piece):
                    entry[0] = i
                else:
                    entry[1] = True
        self.hashes = np.array(sorted(prefixes), np.uint64)
        self.piece, self.more = (np.array([prefixes[h][k] for h in self.hashes.tolist()]) for k in (0, 1))
        # an open table of at most a quarter of its slots: a slot has a place in ``hashes``, or -1
        bits = max(4, (4 * len(self.hashes)).bit_length())
        self.shift, self.slots = np.uint64(64 - bits), np.full(1 << bits, -1, np.int32)
        for place, slot in enumerate((self.hashes * _MIX >> self.shift).tolist()):
            while self.slots[slot] >= 0:
                slot = (slot + 1) % len(self.slots)
            self.slots[slot] = place

    def _places(self, total: np.ndarray) -> np.ndarray:
        """The place of each hash in ``hashes``, or -1."""
        slot = (total * _MIX >> self.shift).astype(np.int64)
        out = self.slots[slot]
        other = np.flatnonzero((out >= 0) & (self.hashes[out] != total))
        while len(other):  # the slot has another prefix
            slot[other] = (slot[other] + 1) % len(self.slots)
            place = out[other] = self.slots[slot[other]]
            other = other[(place >= 0) & (self.hashes[place] != total[other])]
        return out

    def pieces(self, codes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each size from 1: places (start * words + word, ascending) and the piece of that size there."""
        n, length = codes.shape
        flat = np.ascontiguousarray(codes.T).ravel()
        at, total, out = np.arange(len(flat)), np.zeros(len(flat), np.uint64), []
        for size in range(1, length + 1):
            inside = np.searchsorted(at, (length - size + 1) * n)
            at = at[:inside]
            total = total[:inside] * _BASE + flat[at + (size - 1) * n] + np.uint64(1)
            entry = self._places(total)
            known = np.flatnonzero(entry >= 0)
            entry = entry[known]
            piece = self.piece[entry]
            ends = piece < self.size
            out.append((at[known[ends]], piece[ends]))
            alive = known[self.more[entry]]
            at, total = at[alive], total[alive]
            if not len(at):
                break
        return out

    def _weights(self, found: list, n: int, length: int, probs: np.ndarray, log: bool) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Per size: places, their weights, and where each start's places begin. Each character has a weight."""
        out = []
        for size, (at, piece) in enumerate(found, 1):
            if size == 1:
                single = np.full(n * length, self.size)
                single[at] = piece
                at, weight = np.arange(n * length), np.maximum(probs[single], UNCOVERED)
            else:
                weight = probs[piece]
            if log:
                with np.errstate(divide="ignore"):
                    weight = np.log(weight)
            out.append((at, weight, np.searchsorted(at, np.arange(length + 1) * n)))
        return out

    def sums(self, weights: list, n: int, length: int, models: int, log: bool, backward: bool = False) -> np.ndarray:
        """[t, word, model]: the summed weight of all segmentations of the first t characters, or,
        backward, of those from character t on."""
        out = np.full((length + 1, n, models), -np.inf if log else 0.0)
        out[length if backward else 0] = 0.0 if log else 1.0
        steps = range(length - 1, -1, -1) if backward else range(1, length + 1)
        for t in steps:
            for size, (at, weight, begins) in enumerate(weights, 1):
                start = t if backward else t - size
                if start < 0 or start + size > length:
                    continue
                a, b = begins[start], begins[start + 1]
                if a == b:
                    continue
                # each word has a weight of size 1 everywhere
                rows = slice(None) if size == 1 else at[a:b] - start * n
                here, other = out[t], out[start + size if backward else start][rows]
                if log:
                    here[rows] = np.logaddexp(here[rows], other + weight[a:b])
                else:
                    here[rows] += other * weight[a:b]
        return out

    @staticmethod
    def _by_length(words: list[str]) -> Iterator[tuple[int, np.ndarray]]:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        for length in np.unique(lengths):
            rows, step = np.flatnonzero(lengths == length), max(1, CHARACTERS_TOGETHER // int(length))
            for at in range(0, len(rows), step):
                yield int(length), rows[at : at + step]

    def log_likelihoods(self, words: list[str], probs: np.ndarray) -> np.ndarray:
        """Of each word (none is empty) under each model: the log of the sum over all segmentations.
        ``probs`` has a row for each piece and one of zeros, and a column for each model."""
        out = np.empty((len(words), probs.shape[1]))
        for length, rows in self._by_length(words):
            log = length > PLAIN_LENGTH
            found = self.pieces(_codes([words[i] for i in rows]))
            total = self.sums(self._weights(found, len(rows), length, probs, log), len(rows), length, probs.shape[1], log)[-1]
            out[rows] = total if log else np.log(np.maximum(total, 1e-300))
        return out

    def expected(self, words: list[str], counts: np.ndarray, probs: np.ndarray) -> np.ndarray:
        """Expected uses of each piece (and, last, nothing) under a single model, over all segmentations."""
        out = np.zeros(self.size + 1)
        for length, rows in self._by_length(words):
            n, log = len(rows), length > PLAIN_LENGTH
            found = self.pieces(_codes([words[i] for i in rows]))
            weights = self._weights(found, n, length, probs[:, None], log)
            alpha, beta = (self.sums(weights, n, length, 1, log, backward).ravel() for backward in (False, True))
            whole = alpha[length * n :]
            for size, (at, piece) in enumerate(found, 1):
                word = at % n
                if log:
                    with np.errstate(divide="ignore"):
                        use = np.exp(alpha[at] + np.log(probs[piece]) + beta[at + size * n] - whole[word])
                else:
                    use = alpha[at] * probs[piece] * beta[at + size * n] / np.maximum(whole[word], 1e-300)
                out += np.bincount(piece, use * counts[rows][word], self.size + 1)
        return out


_lattices: dict[str, Lattice] = {}


def lattice(path: str) -> Lattice:
    if path not in _lattices:
        _lattices[path] = Lattice(load_pieces(path))
    return _lattices[path]


@freeing
def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (b.slice(at, 1000) for b in batches for at in range(0, b.num_rows, 1000)):
        counts: Counter = Counter()
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            counts.update((lang, w) for w in parts(text.as_py() or ""))
        langs, words = zip(*counts) if counts else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(words, pa.string()), pa.array(counts.values(), pa.int64())], ["lang", "word", "c"])


def _together(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """The batches, joined until they have ``rows`` rows."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held)


@freeing
def _expectations(batches: Iterator[pa.RecordBatch], path: str, langs: list[str], sent) -> Iterator[pa.RecordBatch]:
    found, probs = lattice(path), sent.value
    sums = np.zeros((len(langs), found.size + 1))
    for batch in _together(batches, WORDS_TOGETHER):
        lang = np.array(batch.column(0).to_pylist(), object)
        words, counts = np.array(batch.column(1).to_pylist(), object), batch.column(2).to_numpy().astype(float)
        for i, name in enumerate(langs):
            own = np.flatnonzero(lang == name)
            if len(own):
                sums[i] += found.expected(list(words[own]), counts[own], probs[:, i])
    i, piece = np.nonzero(sums[:, :-1])
    yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(piece.astype(np.int32)), pa.array(sums[i, piece])], ["i", "piece", "e"])


def train(texts: DataFrame, path: str, rounds: int = EM_ROUNDS, limit: int = TRAINING_TEXTS) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, piece probabilities (a row per piece and a last of zeros, a column per language)
    and log priors, from about ``limit`` of the labelled texts (columns id, lang, text)."""
    spark = texts.sparkSession
    labelled = texts.where("lang IS NOT NULL AND text IS NOT NULL")
    rows = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).toPandas().sort_values("lang")
    langs, total = list(rows["lang"]), int(rows["n"].sum())
    size = lattice(path).size
    if not langs:
        return [], np.zeros((size + 1, 0)), np.zeros(0)
    # every language is sampled alike, but rare ones are taken whole
    fair = limit / len(langs)
    share = F.create_map(*[F.lit(x) for lang, n in zip(langs, rows["n"]) for x in (lang, float(min(1.0, max(limit / total, fair / (4 * n)))))])
    drawn = F.pmod(F.xxhash64("id", F.lit(3)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    sample = labelled.where(drawn < share[F.col("lang")]).select("lang", "text")
    counts = sample.mapInArrow(_word_counts, "lang string, word string, c long").groupBy("lang", "word").agg(F.sum("c").alias("c"))
    counts = materialize(counts, "language-words")
    probs = np.full((size + 1, len(langs)), 1 / size)
    probs[size] = 0
    for _ in range(rounds):
        sent = spark.sparkContext.broadcast(probs)
        sums = counts.mapInArrow(lambda x: _expectations(x, path, langs, sent), "i int, piece int, e double").groupBy("i", "piece").agg(F.sum("e").alias("e")).toPandas()
        expected = np.full((size, len(langs)), SMOOTHING)
        expected[sums["piece"], sums["i"]] += sums["e"]
        probs = np.vstack([expected / expected.sum(0), np.zeros(len(langs))])
    return langs, probs, np.log(rows["n"].to_numpy() / total)


class _Numbered(dict):
    """Words by number, from 0 in order of their first use."""

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        return number


_scored = _Numbered()
CACHES.append(_scored)


@freeing
def _predict(batches: Iterator[pa.RecordBatch], path: str, langs: list[str], sent) -> Iterator[pa.RecordBatch]:
    found, (probs, prior) = lattice(path), sent.value
    known, known_scores = _scored, np.empty((0, len(langs)))
    known.clear()
    for batch in (b.slice(at, 1000) for b in batches for at in range(0, b.num_rows, 1000)):
        if len(known) > CACHED_WORDS:
            known.clear()
            known_scores = known_scores[:0]
        texts = [t.as_py() for t in batch.column(1)]
        split = [parts(t) if langs and has_letter(t) else [] for t in texts]  # a letter is in a word
        before, sizes = len(known), np.fromiter(map(len, split), np.int64, len(split))
        numbers = np.fromiter(map(known.__getitem__, chain.from_iterable(split)), np.int64, sizes.sum())
        new, more = list(islice(known, before, None)), [known_scores]
        for at in range(0, len(new), 20_000):
            more.append(found.log_likelihoods(new[at : at + 20_000], probs))
        known_scores = np.concatenate(more)
        names, scores, begin = [], [], 0
        for size in sizes.tolist():
            if not size:
                names.append("und")
                scores.append(0.0)
                continue
            total = known_scores[numbers[begin : begin + size]].sum(axis=0) + prior
            begin += size
            posterior = np.exp(total - total.max())
            best = int(np.argmax(posterior))
            names.append(langs[best])
            scores.append(float(posterior[best] / posterior.sum()))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["key", "lang_pred", "score"])


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 5, held: int = 0, pieces: str | None = None) -> DataFrame:
    """One row per input row: ``doc_id, held_out, lang_pred, score``.

    * Learned from rows with text and language whose id's crc32 modulo ``folds`` is not ``held``; a
      prediction depends on the text alone. Equal texts get equal predictions.
    * ``score`` is the posterior probability of the predicted language. Ties go to the first
      language by name.
    * Words of any length and pieces of any length take part; text is lower-cased.
    * A text that is null or has no letter (``str.isalpha``) is "und" with score 0; so is all if nothing was learned.
    """
    path = pieces or vocabulary("piece_bpe_32k.model")
    train_rows = docs.where(remainder(F.col(id_col), folds) != held).select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    langs, probs, prior = train(train_rows, path)
    prints, classes, texts = distinct_texts(docs, id_col, text_col)
    sent = docs.sparkSession.sparkContext.broadcast((probs, prior))
    predicted = materialize(texts.mapInArrow(lambda x: _predict(x, path, langs, sent), "key long, lang_pred string, score double"), "languages")
    known = classes.select("h", "key").join(predicted.dropDuplicates(["key"]), "key")
    return prints.join(known, "h").select(F.col("doc").alias("doc_id"), (remainder(F.col("doc"), folds) == held).alias("held_out"), "lang_pred", "score")


def op10_piece_unigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op10_piece_unigrams": op10_piece_unigrams}
ORACLE: dict[str, str] = {}
