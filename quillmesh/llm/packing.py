"""Harmonic packing of token sequences (operator 2).

A document is cut into full sequences, pieces of half, a quarter, ... of the capacity, and a last
piece; a piece of length n is of class ``capacity // n``, and a bin of class j takes j pieces. Each
worker fills its bins alone. What is left open (fewer than j pieces for each class and worker) is
packed again by groups of workers, first by class and at last by best fit.
"""

from __future__ import annotations

import base64
import bisect
import itertools
import json
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmesh.llm.words import CACHES, freeing
from quillmesh.storage import materialize

CAPACITY = 2048
#: Documents aren't cut into pieces shorter than this.
GRAIN = 64
#: So many workers' open bins are packed together.
WORKERS_TOGETHER = 64
#: The id that ends each document.
END_ID = 1
CACHED_WORDS = 150_000
LONG_WORD = 1000
# fixed values: white space other than the space and the newline
ODD_SPACES = "\t\v\f\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, class int, worker int, open boolean"


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class _Words(dict):
    """Ids of words as little-endian 32-bit bytes, kept until there are too many."""

    def __init__(self, prefix: str, encode):
        super().__init__()
        self.prefix, self.encode = prefix, encode
        CACHES.append(self)

    def __missing__(self, word: str) -> bytes:
        if len(self) >= CACHED_WORDS:
            self.clear()
        ids = self[word] = self.encode(self.prefix + word)
        return ids


class Encoder:
    """Byte-level BPE ids of whole texts as bytes.

    Words between single spaces and newlines are pretokens of their own, so their ids are looked
    up; other texts are encoded whole. Both give the ids that the vocabulary file gives by
    ``tokenizers``, which itself encodes texts with a special token's string and very long words.
    """

    def __init__(self, vocabulary_json: str, ranks: str):
        import public_tokenizers
        import tiktoken

        with open(ranks, "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.vocabulary_json, self.slow = vocabulary_json, None
        with open(vocabulary_json, encoding="utf-8") as f:
            self.special = [t["content"] for t in json.load(f)["added_tokens"]]
        self.quick = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
        self.first, self.later = _Words("", self._word), _Words(" ", self._word)
        self.newline = self._bytes([table[b"\n"]])

    @staticmethod
    def _bytes(ids: list[int]) -> bytes:
        return b"".join(i.to_bytes(4, "little") for i in ids)

    def _exact(self, text: str) -> bytes:
        if self.slow is None:
            from tokenizers import Tokenizer

            self.slow = Tokenizer.from_file(self.vocabulary_json)
        return self._bytes(self.slow.encode(text, add_special_tokens=False).ids)

    def _word(self, word: str) -> bytes:
        return self._exact(word) if len(word) > LONG_WORD else self._bytes(self.quick.encode_ordinary(word))

    def _by_words(self, text: str) -> bytes | None:
        """Of a text whose words have one space or newline between them and no other white space; else None."""
        if any(w in text for w in ODD_SPACES):
            return None
        out = []
        for k, line in enumerate(text.split("\n")):
            parts = line.split(" ")
            if "" in parts:
                return None
            if k:
                out.append(self.newline)
            out.append(self.first[parts[0]])
            out.extend(map(self.later.__getitem__, parts[1:]))
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            return self._exact(text)
        known = self._by_words(text)
        if known is not None:
            return known
        longest = max(map(len, text.split()), default=0)
        odd_space = len(text) - sum(map(len, text.split())) > len(text) // 2
        return self._exact(text) if longest > LONG_WORD or odd_space else self._bytes(self.quick.encode_ordinary(text))


_encoders: dict[tuple[str, str], Encoder] = {}


def encoder(vocabulary_json: str, ranks: str) -> Encoder:
    key = (vocabulary_json, ranks)
    if key not in _encoders:
        _encoders[key] = Encoder(*key)
    return _encoders[key]


def cut(length: int, capacity: int = CAPACITY, grain: int = GRAIN) -> list[int]:
    """Piece lengths: full sequences, halves, quarters, ..., and a last piece shorter than two grains.
    A short rest takes a full sequence with it, so that no piece of a longer text is below a grain."""
    full, rest = divmod(length, capacity)
    if full and 0 < rest < grain:
        full, rest = full - 1, rest + capacity
    pieces, size = [capacity] * full, capacity // 2
    while size >= grain:
        if rest == size or rest - size >= grain:
            pieces.append(size)
            rest -= size
        size //= 2
    return pieces + [rest] * (rest > 0)


@freeing
def _pack_partition(batches: Iterator[pa.RecordBatch], capacity: int, grain: int, vocabulary_json: str, ranks: str) -> Iterator[pa.RecordBatch]:
    encode, worker = encoder(vocabulary_json, ranks).encode, TaskContext.get().partitionId()
    names = [x.split()[0] for x in PIECES.split(", ")]
    kinds = [pa.int64()] * 7 + [pa.int32()] * 2 + [pa.bool_()]
    bins: dict[int, list] = {}
    closed = 0

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) if rows else [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    end, rows = END_ID.to_bytes(4, "little"), []
    for b in batches:
        for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
            ids = encode(text.as_py() or "") + end
            total, start = len(ids) // 4, 0
            for n in cut(total, capacity, grain):
                j, crc = capacity // n, zlib.crc32(ids[4 * start : 4 * (start + n)])
                held = bins.setdefault(j, [])
                held.append((doc_id, start, n, crc, total))
                start += n
                if len(held) == j:
                    rows.extend(_placed(held, (worker << 32) + closed, j, worker, False))
                    closed += 1
                    held.clear()
            if len(rows) >= 20_000:
                yield batch(rows)
                rows = []
    for j, held in bins.items():
        rows.extend(_placed(held, -1, j, worker, True))
    yield batch(rows)


def _placed(held: list[tuple], sequence: int, j: int, worker: int, is_open: bool) -> Iterator[tuple]:
    at = itertools.accumulate((x[2] for x in held), initial=0)
    return ((*piece, sequence, offset, j, worker, is_open) for piece, offset in zip(held, at))


def _pack_rest(capacity: int):
    def pack(left: pd.DataFrame) -> pd.DataFrame:
        """Open pieces of some workers: full bins by class, then best fit of the longest first."""
        left = left.sort_values(["length", "doc_id", "start"], ascending=[False, True, True], kind="stable").reset_index(drop=True)
        nth = left.groupby("class").cumcount()
        size = left.groupby("class")["length"].transform("size")
        sequence, offset, used = [0] * len(left), [0] * len(left), []
        free: list[tuple[int, int]] = []  # free tokens and number of each open bin, in order
        whole: dict[tuple[int, int], int] = {}
        for i, (j, k, total, n) in enumerate(zip(left["class"], nth, size, left["length"])):
            if k // j < total // j:
                s = whole.setdefault((j, k // j), len(used))
                if s == len(used):
                    used.append(0)
            else:
                at = bisect.bisect_left(free, (n, -1))
                s = free.pop(at)[1] if at < len(free) else len(used)
                if s == len(used):
                    used.append(0)
                bisect.insort(free, (capacity - used[s] - n, s))
            sequence[i], offset[i] = s, used[s]
            used[s] += n
        group = int(left["worker"].iloc[0]) // WORKERS_TOGETHER
        left["sequence_id"] = [(1 << 62) + (group << 32) + s for s in sequence]
        left["offset"] = offset
        return left

    return pack


def pack_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    grain: int = GRAIN,
    vocabulary_json: str | None = None,
    ranks: str | None = None,
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, class``.

    * A null or empty text is the end id alone; a null id stays null; repeated rows are packed as
      often as they occur; an empty table gives no piece.
    * ``capacity`` must be a power of two, ``grain`` at most half of it.
    * The files' paths are parameters; workers need them at the same path.
    """
    json_path = vocabulary_json or vocabulary("byte_bpe_50k.json")
    ranks_path = ranks or vocabulary("byte_bpe_50k.tiktoken")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    pieces = materialize(rows.mapInArrow(lambda b: _pack_partition(b, capacity, grain, json_path, ranks_path), PIECES), "pieces")
    rest = (
        pieces.where("open")
        .withColumn("together", F.floor(F.col("worker") / WORKERS_TOGETHER))
        .groupBy("together")
        .applyInPandas(lambda pdf: _pack_rest(capacity)(pdf.drop(columns="together")), PIECES)
    )
    return pieces.where("NOT open").unionByName(rest).drop("worker", "open")


def op2_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op2_harmonic_packing": op2_harmonic_packing}
ORACLE: dict[str, str] = {}
