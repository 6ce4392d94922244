"""Terms of texts by Arrow kernels: lower-cased, split, flattened and dictionary-encoded in whole columns."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts of about so many bytes (or one longer text) are split together.
BYTES_TOGETHER = 4 << 20
#: A task adds up so many partial counts before it hands them on.
HELD_ROWS = 400_000


def slices(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """Batches in parts whose texts (at ``column``) have about BYTES_TOGETHER bytes."""
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column(column)).fill_null(0).to_numpy(), dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            before = int(ends[at - 1]) if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + BYTES_TOGETHER, side="right")))
            yield batch.slice(at, to - at)
            at = to


def split_terms(texts: pa.Array, separators: str) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Row and dictionary index of every term of the texts, in order, and the dictionary. A-Z are
    lower-cased; what ``separators`` matches lies between terms; null has none."""
    return _coded_lists(pc.split_pattern_regex(pc.ascii_lower(texts.fill_null("")), pattern=separators))


def letter_terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """``split_terms`` where terms are runs of letters and non-ASCII signs: bytes are mapped in one go
    over the whole column, so that a plain split by white space is left."""
    texts = texts.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = (texts.buffers()[2] or pa.py_buffer(b"")).slice(int(offsets[0]), int(offsets[-1] - offsets[0])).to_pybytes()
    mapped = pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(np.ascontiguousarray(offsets - offsets[0])), pa.py_buffer(data.translate(_LETTERS)))
    return _coded_lists(pc.ascii_split_whitespace(mapped))


#: A-Z to a-z, other ASCII than letters to spaces.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))


def _coded_lists(lists: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    words = pc.list_flatten(lists).dictionary_encode()
    row, index = pc.list_parent_indices(lists).to_numpy().astype(np.int64), words.indices.to_numpy().astype(np.int64)
    empty = pc.index(words.dictionary, pa.scalar("", words.dictionary.type)).as_py()
    if empty >= 0:
        some = index != empty
        row, index = row[some], index[some]
    return row, index, words.dictionary


def distinct_pairs(row: np.ndarray, index: np.ndarray, rows: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The different (row, index) pairs, ordered by row."""
    if rows * size <= 16 * len(row) + 1024:
        met = np.zeros(rows * size, bool)
        met[row * size + index] = True
        code = np.flatnonzero(met)
    else:
        code = np.unique(row * size + index)
    return code // max(size, 1), code % max(size, 1)


def summed(batches: Iterator[pa.RecordBatch], keys: list[str], value: str) -> Iterator[pa.RecordBatch]:
    """Partial sums of ``value`` by ``keys``: one row a key and task as long as the task's keys are few."""
    held: list[pa.Table] = []
    rows = 0
    for batch in batches:
        held.append(pa.Table.from_batches([batch]))
        rows += batch.num_rows
        if rows > HELD_ROWS:
            total = _sum(held, keys, value)
            held, rows = [total], total.num_rows
            if rows > HELD_ROWS // 2:
                yield from total.to_batches()
                held, rows = [], 0
    if rows:
        yield from _sum(held, keys, value).to_batches()


def _sum(tables: list[pa.Table], keys: list[str], value: str) -> pa.Table:
    total = pa.concat_tables(tables).group_by(keys, use_threads=False).aggregate([(value, "sum")])
    return total.rename_columns([*keys, value] if total.column_names[-1] == f"{value}_sum" else [value, *keys]).select([*keys, value]).combine_chunks()
