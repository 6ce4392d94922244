"""Words, their hashes and sorted groups, for operators that read text inside tasks."""

from __future__ import annotations

import ctypes
import gc
import sys
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
import xxhash

CACHED_WORDS = 200_000

#: Dicts that tasks fill; they are empty again when a task ends, as its worker may then wait idle
#: or work for another operator.
CACHES: list[dict] = []


def trim() -> None:
    """Hand memory that is free but held by the allocators back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)


def freeing(task: Callable) -> Callable:
    """A generator that empties all caches at its end, as its worker may then wait idle for long."""

    @wraps(task)
    def run(*args):
        try:
            yield from task(*args)
        finally:
            for cache in CACHES:
                cache.clear()
            trim()

    return run


def ascii_words(text: str | None, lower: bool = True) -> list[bytes]:
    """Runs of bytes other than 0x20 and 0x09-0x0D, with A-Z lower-cased on demand; null has none."""
    data = (text or "").encode("utf-8", "surrogatepass")
    return (data.lower() if lower else data).split()


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_hashes = _Hashes()
CACHES.append(_hashes)


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def gram_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` words, in order."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for i in range(k):
        total = total * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + n]
    return mix(total)


def shingles(hashes: np.ndarray, k: int) -> np.ndarray:
    """The sorted distinct ``k``-word shingles; of fewer words, the whole sequence is one."""
    return np.unique(gram_hashes(hashes, min(k, len(hashes)))) if len(hashes) else np.empty(0, np.uint64)


def sorted_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """The rows of each key (an integer column), from batches in which equal keys are neighbours."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(batch.schema.get_field_index(key)).to_numpy(zero_copy_only=False)
        edges = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for a, b in zip(edges, edges[1:]):
            if held and keys[a] != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = keys[a]
    if held:
        yield pa.Table.from_batches(held)
