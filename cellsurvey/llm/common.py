"""Helpers shared by the training-data operators: words, hashes, slices of Arrow batches."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WHITE = r"[\x20\x09-\x0D]+"  # what separates words
_CACHED_WORDS = 200_000  # entries of a worker's word table before it starts afresh
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """64-bit hash of a word, remembered per task."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: Sequence[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n consecutive words; a shorter, not empty text is one shingle."""
    n = min(n, len(hashes))
    if n == 0:
        return hashes
    size = len(hashes) - n + 1
    out = hashes[:size]
    for i in range(1, n):
        out = mixed(out * _MULTIPLIER + hashes[i : i + size])
    return mixed(out + np.uint64(n))


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that Python objects exist for few texts at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def release_memory() -> None:
    """Give what earlier work of this reused worker has freed back to the machine; pools and arenas would keep it for themselves."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def raw(column: pa.Array) -> list[bytes | None]:
    """UTF-8 of a text column."""
    return column.cast(pa.binary()).to_pylist()


def words_of(text: Column) -> Column:
    """Words between white space, natively; NULL has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WHITE), lambda w: w != "")


def joined_ids(ids: Column) -> Column:
    return F.concat_ws(",", ids)


def own_columns(df: DataFrame, *names: str) -> DataFrame:
    """Only the columns an operator reads, so that further ones cannot clash with its own."""
    return df.select(*[F.col(f"`{n}`") for n in names])
