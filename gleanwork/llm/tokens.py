"""Byte-level words and 64-bit hashes shared by the operators that run Python inside tasks.

``bytes.lower`` folds A-Z only and ``bytes.split`` splits at exactly x09-x0D and x20, so words
taken from UTF-8 bytes are the runs ``[^\\x20\\x09-\\x0D]+`` of the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

# A worker forgets its word cache beyond this many entries; hashes never depend on the cache.
CACHED_WORDS = 300_000


class WordHashes(dict):
    """Word bytes → 64-bit hash, computed on first use; ``limit`` words are kept at most."""

    def __init__(self, limit: int = CACHED_WORDS) -> None:
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def words(text: bytes | None) -> list[bytes]:
    """Lower-cased words of a text; none for null."""
    return text.lower().split() if text else []


def mix(values: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every output bit depends on every input bit."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def seeds(count: int, seed: int) -> np.ndarray:
    """``count`` independent 64-bit constants."""
    with np.errstate(over="ignore"):
        steps = (np.arange(1, count + 1, dtype=np.uint64) + np.uint64(seed << 20)) * np.uint64(0x9E3779B97F4A7C15)
    return mix(steps)


def shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """Distinct hashes of runs of ``width`` words; a shorter sequence is one shingle of its own."""
    n = len(hashes)
    if n == 0:
        return hashes
    span = min(width, n)
    with np.errstate(over="ignore"):
        joined = np.full(n - span + 1, span, np.uint64)
        for k in range(span):
            joined = mix(joined * np.uint64(0x9E3779B97F4A7C15) + hashes[k : n - span + 1 + k])
    return np.unique(joined)


def text_bytes(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column, without decoding."""
    return column.cast(pa.binary()).to_pylist()


def slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``rows`` rows."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def text_slices(batches: Iterator[pa.RecordBatch], rows: int, size: int) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``rows`` rows whose column ``text`` has at most ``size`` bytes, or of one row."""
    for batch in slices(batches, rows):
        ends = np.cumsum(pc.binary_length(batch.column("text")).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
        start, before = 0, 0
        while start < len(ends):
            end = max(start + 1, int(np.searchsorted(ends, before + size, side="right")))
            yield batch.slice(start, end - start)
            start, before = end, int(ends[end - 1])
