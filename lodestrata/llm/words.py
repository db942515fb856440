"""Words of whole texts and their hashes, for use inside Arrow tasks.

A word is a run of bytes other than ``\\x20`` and ``\\x09`` to ``\\x0D``, which is what ``bytes.split``
gives on UTF-8. Hashes are 64 bits wide and the same in every process.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

CACHE_WORDS = 50_000
_K = 0x9E3779B97F4A7C15
_K_INVERSE = pow(_K, -1, 1 << 64)


class WordHashes(dict):
    """Word to hash; forgets all once it holds ``CACHE_WORDS`` words, so memory stays bounded."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > CACHE_WORDS:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


class _Powers:
    """Powers of an odd constant modulo 2 ** 64, grown on demand."""

    def __init__(self, base: int):
        self.base, self.values = base, np.ones(1, np.uint64)

    def upto(self, n: int) -> np.ndarray:
        if len(self.values) < n:
            size = max(n, 2 * len(self.values), 4096)
            factors = np.full(size, self.base, np.uint64)
            factors[0] = 1
            self.values = np.multiply.accumulate(factors)
        return self.values[:n]


_UP, _DOWN = _Powers(_K), _Powers(_K_INVERSE)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def running(hashes: np.ndarray) -> np.ndarray:
    """Sums of ``h[j] * K ** j`` over the first i words, for :func:`spans`."""
    out = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * _UP.upto(len(hashes)), out=out[1:])
    return out


def spans(sums: np.ndarray, starts: np.ndarray, lengths: np.ndarray | int) -> np.ndarray:
    """Hashes of the word sequences that begin at ``starts``, equal where words and length are."""
    at = np.asarray(starts, np.int64)
    values = (sums[at + lengths] - sums[at]) * _DOWN.upto(len(sums))[at]
    return mixed(values ^ (np.uint64(_K) * np.asarray(lengths, np.uint64)))


def windows(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all windows of ``n`` words, by start."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    return spans(running(hashes), np.arange(len(hashes) - n + 1), n)


def covered(hits: np.ndarray, n: int, words: int) -> np.ndarray:
    """Which of ``words`` words lie in a window of ``n`` words that starts where ``hits`` is true."""
    edges = np.zeros(words + 1, np.int64)
    starts = np.flatnonzero(hits)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + n, -1)
    return np.cumsum(edges)[:words] > 0


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """The batches cut into short ones, since what is made of a text takes several times its size."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def texts(column: pa.Array) -> list[bytes]:
    """Texts as bytes, null as empty."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def long_array(values: list[np.ndarray]) -> pa.Array:
    """A list column of 64-bit integers from one array per row."""
    ends = np.cumsum([0, *map(len, values)]).astype(np.int32)
    flat = np.concatenate(values) if values else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64)))
