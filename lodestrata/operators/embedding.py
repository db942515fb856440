"""Embedding slot: a Column function text -> array<float>, with a deterministic offline default."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestrata.functions.text import tokens

Embedder = Callable[[Column], Column]
SLICE_TEXTS = 1024  # texts counted at a time, since their tokens take several times the vectors


def hashing_embedder(dim: int = 256) -> Embedder:
    """Token counts by hashed token: component ``int(md5(token)[:8], 16) % dim``.

    Counts are kept as they are; search divides by the norms. Runs once per Arrow batch, in slices, and hashes
    each distinct token of a slice once.
    """

    def counts(lists: pa.Array) -> np.ndarray:
        words = lists.flatten().dictionary_encode()
        slots = np.array(
            [int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % dim for w in words.dictionary.to_pylist()],
            dtype=np.int64,
        )
        lengths = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        rows = np.repeat(np.arange(len(lists), dtype=np.int64), lengths)
        cells = rows * dim + slots[words.indices.to_numpy()] if len(words) else np.zeros(0, np.int64)
        return np.bincount(cells, minlength=len(lists) * dim)

    def count_tokens(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for lists in batches:
            vectors = np.zeros(len(lists) * dim, np.float32)
            for at in range(0, len(lists), SLICE_TEXTS):
                some = counts(lists.slice(at, SLICE_TEXTS))
                vectors[at * dim : at * dim + len(some)] = some
            offsets = np.arange(0, (len(lists) + 1) * dim, dim, dtype=np.int32)
            yield pa.ListArray.from_arrays(pa.array(offsets), pa.array(vectors))

    as_column = F.arrow_udf(count_tokens, T.ArrayType(T.FloatType()))
    return lambda text: as_column(F.coalesce(tokens(text), F.array().cast("array<string>")))


def embed(df: DataFrame, text: str, embedder: Embedder, into: str = "embedding") -> DataFrame:
    return df.withColumn(into, embedder(F.col(text)))
