"""Joins of a large table with one that may be small: broadcast only after a check of its size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 32 << 20


def joined(
    large: DataFrame, small: DataFrame, on: Column | str | list[str], how: str, row_bytes: int, limit: int = BROADCAST_BYTES
) -> DataFrame:
    """Join; ``small`` is a written table with rows of at most about ``row_bytes``.

    Within ``limit`` it is broadcast and ``large`` stays where it is; beyond, both sides are shuffled
    and Spark splits skewed partitions. The rows are the same.
    """
    if small.count() * row_bytes <= limit:
        small = F.broadcast(small)
    return large.join(small, on, how)
