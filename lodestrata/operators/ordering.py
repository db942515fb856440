"""Exact row positions without a single-task sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BUCKET_DIGITS = 4  # hex digits of the hash that name a bucket: at most 65 536 buckets


def seeded_hash(key: str, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")).cast("binary"))


def hash_positions(df: DataFrame, key: str, seed: int = 0) -> DataFrame:
    """Add ``position`` (from 0) in the order of ``md5(seed:key)`` and ``total`` (row count).

    A seeded shuffle that every engine can repeat. Rows are bucketed by the first hash digits, which
    spreads unique keys evenly; the bucket sizes, at most 65 536 rows, give each bucket's offset.
    """
    hashed = df.withColumn("_hash", seeded_hash(key, seed))
    hashed = hashed.withColumn("_bucket", F.substring("_hash", 1, BUCKET_DIGITS))
    sizes = hashed.groupBy("_bucket").agg(F.count("*").alias("_n"))
    before = W.orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(
        "_bucket",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"),
        F.sum("_n").over(W.partitionBy()).alias("total"),
    )
    inside = W.partitionBy("_bucket").orderBy("_hash", key)
    return (
        hashed.withColumn("_at", F.row_number().over(inside))
        .join(F.broadcast(offsets), "_bucket")  # at most 65 536 rows, see BUCKET_DIGITS
        .withColumn("position", F.col("_offset") + F.col("_at") - 1)
        .drop("_hash", "_bucket", "_offset", "_at")
    )


def best_per_group(df: DataFrame, group: list[str], order: list[Column], n: int, into: str = "rank") -> DataFrame:
    """First ``n`` rows per group with their rank from 1.

    The rank filter sits right on the window, so each task keeps only ``n`` rows per group before
    the shuffle; a group that holds most of the rows stays cheap.
    """
    ranked = df.withColumn(into, F.row_number().over(W.partitionBy(*group).orderBy(*order)))
    return ranked.filter(F.col(into) <= n)
