"""Order and prefix sums over whole tables, without one task that sees all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodestrata.sources.workspace import materialise

ROWS_PER_RANGE = 500_000


def ranges(df: DataFrame, rows: int) -> int:
    """Range partitions for ``rows`` narrow rows."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-rows // ROWS_PER_RANGE))


def prefix_sums(df: DataFrame, group: str, order: list[Column], value: str, rows: int) -> DataFrame:
    """``df`` (a written table) with ``before``: the sum of ``value`` over earlier rows of the same group.

    Rows are range-sorted by group and order, so a group with most rows is spread over many ranges.
    Each range sums its own rows per group; a window over these sums (at most one row per range and
    group) gives the offset of each range, and a window inside each range does the rest.
    """
    key = F.col(group).asc_nulls_last()
    ranged = materialise(
        df.repartitionByRange(ranges(df, rows), key, *order).withColumn("_range", F.spark_partition_id()),
        "ranges",
    )
    totals = ranged.groupBy(group, "_range").agg(F.sum(value).alias("_sum"))
    earlier = W.partitionBy(group).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(
        F.col(group).alias("_group"), F.col("_range").alias("_of"), F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset")
    )
    inside = W.partitionBy("_range", group).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return (
        ranged.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .join(offsets, F.col(group).eqNullSafe(F.col("_group")) & (F.col("_range") == F.col("_of")))
        .withColumn("before", F.col("_inside") + F.col("_offset"))
        .drop("_range", "_inside", "_group", "_of", "_offset")
    )


def lowest_hashes(df: DataFrame, rows: int, limit: int, *keys: str) -> DataFrame:
    """The ``limit`` rows of ``df`` (of ``rows`` rows) with the lowest hash of ``keys``: a bounded, stable sample.

    Rows far above the expected bound are left out before the sort, so what reaches the last task does not
    grow with the number of tasks.
    """
    value = F.xxhash64(*keys)
    if rows > 4 * limit:
        df = df.where(value < F.lit(int(-(2**63) + 2**64 * (2 * limit / rows))))
    return df.orderBy(value, *keys).limit(limit)
