"""Physical layout of written tables: clustering by key and compaction of small files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

PREFIX = 2
CLUSTER = ["chunk_id", "path", "chunk_pos"]


def cluster(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Range-partition and sort so that files cover disjoint key ranges and min/max skipping works.

    Place columns follow the key: copies of one text, however many, still spread over files.
    """
    columns = columns or CLUSTER
    return df.repartitionByRange(*columns).sortWithinPartitions(*columns)


def compact(spark: SparkSession, source: str, target: str, columns: list[str] | None = None) -> DataFrame:
    """Rewrite a table folder into few, clustered files in another folder."""
    cluster(spark.read.parquet(source), columns).write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)


def layout_stats(table: DataFrame, key: str = "chunk_id") -> DataFrame:
    """Rows and key range per written file."""
    return table.groupBy(F.col("_metadata.file_name").alias("file")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min(key).alias("min_key"), F.max(key).alias("max_key")
    )


def layout_report(stats: DataFrame) -> DataFrame:
    """``n_rows, overlaps``: rows in all files, and files that reach into the key range of the next one.

    Files are compared within groups of one key prefix (at most 256 for hashed keys), so no task sees
    all of them; the last file of a group is compared with the first one of the next group.
    """
    grouped = stats.withColumn("_group", F.substring(F.col("min_key").cast("string"), 1, PREFIX))
    order = W.partitionBy("_group").orderBy("min_key", "max_key")
    inside = grouped.withColumn("_reaches", F.col("max_key") > F.lead("min_key").over(order))
    groups = inside.groupBy("_group").agg(
        F.sum("n_rows").alias("n_rows"),
        F.count_if("_reaches").alias("inside"),
        F.min("min_key").alias("first"),
        F.max(F.struct("min_key", "max_key")).alias("last"),
    )
    across = F.col("last.max_key") > F.lead("first").over(W.orderBy("first"))  # one row per group
    return groups.withColumn("_across", across).agg(
        F.sum("n_rows").alias("n_rows"), (F.sum("inside") + F.count_if("_across")).alias("overlaps")
    )
