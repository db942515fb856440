"""Streaming index sync: each new batch of chunk rows adds its unseen texts to the index."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lodestrata.operators.embedding import Embedder
from lodestrata.operators.index import (
    append_index,
    claim_batch,
    current_index,
    embed_index,
    index_rows,
    last_batch,
    write_inserts,
)
from lodestrata.streaming.medallion import GOLD_SCHEMA


def stream_chunk_rows(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(GOLD_SCHEMA)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(folder)


def sync_stream(chunks: DataFrame, root: str, embedder: Embedder, checkpoint: str, writer: str = "stream") -> DataFrame:
    """Bring the index at ``root`` up to date with a chunk stream, then stop; returns the live rows.

    A micro-batch claims the next batch number of the index under ``writer`` and its own id, so a repeated
    micro-batch replaces its own rows and syncs in between keep theirs. Streams into one index need
    different writers. Without an index the stream creates it.
    """

    def add(rows: DataFrame, micro_batch: int) -> None:
        spark = rows.sparkSession
        batch = claim_batch(spark, root, writer, str(micro_batch))
        if last_batch(spark, root) in (None, 0) and batch == 0:
            write_inserts(embed_index(index_rows(rows), embedder), root, 0)
        else:
            append_index(spark, root, rows, embedder, batch)

    (
        chunks.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return current_index(chunks.sparkSession, root)
