"""Binary files as a batch or as an incremental stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def raw_files(spark: SparkSession, folder: str, glob: str = "*.pdf") -> DataFrame:
    """All files below ``folder`` that match ``glob``."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .load(folder)
    )


def stream_raw_files(
    spark: SparkSession, folder: str, glob: str = "*.pdf", max_files: int | None = None
) -> DataFrame:
    """The same as a stream: each new file once, stamped on arrival; ``max_files`` per micro-batch."""
    reader = (
        spark.readStream.format("binaryFile")
        .schema(FILE_SCHEMA)
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
    )
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(folder).withColumn("processing_timestamp", F.current_timestamp())
