"""Three incremental tables: raw documents (bronze), parsed documents (silver), chunks (gold).

Every hop is a Structured Streaming query with its own checkpoint that takes what is new and stops,
so a re-run adds only new input. Each hop is a per-row projection without state or shuffle. The
same projections serve batch jobs.
"""

from __future__ import annotations

import threading
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from lodestrata.functions.chunking import ChunkOptions, explode_chunks, with_chunks
from lodestrata.functions.elements import render_variant
from lodestrata.functions.text import file_name
from lodestrata.operators.quality import VALID_CHUNK, VALID_CHUNK_ID, VALID_CONTENT, VALID_PATH, Expectation, expect
from lodestrata.sources.documents import Parser, parse_documents
from lodestrata.sources.tables import publish_table

SILVER_SCHEMA = (
    "path string, document_name string, processed_at timestamp, elements variant, error_status variant, metadata variant"
)
GOLD_SCHEMA = (
    "path string, file_name string, processed_at timestamp, chunk_pos int, chunk_content string, "
    "chunk_section string, chunk_type string, chunk_id string"
)

COMMENTS = {
    "bronze": "raw files as they arrived",
    "silver": "documents parsed into elements",
    "gold": "chunks with content ids",
}

HAS_CHUNKS = Expectation("has_chunks", "size(chunks) > 0")


def parsed_documents(raw: DataFrame, parser: Parser, strict: bool = True) -> DataFrame:
    """Raw rows ``path, content`` -> parsed documents. Malformed parser output raises, or with
    ``strict=False`` gives NULL columns."""
    parse = "parse_json" if strict else "try_parse_json"
    parsed = parse_documents(raw.select("path", "content"), parser).selectExpr("path", f"{parse}(parsed) AS doc")
    return parsed.select(
        "path",
        file_name(F.col("path")).alias("document_name"),
        F.current_timestamp().alias("processed_at"),
        F.expr("doc:document:elements").alias("elements"),
        F.expr("doc:error_status").alias("error_status"),
        F.expr("doc:metadata").alias("metadata"),
    )


def chunk_arrays(parsed: DataFrame, options: ChunkOptions) -> DataFrame:
    """Parsed documents -> one row per document with its array of chunks, empty for a failed document."""
    rows = parsed.select(
        "path", F.col("document_name").alias("file_name"), "processed_at", render_variant("elements").alias("elements")
    )
    return with_chunks(rows, "elements", options).drop("elements")


def chunk_table(parsed: DataFrame, options: ChunkOptions) -> DataFrame:
    """Parsed documents -> one row per chunk."""
    return explode_chunks(chunk_arrays(parsed, options))


class _Counts(StreamingQueryListener):
    """Adds up observations as they come, since a query remembers its last micro-batches only."""

    WAIT_SECONDS = 60

    def __init__(self) -> None:
        self._sums: dict[str, dict[str, dict[str, int]]] = {}
        self._ended: set[str] = set()
        self._change = threading.Condition()

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        with self._change:
            sums = self._sums.setdefault(str(event.progress.runId), {})
            for name, row in event.progress.observedMetrics.items():
                own = sums.setdefault(name, {})
                for rule, n in row.asDict().items():
                    own[rule] = own.get(rule, 0) + (n or 0)

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        with self._change:
            self._ended.add(str(event.runId))
            self._change.notify_all()

    def wait_for(self, run: str) -> None:
        """Events come in order, so the end of a run means that all its counts are in."""
        with self._change:
            if not self._change.wait_for(lambda: run in self._ended, self.WAIT_SECONDS):
                raise TimeoutError(f"no end event of the streaming run {run}")

    def of(self, run: str) -> dict[str, dict[str, int]]:
        return self._sums.get(run, {})


def run_available(stream: DataFrame, path: str, checkpoint: str) -> dict[str, dict[str, int]]:
    """Write all new input of ``stream`` to a parquet table exactly once, then stop.

    Returns what the stream's observations counted, added up over all micro-batches.
    """
    counts = _Counts()
    stream.sparkSession.streams.addListener(counts)
    query = (
        stream.writeStream.format("parquet")
        .option("compression", "zstd")  # these tables hold every text once more
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    try:
        query.awaitTermination()
        counts.wait_for(str(query.runId))
    finally:
        stream.sparkSession.streams.removeListener(counts)
    return counts.of(str(query.runId))


@dataclass(frozen=True)
class Medallion:
    """Folders, parser and options of one pipeline; ``root`` lies in storage all executors share."""

    root: str
    parser: Parser
    options: ChunkOptions = field(default_factory=ChunkOptions)
    mode: str = "warn"
    strict: bool = True
    parsed_rules: tuple[Expectation, ...] = (VALID_CONTENT, VALID_PATH)
    chunk_rules: tuple[Expectation, ...] = (VALID_CHUNK, VALID_CHUNK_ID)

    def folder(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _land(self, stream: DataFrame, table: str) -> dict[str, dict[str, int]]:
        return run_available(stream, self.folder(table), self.folder(f"_checkpoints/{table}"))

    def run(self, source: DataFrame) -> dict[str, dict[str, int]]:
        """Take everything new from ``source`` (stream of ``path, content, ...``) through all hops.

        Returns the violations per expectation of this run: ``parsed_docs`` and ``chunked_docs``, and under
        ``documents`` how many of them gave no chunk.
        """
        spark = source.sparkSession
        self._land(source, "bronze")
        bronze = spark.readStream.schema(source.schema).parquet(self.folder("bronze"))
        parsed = parsed_documents(bronze, self.parser, self.strict)
        seen = self._land(expect(parsed, list(self.parsed_rules), self.mode, "parsed_docs"), "silver")
        silver = spark.readStream.schema(SILVER_SCHEMA).parquet(self.folder("silver"))
        arrays = expect(chunk_arrays(silver, self.options), [HAS_CHUNKS], "warn", "documents")
        chunks = expect(explode_chunks(arrays), list(self.chunk_rules), self.mode, "chunked_docs")
        return seen | self._land(chunks, "gold")

    def publish(self, spark: SparkSession, names: dict[str, str]) -> None:
        """Register the tables in the catalog; ``names`` maps bronze, silver and gold to table names."""
        for table, comment in COMMENTS.items():
            publish_table(spark, names[table], self.folder(table), comment, {"quality": table})

    def chunks(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(GOLD_SCHEMA).parquet(self.folder("gold"))
