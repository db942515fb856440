"""Changed and removed documents, from a source folder to the index.

A file stream takes each path once, so it sees neither a changed nor a removed file. Here a scan compares the source with
what was recorded last and appends versions - new, changed and removed paths - to a log, and streams with keyed state
carry them on:

1. :func:`record_versions` / :func:`scan_folder`: source -> ``<root>/scan=<n>``, one row per path that changed.
2. :func:`chunk_changes`, state by path: version of a document -> chunks that it gained and lost. The state holds the
   places and ids of the last version, not texts.
3. :func:`index_changes`, state by chunk id: gained and lost places of a text -> ``insert``, ``update`` (another
   lowest place) or ``delete`` of its key. The lowest places of a text stand with its id; further ones are entries of a map
   state, each a row of its own in the state store, so a text that many documents share does not make a state large.

Every key that Python handles costs several calls to the state store and a batch of output of its own, about a millisecond.
So a key here is one of ``BUCKETS`` buckets of paths or chunk ids, whose states are read and written with one call.

What a micro-batch costs grows with what changed; neither the documents nor the index are read again. State is kept by RocksDB, in
the checkpoint. A repeated micro-batch starts from the state before it, so nothing is counted twice. Versions of a path that
arrive late (a lower scan than the last one seen) are left out.
"""

from __future__ import annotations

from bisect import insort
from collections.abc import Iterator
from contextlib import contextmanager
from heapq import nsmallest

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from lodestrata.operators.embedding import Embedder
from lodestrata.operators.index import PLACE, apply_changes, claim_batch, current_index, listed
from lodestrata.sources.files import raw_files
from lodestrata.sources.workspace import materialise

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

BUCKETS = 1 << 16  # part of the state's layout: another number needs new checkpoints
LOWEST = 8  # places that stand with a text's id

_FIELDS = "chunk_pos:int,chunk_section:string,chunk_type:string"
_PLACE = "path string, chunk_pos int, chunk_section string, chunk_type string"
OCCURRENCES = f"chunk_id string, {_PLACE}, chunk_content string, version long, present boolean"
INDEX_CHANGES = f"chunk_id string, change string, {_PLACE}, chunk_content string"


@contextmanager
def keyed_state(spark: SparkSession):
    """Queries that start inside keep their state in RocksDB."""
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before)


# --- versions of a source ------------------------------------------------------------------------


def record_versions(snapshot: DataFrame, root: str) -> int:
    """Append what changed between the recorded versions and ``snapshot`` (``path``, ``fingerprint``, any columns).

    Paths are unique. A path whose fingerprint is new gets its row, a path that is gone one with ``present`` false
    and nulls. Returns the number of the last scan that recorded anything; each writes its own folder.
    """
    scan = _next_scan(snapshot.sparkSession, root)
    changed = _changed(snapshot.select("path", "fingerprint"), root, scan)
    return _record(snapshot, changed, root, scan)


def _next_scan(spark: SparkSession, root: str) -> int:
    return 1 + max((int(n.removeprefix("scan=")) for n in listed(spark, root) if n.startswith("scan=")), default=-1)


def _record(snapshot: DataFrame, changed: DataFrame, root: str, scan: int) -> int:
    if scan and changed.isEmpty():
        return scan - 1
    rows = snapshot.join(changed.where("present").select("path"), "path", "left_semi").withColumn("present", F.lit(True))
    gone = changed.where("NOT present").select("path", "present")
    rows.unionByName(gone, allowMissingColumns=True).write.mode("overwrite").parquet(f"{root}/scan={scan}")
    return scan


def _changed(now: DataFrame, root: str, scan: int) -> DataFrame:
    """``path, present`` of the paths that differ from their last recorded version."""
    if scan == 0:
        return now.select("path", F.lit(True).alias("present"))
    log = now.sparkSession.read.parquet(root).select("path", "scan", "present", "fingerprint").where(F.col("scan") < scan)
    last = log.groupBy("path").agg(F.max(F.struct("scan", "present", "fingerprint")).alias("last")).where("last.present")
    both = now.withColumnRenamed("fingerprint", "_now").join(last.select("path", F.col("last.fingerprint").alias("_last")), "path", "full")
    return materialise(both.where(~F.col("_now").eqNullSafe(F.col("_last"))).select("path", F.col("_now").isNotNull().alias("present")), "changed")


def scan_folder(spark: SparkSession, folder: str, root: str, glob: str = "*.pdf") -> int:
    """Record the versions of the files below ``folder``; a file is another version when its time or length is.

    The listing reads no contents. Contents are read of files not older than the oldest changed one, a filter that
    the file source applies before it opens a file.
    """
    files = raw_files(spark, folder, glob)
    fingerprint = F.concat_ws(":", F.unix_micros("modificationTime").cast("string"), F.col("length").cast("string"))
    names = files.select("path", "modificationTime", fingerprint.alias("fingerprint"))
    scan = _next_scan(spark, root)
    changed = _changed(names.select("path", "fingerprint"), root, scan)
    since = names.join(changed.where("present"), "path", "left_semi").agg(F.min("modificationTime")).first()[0]
    full = files.withColumn("fingerprint", fingerprint)
    recent = full.where(F.col("modificationTime") >= F.lit(since)) if since is not None else full.limit(0)
    return _record(recent, changed, root, scan)


def version_stream(spark: SparkSession, root: str, schema: str, max_files: int | None = None) -> DataFrame:
    """The log as a stream; ``schema`` names the recorded columns. ``version`` is the scan."""
    reader = spark.readStream.schema(f"{schema}, present boolean, scan int")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(root).withColumn("version", F.col("scan").cast("long")).drop("scan")


# --- state by path -------------------------------------------------------------------------------


def _bucket(column: str) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(BUCKETS)).cast("int")


class _DocumentChunks(StatefulProcessor):
    """The chunks of the last version of each path in a bucket, without texts."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        chunks = f"array<struct<chunk_id:string,{_FIELDS}>>"
        self.last = handle.getValueState("last", f"documents array<struct<path:string,version:bigint,chunks:{chunks}>>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        newest = {}
        for row in rows:
            if row["path"] not in newest or row["version"] > newest[row["path"]]["version"]:
                newest[row["path"]] = row
        held = self.last.get()
        known = {d[0]: (d[1], d[2]) for d in held[0]} if held else {}
        changed = False
        for path, row in newest.items():
            version, chunks = known.get(path, (None, []))
            if version is not None and row["version"] <= version:
                continue
            old = {tuple(c) for c in chunks}
            texts = {(c["chunk_id"], c["chunk_pos"], c["chunk_section"], c["chunk_type"]): c["chunk_content"] for c in row["chunks"] or []}
            known[path], changed = (row["version"], list(texts)), True
            for chunk in old - texts.keys():
                yield Row(chunk_id=chunk[0], path=path, **_place(chunk), chunk_content=None, version=row["version"], present=False)
            for chunk in texts.keys() - old:
                yield Row(chunk_id=chunk[0], path=path, **_place(chunk), chunk_content=texts[chunk], version=row["version"], present=True)
        if changed:
            self.last.update(([(path, version, [tuple(c) for c in chunks]) for path, (version, chunks) in known.items()],))

    def close(self) -> None:
        pass


def _place(chunk: tuple) -> dict:
    return {"chunk_pos": chunk[1], "chunk_section": chunk[2], "chunk_type": chunk[3]}


def numbered_chunks(chunks: Column) -> Column:
    """Chunks of a document with their place and content id."""
    return F.transform(
        chunks,
        lambda c, i: F.struct(
            F.md5(c["content"].cast("binary")).alias("chunk_id"),
            i.alias("chunk_pos"),
            c["section"].alias("chunk_section"),
            c["chunk_type"].alias("chunk_type"),
            c["content"].alias("chunk_content"),
        ),
    )


def chunk_changes(documents: DataFrame) -> DataFrame:
    """A stream of ``path, version, present, chunks`` -> the chunks that each version gained and lost."""
    rows = documents.select("path", "version", F.when(F.col("present"), numbered_chunks(F.col("chunks"))).alias("chunks"))
    return rows.withColumn("bucket", _bucket("path")).groupBy("bucket").transformWithState(_DocumentChunks(), OCCURRENCES, "Append", "None")


def live_chunks(changes: DataFrame) -> DataFrame:
    """The chunk table of the last versions, from the table that :func:`chunk_changes` was written to."""
    place = ["chunk_id", "path", "chunk_pos", "chunk_section", "chunk_type"]
    last = changes.groupBy(*place).agg(F.max(F.struct("version", "present", "chunk_content")).alias("last"))
    return last.where("last.present").select(*place, "last.chunk_content")


# --- state by chunk id ---------------------------------------------------------------------------


def _order(place: tuple) -> tuple:
    """Places in Spark's order: nulls first, then by value."""
    return tuple((x is not None, x) if x is not None else (False,) for x in place)


class _ChunkPlaces(StatefulProcessor):
    """All places of each text in a bucket: the lowest ones with its id, further ones, which lie above them, in a map."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        place = f"path:string,{_FIELDS}"
        self.texts = handle.getValueState("texts", f"texts array<struct<chunk_id:string,places:array<struct<{place}>>,further:bigint>>")
        self.further = handle.getMapState("further", f"chunk_id string, {_PLACE}", "held boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        came, content = {}, {}
        for row in rows:
            chunk = row["chunk_id"]
            came.setdefault(chunk, []).append((row["version"], row["present"], tuple(row[c] for c in PLACE)))
            if row["present"]:
                content.setdefault(chunk, row["chunk_content"])  # equal ids have equal text
        held = self.texts.get()
        texts = {t[0]: ([tuple(p) for p in t[1]], t[2]) for t in held[0]} if held else {}
        for chunk, events in came.items():
            places, further = texts.pop(chunk, ([], 0))
            before = places[0] if places else None
            for _, present, place in sorted(events, key=lambda e: e[:2]):
                further = (self._add if present else self._remove)(chunk, places, further, place)
            after = places[0] if places else None
            if after is not None:
                texts[chunk] = (places, further)
            if after != before:
                change = "insert" if before is None else "delete" if after is None else "update"
                place = dict(zip(PLACE, after or (None,) * len(PLACE)))
                yield Row(chunk_id=chunk, change=change, **place, chunk_content=content.get(chunk) if change == "insert" else None)
        if texts:
            self.texts.update(([(chunk, places, further) for chunk, (places, further) in texts.items()],))
        elif held:
            self.texts.clear()

    def _add(self, chunk: str, places: list[tuple], further: int, place: tuple) -> int:
        """Add a place; returns the number of further ones."""
        if place in places:
            return further
        if not further and len(places) < LOWEST or places and _order(place) < _order(places[-1]):
            insort(places, place, key=_order)
            if len(places) <= LOWEST:
                return further
            place = places.pop()
        elif further and self.further.containsKey((chunk, *place)):
            return further
        self.further.updateValue((chunk, *place), (True,))
        return further + 1

    def _remove(self, chunk: str, places: list[tuple], further: int, place: tuple) -> int:
        """Remove a place, if it is there; returns the number of further ones."""
        if place in places:
            places.remove(place)
            if not places and further:
                own = (tuple(k)[1:] for k in self.further.keys() if k[0] == chunk)
                places += nsmallest(LOWEST, own, key=_order)
                for p in places:
                    self.further.removeKey((chunk, *p))
                return further - len(places)
        elif further and self.further.containsKey((chunk, *place)):
            self.further.removeKey((chunk, *place))
            return further - 1
        return further

    def close(self) -> None:
        pass


def index_changes(occurrences: DataFrame) -> DataFrame:
    """A stream of gained and lost chunks -> what changes in the index, one row per key at most."""
    return occurrences.withColumn("bucket", _bucket("chunk_id")).groupBy("bucket").transformWithState(_ChunkPlaces(), INDEX_CHANGES, "Append", "None")


def occurrence_stream(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(OCCURRENCES)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(folder)


def sync_changes(occurrences: DataFrame, root: str, embedder: Embedder, checkpoint: str, writer: str = "changes") -> DataFrame:
    """Bring the index at ``root`` in step with a stream of gained and lost chunks, then stop; returns the live rows.

    Only inserted texts are embedded; an updated row keeps its vector. A micro-batch has its own batch number, so a
    repeated one replaces its rows. The index must hold nothing but what came this way.
    """

    def add(rows: DataFrame, micro_batch: int) -> None:
        spark = rows.sparkSession
        changes = materialise(rows, "changes")  # the state advances once, however often the rows are read
        if not changes.isEmpty():
            apply_changes(changes, root, embedder, claim_batch(spark, root, writer, str(micro_batch)))

    with keyed_state(occurrences.sparkSession):
        query = (
            index_changes(occurrences).writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )
    query.awaitTermination()
    return current_index(occurrences.sparkSession, root)

