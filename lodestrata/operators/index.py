"""Keyed vector index over a chunk table: build, diff, sync, statistics.

An index is a folder of parquet change rows, ``<root>/batch=<n>/op=<op>``; ``op`` is ``insert`` (a key that
was not live), ``update`` or ``delete``. A batch writes only what changed, in a directory of its own, so
repeating it after a failure overwrites that directory and changes nothing else. A row is live unless
a later batch updates or deletes its key; an index that only grew is read without any join.

Batch numbers come from one sequence for all writers. A file in ``<root>/_claims`` records which
number a writer's step has, before it writes, so a repeated step finds its own number and no
writer gets another's. Writers take turns; two at the same moment need a lock outside.

A rebuild writes all rows as ``op=rebuilt`` of a new batch and then a marker, ``op=reset``. Until the marker
stands, readers see the old index; from then on, nothing before it.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.operators.embedding import Embedder, embed
from lodestrata.operators.layout import cluster
from lodestrata.sources.workspace import materialise

KEY = "chunk_id"
PLACE = ["path", "chunk_pos", "chunk_section", "chunk_type"]
ROW = [KEY, *PLACE, "chunk_content"]
CODEC = "zstd"  # texts and vectors make up most of what is written
SCHEMA = (
    "chunk_id string, path string, chunk_pos int, chunk_section string, chunk_type string, "
    "chunk_content string, embedding array<float>, batch int, op string"
)


def index_rows(chunks: DataFrame) -> DataFrame:
    """One row per chunk id: the copy with the lowest path, then the lowest position.

    An aggregate, not a window: copies of one text are reduced in the map tasks, so a text that
    makes up much of the table does not meet in one task.
    """
    return (
        chunks.groupBy(KEY)
        .agg(
            F.min(F.struct(*PLACE)).alias("_place"),
            F.first("chunk_content").alias("chunk_content"),  # equal ids have equal text
        )
        .select(KEY, *[F.col(f"_place.{c}").alias(c) for c in PLACE], "chunk_content")
    )


def embed_index(rows: DataFrame, embedder: Embedder) -> DataFrame:
    return embed(rows, "chunk_content", embedder)


def write_inserts(rows: DataFrame, root: str, batch: int, mode: str = "overwrite") -> None:
    """Write embedded rows with new keys as batch ``batch``; writing the same batch again replaces it."""
    rows.select(*ROW, "embedding").write.mode(mode).parquet(f"{root}/batch={batch}/op=insert", compression=CODEC)


def build_index(chunks: DataFrame, embedder: Embedder, root: str) -> None:
    """Create the index as batch 0; fails if it exists (see :func:`rebuild_index`)."""
    if last_batch(chunks.sparkSession, root) is not None:
        raise ValueError(f"there is an index at {root}")
    write_inserts(embed_index(index_rows(chunks), embedder), root, 0, mode="error")


def rebuild_index(chunks: DataFrame, embedder: Embedder, root: str) -> None:
    """Build the index at ``root`` again; the old one stays readable until the new one is complete."""
    spark = chunks.sparkSession
    batch = claim_batch(spark, root, "rebuild", uuid.uuid4().hex)
    rows = embed_index(index_rows(chunks), embedder).select(*ROW, "embedding")
    rows.write.mode("overwrite").parquet(f"{root}/batch={batch}/op=rebuilt")
    marker = spark.createDataFrame([(None,)], "chunk_id string")
    marker.write.mode("overwrite").parquet(f"{root}/batch={batch}/op=reset")


def read_log(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(root)


def _found(read) -> object | None:
    """The result of ``read``, None where the path does not exist; other failures are raised."""
    try:
        return read()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def listed(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, none if there is no such folder; asked of the file system, without a job."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [f.getPath().getName() for f in files.listStatus(path)] if files.exists(path) else []


def claim_batch(spark: SparkSession, root: str, writer: str, step: str) -> int:
    """The batch number of a writer's step: the one it has, or the next free one, recorded first.

    A claim is an empty file ``_claims/<batch>.<writer>.<step>``. A writer repeats its last step only, so its older
    claims are removed as it goes on; there is about one file per writer.
    """
    claims = [name.split(".", 2) for name in listed(spark, f"{root}/_claims") if name.count(".") >= 2 and name[0].isdigit()]
    own = [(int(batch), step_) for batch, writer_, step_ in claims if writer_ == writer]
    for batch, known in own:
        if known == step:
            return batch
    taken = [int(batch) for batch, _, _ in claims] + [int(n.removeprefix("batch=")) for n in listed(spark, root) if n.startswith("batch=")]
    batch = 1 + max(taken, default=-1)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files = path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(path(f"{root}/_claims"))
    files.create(path(f"{root}/_claims/{batch}.{writer}.{step}"), False).close()  # fails if it stands
    for old, known in own:
        if old < max(n for n, _ in own):
            files.delete(path(f"{root}/_claims/{old}.{writer}.{known}"), False)
    return batch


def current_index(spark: SparkSession, root: str, before: int | None = None) -> DataFrame:
    """Live rows. ``before`` gives the state ahead of that batch, so that a repeated batch sees the
    same input as the first try.

    Only keys and batch numbers of updates and deletes are gathered; they are picked by folder, so
    Spark knows their size and broadcasts them while they are few. See :func:`compact_index`.
    """
    log = read_log(spark, root)
    if before is not None:
        log = log.filter(F.col("batch") < before)
    reset = log.filter("op = 'reset'").agg(F.max("batch")).first()[0]  # one row per rebuild, picked by folder
    if reset is None:
        log = log.filter("op <> 'rebuilt'")
    else:
        log = log.filter((F.col("batch") > reset) & (F.col("op") != "rebuilt") | (F.col("batch") == reset) & (F.col("op") == "rebuilt"))
    replaced = log.filter("op IN ('update', 'delete')").groupBy(KEY).agg(F.max("batch").alias("_replaced"))
    rows = log.filter("op <> 'delete'").join(replaced, KEY, "left")
    live = rows.filter(F.col("_replaced").isNull() | (F.col("batch") >= F.col("_replaced")))
    return live.select(*ROW, "embedding")


def chunk_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """Difference of two keyed snapshots: ``chunk_id, change`` plus the new row's columns.

    ``insert`` and ``delete`` by key; ``update`` where the key stays and its place differs. Keys are
    unique on both sides, and only key and place of ``old`` are read.
    """
    before = old.select(KEY, F.struct(*PLACE).alias("_old"))
    after = new.select(KEY, F.struct(*PLACE).alias("_new"), "chunk_content")
    change = (
        F.when(F.col("_old").isNull(), "insert")
        .when(F.col("_new").isNull(), "delete")
        .when(~F.col("_old").eqNullSafe(F.col("_new")), "update")
    )
    return (
        before.join(after, KEY, "full_outer")
        .withColumn("change", change)
        .filter(F.col("change").isNotNull())
        .select(KEY, "change", *[F.col(f"_new.{c}").alias(c) for c in PLACE], "chunk_content")
    )


def sync_index(spark: SparkSession, root: str, chunks: DataFrame, embedder: Embedder, batch: int) -> DataFrame:
    """Bring the index in step with ``chunks`` as change batch ``batch``; returns the live rows.

    Only inserted texts are embedded. An updated row keeps its vector, since equal id means equal
    text.
    """
    current = current_index(spark, root, before=batch)
    # keys and places are compared without texts; written once, since three branches read it
    changes = materialise(chunk_changes(current, places(chunks).withColumn("chunk_content", F.lit(None).cast("string"))), "changes")
    _write_changes(changes, _texts(chunks, changes), current, embedder, root, batch)
    return current_index(spark, root)


def places(chunks: DataFrame) -> DataFrame:
    """Key and lowest place of every chunk id, without texts."""
    least = chunks.groupBy(KEY).agg(F.min(F.struct(*PLACE)).alias("_place"))
    return least.select(KEY, *[F.col(f"_place.{c}").alias(c) for c in PLACE])


def _texts(chunks: DataFrame, changes: DataFrame) -> DataFrame:
    """``chunk_id, chunk_content`` of inserted keys, from the chunk table."""
    fresh = changes.filter("change = 'insert'").select(KEY)
    return chunks.select(KEY, "chunk_content").join(fresh, KEY, "left_semi").groupBy(KEY).agg(F.first("chunk_content").alias("chunk_content"))


def _write_changes(changes: DataFrame, texts: DataFrame, current: DataFrame, embedder: Embedder, root: str, batch: int) -> None:
    """Write ``changes`` (a written table of key, change, place) as a batch, with ``texts`` for inserted keys.

    The index is read for texts and vectors of updated keys, and not at all where nothing is updated.
    """
    changes = changes.drop("chunk_content")
    delta = embed_index(changes.filter("change = 'insert'").join(texts, KEY), embedder)
    updated = changes.filter("change = 'update'")
    if not updated.isEmpty():
        delta = delta.unionByName(updated.join(current.select(KEY, "chunk_content", "embedding"), KEY))
    deleted = changes.filter("change = 'delete'").select(
        "*", F.lit(None).cast("string").alias("chunk_content"), F.lit(None).cast("array<float>").alias("embedding")
    )
    delta = delta.unionByName(deleted).withColumnRenamed("change", "op")
    delta.select(*ROW, "embedding", "op").write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(
        "op"
    ).parquet(f"{root}/batch={batch}", compression=CODEC)


def apply_changes(changes: DataFrame, root: str, embedder: Embedder, batch: int) -> None:
    """Write ``changes`` (a written table: key, change, place, text of inserted keys) as change batch ``batch``."""
    current = current_index(changes.sparkSession, root, before=batch) if batch else None
    texts = changes.filter("change = 'insert'").select(KEY, "chunk_content")
    _write_changes(changes, texts, current, embedder, root, batch)


def append_index(spark: SparkSession, root: str, chunks: DataFrame, embedder: Embedder, batch: int) -> None:
    """Add the chunks whose id the index does not hold yet, and move a known id to a lower place if it
    has one now; for append-only chunk streams.

    The index is read for the keys of ``chunks`` only, which are few; while within Spark's bound they are
    broadcast, so the index is not shuffled.
    """
    current = current_index(spark, root, before=batch)
    rows = materialise(places(chunks), "rows")
    known = current.join(rows.select(KEY), KEY, "left_semi").select(KEY, F.struct(*PLACE).alias("_known"))
    lower = F.struct(*PLACE) < F.col("_known")
    changes = rows.join(known, KEY, "left").withColumn("change", F.when(F.col("_known").isNull(), "insert").when(lower, "update"))
    changes = materialise(changes.filter("change IS NOT NULL").select(KEY, "change", *PLACE), "changes")
    _write_changes(changes, _texts(chunks, changes), current, embedder, root, batch)


def refresh_index(
    spark: SparkSession, root: str, chunks: DataFrame, embedder: Embedder, force: bool = False
) -> DataFrame:
    """Create the index if there is none, rebuild it with ``force``, otherwise sync; returns the live rows."""
    if last_batch(spark, root) is None or force:
        rebuild_index(chunks, embedder, root)
        return current_index(spark, root)
    return sync_index(spark, root, chunks, embedder, claim_batch(spark, root, "sync", uuid.uuid4().hex))


def last_batch(spark: SparkSession, root: str) -> int | None:
    """Number of the latest batch, None where there is no index."""
    return max((int(n.removeprefix("batch=")) for n in listed(spark, root) if n.startswith("batch=")), default=None)


def compact_index(spark: SparkSession, root: str, target: str) -> DataFrame:
    """Write the live rows as batch 0 of a new index, clustered by key; for a log with many updates."""
    write_inserts(cluster(current_index(spark, root)), target, 0, mode="error")
    return current_index(spark, target)


def index_stats(index: DataFrame) -> DataFrame:
    """Row count, distinct keys and the range of vector sizes, in one pass."""
    return index.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct(KEY).alias("n_keys"),
        F.min(F.size("embedding")).cast("bigint").alias("min_dim"),
        F.max(F.size("embedding")).cast("bigint").alias("max_dim"),
    )


def index_row_count(spark: SparkSession, root: str) -> int | None:
    """Number of live rows, None where there is no index."""
    return _found(lambda: current_index(spark, root).count())
