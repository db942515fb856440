"""A kept approximate index: two levels of pivots, quantised residuals, extended by every change batch.

Layout below ``root``: ``pivots`` (both levels, written once), ``codes/batch=<n>/area=<a>`` (one row per vector) and
``removed/batch=<n>`` (ids whose earlier rows no longer count). An *area* is all that lies nearest to a first-level
pivot; inside it a vector belongs to the *cell* of the nearest second-level pivot of this area. Files are sorted by cell, so a
reader skips row groups as well as folders.

A row holds its vector and a *code*: the difference to the pivot in steps of ``scale``, one byte a dimension, with the length
``error`` of what the code leaves out. For a query of length 1 the code gives the score up to ``error``, so a search reads
codes of visited cells only, keeps what could be among the best ``k`` of them, and reads vectors of those rows alone. The hits are
exactly the best of the visited cells; approximate is only the choice of cells.

Pivots are the vectors with the lowest MD5 of their id, at most ``MAX_PIVOTS``; tables of cells and pivots are bounded by
that. Vectors are kept as they came and compared at length 1; a zero vector scores 0. Nulls and ids that repeat within a batch are
not allowed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodestrata.operators.index import listed
from lodestrata.operators.ordering import best_per_group
from lodestrata.operators.search import BLOCK_BYTES, SCORE_DIGITS, _matrix
from lodestrata.sources.workspace import materialise

MAX_PIVOTS = 4096
CODE_STEPS = 127
ROWS = "vector array<float>, area int, cell int, code binary, scale float, error float"  # behind the item
_ARROW = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}


class Pivots:
    """Both levels as unit vectors; ``parent`` is the area of each cell."""

    def __init__(self, areas: np.ndarray, cells: np.ndarray):
        self.areas, self.cells = areas, cells
        self.parent = (cells @ areas.T).argmax(1)
        # an area without a cell of its own would lose its vectors
        self.areas_used = np.unique(self.parent)

    def assign(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Area and cell of each vector."""
        area = self.areas_used[(unit @ self.areas[self.areas_used].T).argmax(1)]
        cell = np.zeros(len(unit), np.int64)
        for a in np.unique(area):
            mine, own = area == a, np.flatnonzero(self.parent == a)
            cell[mine] = own[(unit[mine] @ self.cells[own].T).argmax(1)]
        return area, cell

    def visits(self, unit: np.ndarray, areas: int, cells: int) -> list[np.ndarray]:
        """The cells that each query visits: the nearest ``cells`` ones of its nearest ``areas``."""
        near = np.argsort(-(unit @ self.areas[self.areas_used].T), axis=1, kind="stable")[:, :areas]
        cosine = unit @ self.cells.T
        out = []
        for own, scores in zip(self.areas_used[near], cosine):
            open_ = np.flatnonzero(np.isin(self.parent, own))
            out.append(open_[np.argsort(-scores[open_], kind="stable")[:cells]])
        return out


def _pivots(spark: SparkSession, root: str) -> Pivots:
    rows = spark.read.parquet(f"{root}/pivots").orderBy("level", "number").toArrow()  # at most 2 * MAX_PIVOTS rows
    level = rows.column("level").to_numpy()
    unit = _matrix(rows.column("vector"), len(rows.column("vector")[0]))
    return Pivots(unit[level == 1], unit[level == 2])


def build_cells(vectors: DataFrame, root: str, cells: int | None = None) -> None:
    """Choose pivots from ``item, vector`` and write all rows as batch 0."""
    spark, n = vectors.sparkSession, vectors.count()
    if not n:
        raise ValueError("pivots need vectors")
    cells = min(cells or math.ceil(math.sqrt(n)), MAX_PIVOTS, n)
    areas = math.ceil(math.sqrt(cells))
    by_md5 = [F.md5(F.col("item").cast("string")), "item"]
    chosen = vectors.orderBy(*by_md5).limit(cells)
    numbered = chosen.withColumn("number", F.row_number().over(W.orderBy(*by_md5)) - 1)  # of the chosen rows only
    levels = numbered.select(F.lit(2).alias("level"), "number", "vector").unionByName(
        numbered.where(F.col("number") < areas).select(F.lit(1).alias("level"), "number", "vector")
    )
    levels.coalesce(1).write.parquet(f"{root}/pivots")
    add_vectors(vectors, root, 0)


def _coded(pivots: Pivots, dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            unit = _matrix(batch.column(1), dim)
            area, cell = pivots.assign(unit)
            rest = unit - pivots.cells[cell]
            scale = np.maximum(np.abs(rest).max(1), 1e-12) / CODE_STEPS
            scale = scale.astype(np.float32)
            code = np.clip(np.rint(rest / scale[:, None].astype(np.float64)), -CODE_STEPS, CODE_STEPS).astype(np.int8)
            error = np.sqrt(((rest - code * scale[:, None].astype(np.float64)) ** 2).sum(1))
            columns = [
                pa.array(area, pa.int32()),
                pa.array(cell, pa.int32()),
                pa.array([c.tobytes() for c in code], pa.binary()),
                pa.array(scale, pa.float32()),
                pa.array(np.nextafter(error.astype(np.float32), np.float32(np.inf)), pa.float32()),
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], ["item", *(c.split()[0] for c in ROWS.split(", "))])

    return run


def add_vectors(vectors: DataFrame, root: str, batch: int) -> None:
    """Write ``item, vector`` as a batch, in the cells of the pivots that stand; a repeated batch replaces its rows."""
    spark = vectors.sparkSession
    pivots = _pivots(spark, root)
    rows = vectors.select("item", F.col("vector").cast("array<float>").alias("vector"))
    kind = rows.schema["item"].dataType.simpleString()
    coded = rows.mapInArrow(_coded(pivots, pivots.cells.shape[1]), f"item {kind}, {ROWS}")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # a cell with most of the vectors is cut by the hash of the id
    sorted_ = coded.repartitionByRange(parts, "area", "cell", F.xxhash64("item")).sortWithinPartitions("area", "cell")
    sorted_.write.mode("overwrite").partitionBy("area").parquet(f"{root}/codes/batch={batch}")


def remove_vectors(items: DataFrame, root: str, batch: int) -> None:
    """Rows of these ``item`` ids written before ``batch`` no longer count."""
    items.select("item").write.mode("overwrite").parquet(f"{root}/removed/batch={batch}")


def extend_cells(log: DataFrame, root: str) -> int:
    """Take the batches of an index's change log that are not in the cells yet; returns the last one.

    Inserted vectors are added, deleted ids removed. An update moves a row and keeps its vector, so it changes nothing here.
    """
    spark = log.sparkSession
    done = max((int(n.removeprefix("batch=")) for n in listed(spark, f"{root}/codes")), default=-1)
    fresh = sorted(r["batch"] for r in log.where(F.col("batch") > done).select("batch").distinct().collect())
    for batch in fresh:
        own = log.where(F.col("batch") == batch)
        remove_vectors(own.where("op = 'delete'").select(F.col("chunk_id").alias("item")), root, batch)
        add_vectors(own.where("op = 'insert'").select(F.col("chunk_id").alias("item"), F.col("embedding").alias("vector")), root, batch)
    return max([done, *fresh])


def _live(spark: SparkSession, root: str) -> DataFrame:
    rows = spark.read.parquet(f"{root}/codes")
    if not listed(spark, f"{root}/removed"):
        return rows
    gone = spark.read.parquet(f"{root}/removed").groupBy("item").agg(F.max("batch").alias("_gone"))
    return rows.join(gone, "item", "left").where(F.col("_gone").isNull() | (F.col("batch") >= F.col("_gone"))).drop("_gone")


def visited_cells(queries: DataFrame, root: str, areas: int, cells: int) -> DataFrame:
    """``query, vector, cell`` of the cells that each query of ``query, vector`` visits."""
    pivots = _pivots(queries.sparkSession, root)
    dim = pivots.cells.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                found = pivots.visits(_matrix(part.column(1), dim), areas, cells)
                picked = part.take(pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found])))
                yield pa.RecordBatch.from_arrays([*picked.columns, pa.array(np.concatenate(found), pa.int32())], ["query", "vector", "cell"])

    kind = queries.schema["query"].dataType.simpleString()
    return queries.select("query", F.col("vector").cast("array<float>")).mapInArrow(run, f"query {kind}, vector array<float>, cell int")


def search_cells(queries: DataFrame, root: str, k: int, areas: int = 4, cells: int = 16) -> DataFrame:
    """``query, item, score, rank``: the best ``k`` vectors of the cells that each query of ``query, vector`` visits."""
    spark, kind = queries.sparkSession, queries.schema["query"].dataType.simpleString()
    pivots = _pivots(spark, root)
    dim = pivots.cells.shape[1]
    item = _live(spark, root).schema["item"].dataType.simpleString()
    visits = materialise(visited_cells(queries, root, areas, cells), "visits")
    wanted = {r["cell"]: r["n"] for r in visits.groupBy("cell").agg(F.count("*").alias("n")).collect()}  # at most MAX_PIVOTS rows
    held = [int(a) for a in np.unique(pivots.parent[list(wanted)])] if wanted else []
    rows = _live(spark, root).where(F.col("area").isin(held) & F.col("cell").isin(list(wanted)))
    sizes = {r["cell"]: r["n"] for r in rows.groupBy("cell").agg(F.count("*").alias("n")).collect()}
    per_block = max(1, BLOCK_BYTES // (8 * dim))
    shape = [(c, -(-n // per_block), -(-sizes.get(c, 1) // per_block)) for c, n in wanted.items()]
    blocks = F.broadcast(spark.createDataFrame(shape, "cell int, query_blocks int, row_blocks int"))
    left = visits.join(blocks, "cell").withColumn("qb", F.pmod(F.xxhash64("query"), "query_blocks").cast("int"))
    left = left.withColumn("rb", F.explode(F.sequence(F.lit(0), F.col("row_blocks") - 1))).select("query", "vector", "cell", "qb", "rb")
    right = rows.select("item", "cell", "code", "scale", "error").join(blocks, "cell").withColumn("rb", F.pmod(F.xxhash64("item"), "row_blocks").cast("int"))
    right = right.withColumn("qb", F.explode(F.sequence(F.lit(0), F.col("query_blocks") - 1)))
    right = right.select("item", "cell", "code", "scale", "error", "qb", "rb")
    bounds = [("cell", pa.int32()), ("least", pa.float64()), ("most", pa.float64())]
    out = pa.schema([("query", _ARROW[kind]), ("item", _ARROW[item]), *bounds])

    def compare(asked: pa.Table, codes: pa.Table) -> pa.Table:
        if not asked.num_rows or not codes.num_rows:
            return out.empty_table()
        asked, codes = asked.combine_chunks(), codes.combine_chunks()
        unit = _matrix(asked["vector"], dim)
        steps = np.frombuffer(b"".join(codes["code"].to_pylist()), np.int8).reshape(-1, dim)
        scale, error = (codes[c].to_numpy().astype(np.float64) for c in ("scale", "error"))
        pivot = pivots.cells[codes["cell"][0].as_py()]
        parts = []
        for at in range(0, len(unit), 512):
            score = (unit[at : at + 512] @ pivot)[:, None] + (unit[at : at + 512] @ steps.T.astype(np.float64)) * scale
            slack = error + 10.0**-SCORE_DIGITS  # scores are compared after rounding
            bar = np.partition(score - slack, -k, axis=1)[:, -k] if len(steps) > k else np.full(len(score), -np.inf)
            q, i = np.nonzero(score + slack >= bar[:, None])
            parts.append((q + at, i, (score - slack)[q, i], (score + slack)[q, i]))
        q, i, least, most = (np.concatenate(x) for x in zip(*parts))
        picked = [asked["query"].take(pa.array(q)), codes["item"].take(pa.array(i)), codes["cell"].take(pa.array(i)), pa.array(least), pa.array(most)]
        return pa.table(picked, schema=out)

    keys = ["cell", "qb", "rb"]
    near = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(compare, f"query {kind}, item {item}, cell int, least double, most double")
    near = materialise(near, "near")
    bar = best_per_group(near, ["query"], [F.desc("least")], k).groupBy("query").agg(F.min("least").alias("bar"), F.count("*").alias("n"))
    open_ = near.join(bar, "query").where((F.col("n") < k) | (F.col("most") >= F.col("bar"))).select("query", "item", "cell")
    exact = rows.select("item", "cell", F.col("vector").alias("held")).join(open_, ["cell", "item"]).join(queries.select("query", "vector"), "query")
    scored = exact.mapInArrow(_scored(dim, out.field("query").type), f"query {kind}, item {item}, score double")
    return best_per_group(scored, ["query"], [F.desc("score"), F.asc("item")], k)


def _scored(dim: int, query_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = (_matrix(batch.column(c), dim) for c in ("vector", "held"))
                score = np.round((a * b).sum(1), SCORE_DIGITS) + 0.0
                yield pa.RecordBatch.from_arrays([batch.column("query").cast(query_type), batch.column("item"), pa.array(score)], ["query", "item", "score"])

    return run
