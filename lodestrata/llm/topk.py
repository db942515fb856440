"""Exact top-k by inner product: term-at-a-time accumulation over blocks.

Components are turned into integers, ``floor(scale * x)``; a dimension is a term and a non-zero component
a posting. Vectors are packed into blocks, column by column, and so are queries. A pair of blocks is
scored exhaustively: each term of a query adds its weighted postings to a dense array of scores, one
array per query. A partition selection keeps the best ``k`` of a block with all ties that ``k`` needs,
and a window over queries merges the blocks.

Query blocks go to groups of vector blocks by an equi-join on the group, so nothing is broadcast or
collected, and work grows as queries times vectors, as an exhaustive search must.

Defined results: vectors that are null or hold a null, NaN or infinite component take no part, neither do
rows without an id; an empty vector has score 0 with all; missing components of a shorter vector count
as 0. A query meets all rows but those with its own id. Repeated rows are candidates each, and rows that
repeat a query's id share one list; ties go to the smaller id. Sums beyond a 64-bit integer are held at its limits. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodestrata.sources.workspace import materialise

BLOCK_ROWS = 2048
GROUP_BLOCKS = 4
SAFE = 1 << 24  # components within this cannot overflow 64 bits in any sum of up to 2 ** 15 terms
BLOCK = "ids binary, dims int, columns binary"


def valid_vectors(table: DataFrame, key: str, vector: str) -> DataFrame:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    own = table.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    return own.where(F.col("id").isNotNull() & F.col("vector").isNotNull() & ~F.coalesce(bad, F.lit(False)))


def _pack(scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                ids = part.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
                lists = part.column(1)
                lengths = np.diff(lists.offsets.to_numpy())
                flat = np.floor(lists.flatten().to_numpy(zero_copy_only=False) * float(scale))
                limit = float(np.iinfo(np.int64).max // 2)
                flat = np.clip(flat, -limit, limit).astype(np.int64)
                dims = int(lengths.max(initial=0))
                dense = np.zeros((dims, len(ids)), np.int64)  # one row per term
                dense[_positions(lengths), np.repeat(np.arange(len(ids)), lengths)] = flat
                yield pa.record_batch({"ids": [ids.tobytes()], "dims": pa.array([dims], pa.int32()), "columns": [dense.tobytes()]})

    return run


def _positions(lengths: np.ndarray) -> np.ndarray:
    starts = np.repeat(np.cumsum(lengths) - lengths, lengths)
    return np.arange(lengths.sum()) - starts


def accumulate(query: np.ndarray, terms: np.ndarray) -> np.ndarray:
    """Dense scores of one query over a block whose rows are terms: one scatter per non-zero weight."""
    small = max(np.abs(query).max(initial=0), np.abs(terms).max(initial=0)) <= SAFE
    scores = np.zeros(terms.shape[1], np.int64 if small else object)
    for t in np.flatnonzero(query[: terms.shape[0]]):
        scores += (query[t] if small else int(query[t])) * (terms[t] if small else terms[t].astype(object))
    if small:
        return scores
    limits = np.iinfo(np.int64)
    return np.array([min(max(s, limits.min), limits.max) for s in scores], np.int64)


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` highest scores, ties to the smaller id: select first, sort what is left."""
    chosen = np.arange(len(scores))
    if len(scores) > k:
        bar = np.partition(scores, len(scores) - k)[len(scores) - k]
        chosen = np.flatnonzero(scores >= bar)
    return chosen[np.lexsort((ids[chosen], -scores[chosen]))][:k]


def _score(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                queries, q = np.frombuffer(row["q_ids"], np.int64), np.frombuffer(row["q_columns"], np.int64)
                ids, terms = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["columns"], np.int64)
                q, terms = q.reshape(row["q_dims"], len(queries)), terms.reshape(row["dims"], len(ids))
                out = []
                for i, query in enumerate(queries):
                    scores = accumulate(np.ascontiguousarray(q[:, i]), terms)
                    others = np.flatnonzero(ids != query)
                    at = others[best(scores[others], ids[others], k)] if len(others) < len(ids) else best(scores, ids, k)
                    out.append((np.full(len(at), query), ids[at], scores[at]))
                columns = [np.concatenate(c) for c in zip(*out, strict=True)]
                yield pa.record_batch(dict(zip(("query_id", "vec_id", "score"), map(pa.array, columns), strict=True)))

    return run


def exact_top_k(queries: DataFrame, vectors: DataFrame, k: int, scale: int = 256) -> DataFrame:
    """``query_id, rank, vec_id, score``; both inputs as :func:`valid_vectors` gives them."""
    pack = _pack(scale)
    blocks = materialise(vectors.mapInArrow(pack, BLOCK), "blocks")
    groups = max(1, -(-blocks.count() // GROUP_BLOCKS))
    keyed = blocks.withColumn("group", F.pmod(F.xxhash64("ids", "columns"), F.lit(groups)))
    asked = queries.mapInArrow(pack, BLOCK).select(
        F.col("ids").alias("q_ids"),
        F.col("dims").alias("q_dims"),
        F.col("columns").alias("q_columns"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("group"),
    )
    scored = keyed.join(asked, "group").drop("group").mapInArrow(_score(k), "query_id long, vec_id long, score long")
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
