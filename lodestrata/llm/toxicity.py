"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

Examples are at most ``EXAMPLES`` labelled documents, those with the lowest hash of ``doc_id``. Terms are
lower-cased letter runs, and the vocabulary holds all terms of the examples. Vectors are
``(1 + log tf) * idf``, normalised; document counts are those of all documents, labelled or not.

Examples lie in an inverted index; the at most ``COMMON`` commonest terms are also columns, cut into blocks
of ``BLOCK`` examples with the greatest weight of each per block. Blocks whose bound stays below the k-th best
cosine are skipped, so neighbours are exact. They vote with the power ``SHARPNESS`` of their cosine, since a
near copy says more than many texts that share common words. A second search of the same kind takes only the
at most ``TERMS`` terms whose document counts among the examples depend on the label (chi-squared); the
greater vote counts, so a text without such a term is judged too. Votes are calibrated by isotonic regression on the
examples, each left out of its own vote. A document that shares no term with any example gets the rate of
empty examples. The neighbours' ids are the evidence.

Every whole text is scored in one pass without a shuffle; what a task holds is bounded by the
examples and their terms. Label, language, source and doc_id are not inputs of a score; a document is only kept from
being its own neighbour.

Defined results: null and empty texts have no terms; a null doc_id is not held out and never an example; a
doc with several labels counts as toxic if one says so; null labels are ignored; without labels all
scores are 0. Ties of cosine go to the smaller doc_id; repeated rows are scored alike. An empty table
gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.llm.spread import lowest_hashes
from lodestrata.llm.words import slices, texts
from lodestrata.sources.workspace import materialise

EXAMPLES = 8192
TERMS = 512
LEAST_DOCS = 5
LEAST_CHI2 = 24.0
COMMON = 512
COMMON_SHARE = 16
BLOCK = 64
QUERIES = 64
NEIGHBOURS = 15
PRIOR_WEIGHT = 1.0
SHARPNESS = 4
CUT = 0.3
# bytes that part words become blanks, capitals become small letters, all else stays
_FOLD = bytes(c if chr(c).islower() and c < 128 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def terms(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def known_terms(text: bytes, vocabulary: dict[bytes, int]) -> np.ndarray:
    """Numbers of a text's terms in the vocabulary, in the text's order."""
    own = terms(text)
    at = np.fromiter(map(vocabulary.get, own, repeat(-1)), np.int64, len(own))
    return at[at >= 0]


def remainder(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


class Lists:
    """Vectors in an inverted index. The commonest terms lie as columns too, with their greatest weights per block."""

    def __init__(self, ids: np.ndarray, at: list[np.ndarray], weights: list[np.ndarray], terms: int):
        self.ids, self.terms = ids, terms
        flat, values = (np.concatenate(x) if x else np.zeros(0) for x in (at, weights))
        flat, owner = flat.astype(np.int64), np.repeat(np.arange(len(ids)), [len(a) for a in at]).astype(np.int32)
        order = np.argsort(flat, kind="stable")
        self.positions, self.weights = owner[order], values[order]
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(flat, minlength=terms))])
        self._columns()

    def __getstate__(self):
        return {n: getattr(self, n) for n in ("ids", "terms", "positions", "weights", "starts")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._columns()

    def _columns(self) -> None:
        n, counts = len(self.ids), np.diff(self.starts)
        common = np.argsort(-counts, kind="stable")[:COMMON]
        common = common[counts[common] * COMMON_SHARE > n]
        self.column = np.full(self.terms, -1, np.int32)
        self.column[common] = np.arange(len(common))
        blocks = -(-n // BLOCK)
        dense = np.zeros((blocks * BLOCK, len(common)))
        for c, t in enumerate(common):
            own = slice(self.starts[t], self.starts[t + 1])
            dense[self.positions[own], c] = self.weights[own]
        self.bounds = dense.reshape(blocks, BLOCK, len(common)).max(1).T
        self.dense = dense[:n]
        self.near = np.ascontiguousarray(self.dense.T, np.float32)
        order = np.argsort(self.ids, kind="stable")
        ids, first = np.unique(self.ids[order], return_index=True)
        self.places = dict(zip(ids.tolist(), np.split(order, first[1:]), strict=False))

    def nearest(self, queries: list[tuple[np.ndarray, np.ndarray]], owns: list[int | None], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per query the positions and cosines of the ``k`` nearest vectors with a cosine above 0.

        Rare terms are summed from their lists. Blocks that the k-th best of these sums rules out for all
        queries are skipped; for the others, common terms are added in single precision, and what
        comes near the k-th best is summed again in double precision.
        """
        n = len(self.ids)
        if not n:
            return [(np.zeros(0, np.int64), np.zeros(0))] * len(queries)
        sums, common, split = np.zeros((len(queries), n)), np.zeros((len(queries), len(self.near))), []
        for i, ((at, weights), own) in enumerate(zip(queries, owns, strict=True)):
            columns = self.column[at]
            rare = columns < 0
            first, sizes = self.starts[at[rare]], self.starts[at[rare] + 1] - self.starts[at[rare]]
            gather = np.repeat(first - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
            sums[i] = np.bincount(self.positions[gather], self.weights[gather] * np.repeat(weights[rare], sizes), n)
            common[i, columns[~rare]] = weights[~rare]
            split.append((columns[~rare], weights[~rare]))
            if own is not None and own in self.places:
                sums[i, self.places[own]] = -4.0  # below all cosines
        bars = np.partition(sums, -k, 1)[:, [-k]].clip(0) if n > k else np.zeros((len(queries), 1))
        upper = np.maximum.reduceat(sums, np.arange(0, n, BLOCK), 1) + common @ self.bounds
        alive = np.flatnonzero(np.repeat(((upper > 0) & (upper >= bars - 1e-9)).any(0), BLOCK)[:n])
        whole = len(alive) == n
        close = (sums if whole else sums[:, alive]) + common.astype(np.float32) @ (self.near if whole else self.near[:, alive])
        out = []
        for i, (columns, weights) in enumerate(split):
            least = np.partition(close[i], -k)[-k] - 1e-4 if len(alive) > k else 0.0
            best = alive[(close[i] > 0) & (close[i] >= least)]
            values = np.round(sums[i, best] + self.dense[np.ix_(best, columns)] @ weights, 12)
            best, values = best[values > 0], values[values > 0]
            order = np.lexsort((self.ids[best], -values))[:k]
            out.append((best[order], values[order]))
        return out


@dataclass
class Examples:
    """Labelled examples: ``lists`` over all their terms, ``marked`` over the terms that depend on the label."""

    vocabulary: dict[bytes, int]
    idf: np.ndarray
    chosen: np.ndarray
    rate: float
    empty_rate: float
    ids: np.ndarray
    toxic: np.ndarray
    lists: Lists | None
    marked: Lists | None
    steps: tuple[np.ndarray, np.ndarray]

    def vector(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        at, counts = np.unique(known_terms(text, self.vocabulary), return_counts=True)
        weights = (1 + np.log(counts)) * self.idf[at]
        return at, weights / np.sqrt((weights**2).sum()) if len(at) else weights

    def part(self, at: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A vector's terms that depend on the label."""
        own = np.isin(at, self.chosen)
        at, weights = at[own], weights[own]
        return at, weights / np.sqrt((weights**2).sum()) if len(at) else weights

    def nearest(self, at: np.ndarray, weights: np.ndarray, own: int | None, k: int = NEIGHBOURS) -> tuple[np.ndarray, np.ndarray]:
        """Positions and cosines of the ``k`` nearest examples with a cosine above 0."""
        return self.lists.nearest([(at, weights)], [own], k)[0]

    def raw(self, best: np.ndarray, values: np.ndarray) -> float:
        return float((values @ self.toxic[best] + PRIOR_WEIGHT * self.rate) / (values.sum() + PRIOR_WEIGHT))

    def votes(self, texts: list[bytes], owns: list[int | None]) -> list[tuple[float, np.ndarray] | None]:
        """Per text the greater vote of both searches with its neighbours, or None without a neighbour."""
        out: list[tuple[float, np.ndarray] | None] = [None] * len(texts)
        vectors = [self.vector(t) for t in texts]
        parts = [self.part(*v) for v in vectors]
        for lists, queries, power in ((self.lists, vectors, SHARPNESS), (self.marked, parts, 1)):
            own = [i for i, (at, _) in enumerate(queries) if len(at)]
            for i, (best, values) in zip(own, lists.nearest([queries[i] for i in own], [owns[i] for i in own], NEIGHBOURS), strict=True):
                if len(best) and (out[i] is None or self.raw(best, values**power) > out[i][0]):
                    out[i] = self.raw(best, values**power), best
        return out

    def scores(self, texts: list[bytes], owns: list[int | None]) -> list[tuple[float, np.ndarray]]:
        found = self.votes(texts, owns)
        return [(float(np.interp(f[0], *self.steps)), self.ids[f[1]]) if f else (self.empty_rate, np.zeros(0, np.int64)) for f in found]


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: increasing x with non-decreasing means of y."""
    pools: list[list[float]] = []
    for a, b in sorted(zip(x.tolist(), y.tolist(), strict=True)):
        pools.append([a, b, 1.0])
        while len(pools) > 1 and (pools[-2][1] >= pools[-1][1] or pools[-2][0] == pools[-1][0]):
            last, pool = pools.pop(), pools[-1]
            weight = pool[2] + last[2]
            pools[-1] = [(pool[0] * pool[2] + last[0] * last[2]) / weight, (pool[1] * pool[2] + last[1] * last[2]) / weight, weight]
    knots = np.array(pools).reshape(-1, 3)
    return knots[:, 0], knots[:, 1]


def _term_counts(labelled: DataFrame) -> DataFrame:
    """``term, positive, negative``: example documents with the term, by label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            for text, label in zip(texts(batch.column(0)), batch.column(1).to_pylist(), strict=True):
                own = list(set(terms(text)))
                yield pa.record_batch({"term": pa.array(own, pa.binary()), "toxic": pa.array(np.full(len(own), label, np.int32))})

    each = labelled.select("text", "toxic").mapInArrow(run, "term binary, toxic int")
    return each.groupBy("term").agg(F.sum("toxic").cast("double").alias("positive"), F.sum(1 - F.col("toxic")).cast("double").alias("negative"))


def _document_counts(docs: DataFrame, vocabulary: dict[bytes, int]) -> tuple[np.ndarray, int]:
    """Documents with each term of the vocabulary, and all documents; a task counts before anything is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(vocabulary) + 1, np.int64)
        for batch in slices(batches):
            for text in texts(batch.column(1)):
                counts[np.unique(known_terms(text, vocabulary))] += 1
            counts[-1] += batch.num_rows
        at = np.flatnonzero(counts)
        yield pa.record_batch({"at": pa.array(at), "n": pa.array(counts[at])})

    found = docs.mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(len(vocabulary) + 1, np.int64)
    counts[found["at"].to_numpy()] = found["n"].to_numpy()
    return counts[:-1], int(counts[-1])


def fit(docs: DataFrame, labels: DataFrame) -> Examples | None:
    known = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    known = known.agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic")).where(remainder(F.col("doc_id")) != 2)
    texts_ = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    known = materialise(known.join(texts_.select("doc_id"), "doc_id", "left_semi"), "known")
    chosen = materialise(lowest_hashes(known, known.count(), EXAMPLES, "doc_id"), "chosen")
    labelled = materialise(texts_.join(F.broadcast(chosen), "doc_id"), "examples")  # at most EXAMPLES ids
    sizes = chosen.agg(F.count("*"), F.sum("toxic")).first()
    total, positive = sizes[0], sizes[1] or 0
    if not total:
        return None
    counts = _term_counts(labelled).toArrow().sort_by("term")
    p, n = (counts[c].to_numpy() for c in ("positive", "negative"))
    off = p * (total - positive) - n * positive
    chi2 = off * off * total / (max(positive, 1.0) * max(total - positive, 1) * (p + n) * np.maximum(total - p - n, 1.0))
    depends = np.flatnonzero((p + n >= LEAST_DOCS) & (chi2 >= LEAST_CHI2))
    chosen = depends[np.argsort(-chi2[depends], kind="stable")[:TERMS]]
    vocabulary = {t: i for i, t in enumerate(counts["term"].to_pylist())}
    having, documents = _document_counts(texts_, vocabulary)
    idf = 1 + np.log((1 + documents) / (1 + having))
    nothing = np.zeros(0, np.int64)
    model = Examples(vocabulary, idf, chosen, positive / total, positive / total, nothing, np.zeros(0), None, None, (np.array([0.0, 1.0]),) * 2)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            pairs = [model.vector(t) for t in texts(batch.column(1))]
            yield pa.record_batch(
                {
                    "doc_id": batch.column(0),
                    "toxic": batch.column(2),
                    "at": pa.array([a.tobytes() for a, _ in pairs], pa.binary()),
                    "weights": pa.array([w.tobytes() for _, w in pairs], pa.binary()),
                }
            )

    own = labelled.select("doc_id", "text", "toxic")
    rows = own.mapInArrow(vectors, "doc_id long, toxic int, at binary, weights binary").collect()
    fitted = _indexed(model, rows)

    def votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, QUERIES):
            found = fitted.votes(texts(batch.column(1)), batch.column(0).to_pylist())
            yield pa.record_batch({"raw": pa.array([f and f[0] for f in found], pa.float64()), "toxic": batch.column(2)})

    left_out = own.mapInArrow(votes, "raw double, toxic int").where("raw IS NOT NULL").toArrow()
    if left_out.num_rows:
        x, y = isotonic(left_out["raw"].to_numpy(), left_out["toxic"].to_numpy().astype(float))
        fitted.steps = (np.append(x, 1.0), np.append(y, 1.0)) if x[-1] < 1 else (x, y)  # votes beyond all examples rise to 1
    return fitted


def _indexed(model: Examples, rows: list) -> Examples:
    full = [(np.frombuffer(r["at"], np.int64), np.frombuffer(r["weights"], np.float64), r) for r in rows if r["at"]]
    parts = [model.part(a, w) for a, w, _ in full]
    order = sorted(range(len(full)), key=lambda i: (parts[i][0].tobytes(), full[i][2]["doc_id"], full[i][2]["at"], full[i][2]["weights"]))  # like vectors share blocks
    empty = [r["toxic"] for r in rows if not r["at"]]
    model.empty_rate = (sum(empty) + PRIOR_WEIGHT * model.rate) / (len(empty) + PRIOR_WEIGHT)
    model.ids = np.array([full[i][2]["doc_id"] for i in order], np.int64)
    model.toxic = np.array([full[i][2]["toxic"] for i in order], np.float64)
    size = len(model.vocabulary)
    model.lists = Lists(model.ids, [full[i][0] for i in order], [full[i][1] for i in order], size)
    model.marked = Lists(model.ids, [parts[i][0] for i in order], [parts[i][1] for i in order], size)
    return model


def scored(docs: DataFrame, model: Examples | None) -> DataFrame:
    """``doc_id, score, evidence``: the evidence lists the neighbours' doc_ids, nearest first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, QUERIES):
            found = model.scores(texts(batch.column(1)), batch.column(0).to_pylist()) if model else [(0.0, np.zeros(0, np.int64))] * batch.num_rows
            yield pa.record_batch(
                {
                    "doc_id": batch.column(0),
                    "score": pa.array([min(max(s, 0.0), 1.0) for s, _ in found], pa.float64()),
                    "evidence": pa.array([e.tolist() for _, e in found], pa.list_(pa.int64())),
                }
            )

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return own.mapInArrow(run, "doc_id long, score double, evidence array<long>")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted, evidence`` per row of ``docs``."""
    return scored(docs, fit(docs, labels)).select(
        "doc_id",
        F.coalesce(remainder(F.col("doc_id")) == 2, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= CUT).cast("int").alias("predicted"),
        "evidence",
    )
