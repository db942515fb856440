"""Quality rules: an isolation forest on rule statistics, over plain base rules.

The statistics of a text (word lengths, symbols, repeated lines and windows, capitals, stops, words a line) are
taken from its whole length in one pass. Random axis splits over samples isolate unusual documents on
short paths; the score is ``2 ** (-mean path / expected path)``. A document is kept when it passes the
base rules and scores below the threshold.

The forest is fitted on at most ``FIT_ROWS`` rows, those with the lowest hash of ``doc_id``. The
threshold is calibrated on all labelled rows, from counts per score bin: the lowest one that rejects
at most ``CLEAN_LOSS`` of the good rows. It stands in every row.

Defined results: null and empty texts have statistics 0 and fail the base rules; without good labels
only the base rules decide (threshold 2); a document with contradicting labels is good; very long texts are read whole;
repeated rows each get a row. An empty table gives no rows. Extra columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.llm.spread import lowest_hashes
from lodestrata.llm.words import WordHashes, covered, slices, texts, windows
from lodestrata.sources.workspace import materialise

FIT_ROWS = 8192
TREES = 128
TREE_ROWS = 256
CLEAN_LOSS = 0.005
BINS = 1000
SYMBOLS = b"#*$%&|<>"
BLANKS = b" \t\n\r\x0b\x0c"
CONTINUATION = bytes(range(0x80, 0xC0))
UPPER = bytes(range(ord("A"), ord("Z") + 1))
STOPS = b".!?,;:"
WINDOW = 5
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = ("word_length", "symbols", "dup_lines", "repeats", "upper", "stops", "line_words", "distinct")


def count_in(text: bytes, what: bytes) -> int:
    return len(text) - len(text.translate(None, what))


def statistics(text: bytes, hashes: WordHashes) -> tuple[list[int], list[float]]:
    """The counts named in ``COUNTS`` and the statistics named in ``FEATURES``."""
    words = text.split()
    n = len(words)
    chars = len(text) - count_in(text, BLANKS) - count_in(text, CONTINUATION)
    symbols = count_in(text, SYMBOLS)
    lines = [line for line in text.split(b"\n") if line.strip()]
    dup_lines = len(lines) - len(set(lines))
    repeats, distinct = 0, 0
    if n:
        own = hashes.of(words)
        distinct = len(np.unique(own))
        if n >= WINDOW:
            _, which, often = np.unique(windows(own, WINDOW), return_inverse=True, return_counts=True)
            repeats = int(covered(often[which] > 1, WINDOW, n).sum())
    w = max(n, 1)
    features = [
        chars / w,
        symbols / w,
        dup_lines / max(len(lines), 1),
        repeats / w,
        count_in(text, UPPER) / w,
        count_in(text, STOPS) / w,
        np.log1p(n / max(len(lines), 1)),
        distinct / w ** 0.9,
    ]
    return [n, chars, symbols, dup_lines, repeats], features


def base_failed(counts: np.ndarray) -> np.ndarray:
    return (counts[:, 0] < 10) | (100 * counts[:, 4] > 20 * counts[:, 0])


def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``doc_id, text`` to ``doc_id``, counts and statistics."""
    hashes = WordHashes()
    for batch in slices(batches):
        found = [statistics(t, hashes) for t in texts(batch.column(1))]
        counts = np.array([f[0] for f in found], np.int64).reshape(-1, len(COUNTS))
        values = np.array([f[1] for f in found], np.float64).reshape(-1, len(FEATURES))
        columns = {"doc_id": batch.column(0)}
        columns |= {name: pa.array(counts[:, i]) for i, name in enumerate(COUNTS)}
        columns |= {name: pa.array(values[:, i]) for i, name in enumerate(FEATURES)}
        yield pa.record_batch(columns)


MEASURED = "doc_id long, " + ", ".join([f"{c} long" for c in COUNTS] + [f"{f} double" for f in FEATURES])


def document_statistics(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(measure, MEASURED)


@dataclass
class Forest:
    """Trees as arrays: feature (-1 for a leaf), cut, left child (the right one follows), path length."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    path: np.ndarray
    expected: float

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for t in range(len(self.feature)):
            at = np.zeros(len(x), np.int64)
            for _ in range(int(np.ceil(np.log2(TREE_ROWS))) + 1):
                f = self.feature[t, at]
                step = self.left[t, at] + (x[rows, np.maximum(f, 0)] >= self.cut[t, at])
                at = np.where(f < 0, at, step)
            total += self.path[t, at]
        return 2.0 ** (-total / max(len(self.feature), 1) / self.expected)


def expected_path(n: int) -> float:
    """Mean path of an unsuccessful search in a random binary tree of ``n`` rows."""
    return 0.0 if n < 2 else 1.0 if n == 2 else 2 * (np.log(n - 1) + np.euler_gamma) - 2 * (n - 1) / n


def grow_forest(x: np.ndarray, seed: int = 7) -> Forest:
    rng = np.random.default_rng(seed)
    size = min(TREE_ROWS, len(x))
    limit = int(np.ceil(np.log2(max(size, 2))))
    shape = (TREES, 4 * TREE_ROWS)
    forest = Forest(np.full(shape, -1), np.zeros(shape), np.zeros(shape, np.int64), np.zeros(shape), max(expected_path(size), 1.0))
    for t in range(TREES):
        open_nodes, free = [(0, x[rng.choice(len(x), size, replace=False)], 0)], 1
        while open_nodes:
            node, rows, depth = open_nodes.pop()
            low, high = rows.min(0), rows.max(0)
            usable = np.flatnonzero(high > low)
            if depth >= limit or len(rows) < 2 or not len(usable):
                forest.path[t, node] = depth + expected_path(len(rows))
                continue
            f = rng.choice(usable)
            cut = rng.uniform(low[f], high[f])
            beyond = rows[:, f] >= cut
            forest.feature[t, node], forest.cut[t, node], forest.left[t, node] = f, cut, free
            open_nodes += [(free, rows[~beyond], depth + 1), (free + 1, rows[beyond], depth + 1)]
            free += 2
    return forest


@dataclass
class Rules:
    """A fitted forest and its threshold, or none of both."""

    forest: Forest | None
    threshold: float

    def scores(self, features: np.ndarray) -> np.ndarray:
        return self.forest.score(features) if self.forest and len(features) else np.zeros(len(features))


def _matrix(batch: pa.RecordBatch, names: tuple[str, ...]) -> np.ndarray:
    return np.column_stack([batch.column(n).to_numpy(zero_copy_only=False) for n in names]) if batch.num_rows else np.zeros((0, len(names)))


def judge(measured: DataFrame, rules: Rules) -> DataFrame:
    """``doc_id``, counts, ``base_failed``, ``score``, ``threshold`` (above 1: nothing is rejected by it) and ``kept`` per
    measured row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            failed, scores = base_failed(_matrix(batch, COUNTS)), rules.scores(_matrix(batch, FEATURES))
            columns = {n: batch.column(n) for n in ("doc_id", *COUNTS)}
            columns |= {"base_failed": failed, "score": scores, "threshold": np.full(len(scores), float(rules.threshold)), "kept": ~failed & (scores < rules.threshold)}
            yield pa.record_batch({n: c if isinstance(c, pa.Array) else pa.array(c) for n, c in columns.items()})

    schema = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, score double, threshold double, kept boolean"
    return measured.mapInArrow(run, schema)


def fit(measured: DataFrame, labels: DataFrame) -> Rules:
    """Forest from a bounded sample of ``measured`` (a written table), threshold from all labelled rows."""
    sample = lowest_hashes(measured, measured.count(), FIT_ROWS, "doc_id", *FEATURES).select(*FEATURES).toArrow()
    if sample.num_rows < 2:
        return Rules(None, 2.0)
    forest = grow_forest(np.column_stack([sample.column(n).to_numpy() for n in FEATURES]))
    known = labels.where("quality IS NOT NULL").select(F.col("doc_id").cast("long").alias("_doc"), (F.col("quality") > 0).alias("good"))
    known = known.groupBy("_doc").agg(F.max("good").alias("good"))  # of contradicting labels the good one holds
    scored = judge(measured, Rules(forest, 2.0)).where("NOT base_failed").join(known, F.col("doc_id") == F.col("_doc"))
    bins = scored.groupBy(F.floor(F.col("score") * BINS).cast("int").alias("bin"), "good").count().collect()  # at most 2 rows per bin
    counts = np.zeros((2, BINS + 1), np.int64)
    for row in bins:
        counts[int(row["good"]), row["bin"]] += row["count"]
    above = counts[:, ::-1].cumsum(1)[:, ::-1]  # rows rejected by a threshold at the lower end of each bin
    good = counts[1].sum()
    allowed = np.flatnonzero(above[1] <= CLEAN_LOSS * good) if good else np.zeros(0, np.int64)
    return Rules(forest, allowed[0] / BINS if len(allowed) else 2.0)


def judged_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    measured = materialise(document_statistics(docs), "statistics")
    return judge(measured, fit(measured, labels))


def kept_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are kept, with the columns of ``documents``; texts are not shuffled."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang", "source", "n_chars")
    rules = fit(materialise(document_statistics(own), "statistics"), labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in slices(batches):
            found = [statistics(t, hashes) for t in texts(batch.column(1))]
            counts = np.array([f[0] for f in found], np.int64).reshape(-1, len(COUNTS))
            values = np.array([f[1] for f in found], np.float64).reshape(-1, len(FEATURES))
            yield batch.filter(pa.array(~base_failed(counts) & (rules.scores(values) < rules.threshold)))

    return own.mapInArrow(run, own.schema)
