"""Audit of filters that are applied one after another, in every order.

A document fails any of the filters; each order of them removes it at the first one it fails. All figures
follow from how many documents of a part (a language) fail which set of filters, so documents are reduced to counts
by mask, and the orders are laid over at most ``parts x 2 ** 5`` rows.

Filter E, "identical to the text of a smaller doc_id", is found by radix tries over whole texts:

1. **Reduce copies where they lie.** Each task gathers its rows by text in bounded portions: per text and
   ``part, good, toxic`` the number of rows, the least doc_id, the rows that hold it, and the rows without doc_id. Filters A to D
   depend on the text only and are evaluated once per portion and text.
2. **Adaptive prefixes.** Texts are grouped by their first ``STEP`` characters; prefixes that hold over ``LEAF_BYTES``
   (or a 4 096th of all bytes, so at most 4 096 of them) and more than one text are extended to twice the length, and so
   on. Each level is one aggregate over texts below heavy prefixes only.
3. **Tries.** Portions are range-partitioned and sorted by prefix, so the texts of a prefix lie in one task, one
   after another. Each prefix gets a compressed trie: edges are byte strings, the full text ends at a terminal that
   holds the least id and the counts. A traversal gives each group's duplicate flags - all rows with a
   doc_id above the least one - and only counts by mask leave the task. A task holds the texts of one
   prefix; texts that agree over long stretches share them.

Defined results: null is the empty text and the empty part; a null doc_id fails no E and makes nobody fail; rows that
repeat the smallest doc_id of a text do not fail E; a document is good (toxic) if any row of ``labels`` with its doc_id says
quality (toxic) 1. An empty table has no parts and no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.llm.small import joined
from lodestrata.llm.words import slices
from lodestrata.sources.workspace import discard, materialise

FILTERS = "ABCDE"
STEP = 8
LEAF_BYTES = 4 << 20
HEAVY_PREFIXES = 4096
PORTION_BYTES = 16 << 20
_CAPITALS = bytes(range(65, 91))
_MARKS = b"#$%&*|"


def own_failures(text: bytes) -> int:
    """The bits of filters A (1) to D (8) that a text fails by itself."""
    words = text.split()
    points = len(text) if text.isascii() else len(text.decode("utf-8", "replace"))
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    marks = len(text.translate(None, _MARKS)) < len(text)
    return (len(words) < 200) | (100 * len(set(words)) < 50 * len(words)) << 1 | (100 * capitals > 3 * points) << 2 | marks << 3


class Group:
    """Rows of one text and one ``part, good, toxic``."""

    __slots__ = ("rows", "least", "holders", "nameless")

    def __init__(self) -> None:
        self.rows, self.least, self.holders, self.nameless = 0, None, 0, 0

    def add(self, rows: int, least: int | None, holders: int, nameless: int) -> None:
        self.rows += rows
        self.nameless += nameless
        if least is None:
            return
        if self.least is None or least < self.least:
            self.least, self.holders = least, 0
        if least == self.least:
            self.holders += holders


class Trie:
    """A compressed trie: a node is ``[children by first byte, terminal]``, a child is ``(edge, node)``."""

    def __init__(self) -> None:
        self.root: list = [{}, None]

    def terminal(self, text: bytes) -> dict:
        """The groups at the end of ``text``, which is inserted if it is new."""
        node, at = self.root, 0
        while at < len(text):
            children = node[0]
            entry = children.get(text[at])
            if entry is None:
                leaf: list = [{}, {}]
                children[text[at]] = (text[at:], leaf)
                return leaf[1]
            edge, below = entry
            if text.startswith(edge, at):
                node, at = below, at + len(edge)
                continue
            same = _common(edge, text, at)
            middle: list = [{edge[same]: (edge[same:], below)}, None]
            children[text[at]] = (edge[:same], middle)
            node, at = middle, at + same
        if node[1] is None:
            node[1] = {}
        return node[1]

    def terminals(self) -> Iterator[dict]:
        """All terminals, without recursion."""
        open_ = [self.root]
        while open_:
            children, terminal = open_.pop()
            if terminal is not None:
                yield terminal
            open_ += [node for _, node in children.values()]


def _common(edge: bytes, text: bytes, at: int) -> int:
    """Length of the common prefix of ``edge`` and ``text[at:]``, which differ before the end of ``edge``."""
    low, high = 1, min(len(edge), len(text) - at)
    while low < high:
        middle = (low + high + 1) // 2
        if text.startswith(edge[:middle], at):
            low = middle
        else:
            high = middle - 1
    return low


_PORTION = "text string, mask int, part string, good boolean, toxic boolean, rows long, least long, holders long, nameless long"
_PORTION_TYPES = (pa.string(), pa.int32(), pa.string(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
_COUNTS = "part string, mask int, good boolean, toxic boolean, rows long"


def _portions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows gathered by text, flushed whenever ``PORTION_BYTES`` of texts are held."""
    held: dict[bytes, dict] = {}
    size = 0

    def flush() -> Iterator[pa.RecordBatch]:
        nonlocal size
        out = []
        for text, groups in held.items():
            mask = own_failures(text)
            out += [(text, mask, *key, g.rows, g.least, g.holders, g.nameless) for key, g in groups.items()]
            if len(out) >= 1024:
                yield _batch(out)
                out = []
        held.clear()
        size = 0
        yield _batch(out)

    for batch in slices(batches, 256):
        ids, texts, *keys = (c.to_pylist() for c in (batch.column(0), batch.column(1).cast(pa.binary()), *batch.columns[2:]))
        for doc_id, text, *key in zip(ids, texts, *keys):
            text = text or b""
            groups = held.get(text)
            if groups is None:
                groups = held[text] = {}
                size += len(text) + 200
            group = groups.setdefault(tuple(key), Group())
            group.add(1, doc_id, int(doc_id is not None), int(doc_id is None))
        if size > PORTION_BYTES:
            yield from flush()
    yield from flush()


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(_PORTION_TYPES)
    names = [c.split()[0] for c in _PORTION.split(", ")]
    arrays = [pa.array(c, pa.binary()).cast(pa.string()) if n == "text" else pa.array(c, t) for n, c, t in zip(names, columns, _PORTION_TYPES)]
    return pa.record_batch(arrays, names)


def _audit_tries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted portions to counts by mask: one trie per prefix."""
    counts: dict[tuple, int] = {}
    trie, current = Trie(), None

    def flush() -> pa.RecordBatch:
        rows = [(part, mask, good, toxic, n) for (part, mask, good, toxic), n in counts.items() if n]
        counts.clear()
        columns = list(zip(*rows)) or [()] * 5
        types = (pa.string(), pa.int32(), pa.bool_(), pa.bool_(), pa.int64())
        return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], [c.split()[0] for c in _COUNTS.split(", ")])

    def reduce() -> None:
        for groups in trie.terminals():
            least = min((g.least for g in groups.values() if g.least is not None), default=None)
            for (mask, part, good, toxic), g in groups.items():
                first = g.nameless + (g.holders if g.least == least and least is not None else 0)
                for bits, n in ((mask, first), (mask | 16, g.rows - first)):
                    counts[part, bits, good, toxic] = counts.get((part, bits, good, toxic), 0) + n

    for batch in slices(batches, 256):
        keys, texts, *others = (c.to_pylist() for c in (batch.column(0), batch.column(1).cast(pa.binary()), *batch.columns[2:]))
        for key, text, mask, part, good, toxic, *numbers in zip(keys, texts, *others):
            if key != current:
                reduce()
                trie, current = Trie(), key
                if len(counts) > 10_000:
                    yield flush()
            trie.terminal(text).setdefault((mask, part, good, toxic), Group()).add(*numbers)
    reduce()
    yield flush()


def adaptive_prefix(texts: DataFrame, leaf_bytes: int = LEAF_BYTES) -> Column:
    """The prefix of ``text`` by which texts are dealt out, from counts of all of ``texts``."""
    size = F.octet_length("text")
    total = texts.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    most = max(leaf_bytes, total // HEAVY_PREFIXES)
    prefix, length, open_ = F.substring("text", 1, STEP), STEP, F.lit(True)
    while True:
        level = F.xxhash64(F.substring("text", 1, length))
        grouped = texts.where(open_).groupBy(level.alias("prefix"))
        distinct = F.min(F.xxhash64("text")) < F.max(F.xxhash64("text"))
        heavy = grouped.agg(F.sum(size).alias("bytes"), distinct.alias("several")).where((F.col("bytes") > most) & F.col("several"))
        found = [r["prefix"] for r in heavy.select("prefix").collect()]  # at most HEAVY_PREFIXES, since each holds over `most` bytes
        if not found:
            return prefix
        open_ = open_ & level.isin(found)
        length *= 2
        prefix = F.when(open_, F.substring("text", 1, length)).otherwise(prefix)


def failure_counts(docs: DataFrame, labels: DataFrame, leaf_bytes: int = LEAF_BYTES) -> DataFrame:
    """``part, mask, good, toxic, rows``: documents of a part by the set of filters that they fail (bits 1 to 16 for A to E)."""

    def says(name: str) -> Column:
        return F.coalesce(F.max(F.col(name) == 1), F.lit(False)).alias(f"_{name}")

    marked = labels.where("quality = 1 OR toxic = 1").groupBy(F.col("doc_id").cast("long").alias("_id")).agg(says("quality"), says("toxic"))
    marked = materialise(marked.where("_id IS NOT NULL"), "marked")
    own = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), F.coalesce("lang", F.lit("")).alias("part")
    )
    rows = joined(own, marked, own["doc_id"] == F.col("_id"), "left", 24).select(
        "doc_id", "text", "part", F.coalesce("_quality", F.lit(False)).alias("good"), F.coalesce("_toxic", F.lit(False)).alias("toxic")
    )
    portions = materialise(rows.mapInArrow(_portions, _PORTION), "portions")
    total = portions.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // leaf_bytes))
    keyed = portions.withColumn("key", adaptive_prefix(portions, leaf_bytes)).select("key", *portions.columns)
    dealt = keyed.repartitionByRange(parts, "key").sortWithinPartitions("key")
    counts = dealt.mapInArrow(_audit_tries, _COUNTS).groupBy("part", "mask", "good", "toxic").agg(F.sum("rows").alias("rows"))
    counts = materialise(counts, "counts")
    discard(portions)
    return counts


def _steps() -> list[dict]:
    """The steps of all orders: the filter's bit and the bits applied before it."""
    out = []
    for order in permutations(FILTERS):
        before = 0
        for step, letter in enumerate(order, 1):
            bit = 1 << FILTERS.index(letter)
            out.append({"filter_order": "".join(order), "step": step, "bit": bit, "before": before})
            before |= bit
    return out


def audit(docs: DataFrame, labels: DataFrame, leaf_bytes: int = LEAF_BYTES) -> DataFrame:
    """Per part, order and step: ``kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley``."""
    counts = failure_counts(docs, labels, leaf_bytes)
    steps = F.from_json(
        F.lit(str(_steps()).replace("'", '"')), "array<struct<filter_order:string,step:int,bit:int,before:int>>"
    )
    mask, bit, before = F.col("mask"), F.col("s.bit"), F.col("s.before")
    fails = mask.bitwiseAND(bit) > 0
    here = fails & (mask.bitwiseAND(before) == 0)
    # of the orders of the filters that a document fails, one in so many begins with a given one
    share = F.when(fails, F.lit(len(list(permutations(FILTERS)))) / F.bit_count(mask)).otherwise(0).cast("long")

    def total(condition: Column, name: str) -> Column:
        return F.sum(F.when(condition, F.col("rows")).otherwise(0)).alias(name)

    return (
        counts.withColumn("s", F.explode(steps))
        .groupBy("part", F.col("s.filter_order").alias("filter_order"), F.col("s.step").alias("step"))
        .agg(
            total(mask.bitwiseAND(before.bitwiseOR(bit)) == 0, "kept"),
            total(here, "removed"),
            total(fails & ~here, "redundant"),
            total(mask == bit, "unique_fails"),
            total(here & F.col("good"), "good_lost"),
            total(here & F.col("toxic"), "toxic_lost"),
            F.sum(F.col("rows") * share).alias("shapley"),
        )
    )
