"""Substring deduplication by relative Lempel-Ziv parsing.

All documents together are the reference, indexed in blocks of ``BLOCK`` words: of every ``GRID``
consecutive blocks the one with the least hash is an anchor (so equal passages of ``WINDOW`` words have
an anchor in common), and the index holds the earliest place of each. A document is factored against
it: anchors that point into one place of the reference, at one distance and without a gap, join into
the longest factor. A factor of at least ``WINDOW`` words repeats words that start earlier, so it is a
duplicate span.

A greedy factor may end before a repetition does, and a window across a boundary may repeat a third
place. So the boundaries are checked. An anchor is open if a window around it may lie outside all factors
and it is not at its own earliest place, where no window can be a repetition. Windows of open
anchors, and those at the earliest places of these anchors, are hashed (128 bits): one is a duplicate if its words start earlier in
another. The earliest occurrence of a window lies in no factor, so it is among them. Windows are judged on
the input, not on what is left.

Order is by ``doc_id``, null last, then start. Defined results: null and empty texts have no words;
rows that repeat a doc_id count as the same document, so equal starts in them are not earlier; an
equal row gets an equal result, and their anchors and windows are gathered once. An empty table gives no rows. Extra columns are ignored. Results do
not depend on how the rows are spread over files.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.llm.words import WordHashes, mixed, running, slices, spans, texts
from lodestrata.sources.workspace import discard, materialise

WINDOW = 20
BLOCK = 11
GRID = WINDOW - BLOCK + 1
LAST = (1 << 63) - 1
BROADCAST_BYTES = 32 << 20


def _own(docs: DataFrame) -> DataFrame:
    """``doc_id, text, doc``; ``doc`` orders documents."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return own.withColumn("doc", F.coalesce("doc_id", F.lit(LAST)))


def _tag(text: bytes) -> int:
    """Tells rows apart that repeat a doc_id."""
    return xxhash.xxh32_intdigest(text) - (1 << 31)


def anchors_of(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each window of the document its anchor's start, and the block hashes by start."""
    if len(hashes) < WINDOW:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    blocks = spans(running(hashes), np.arange(len(hashes) - BLOCK + 1), BLOCK)
    grid = np.lib.stride_tricks.sliding_window_view(blocks, GRID)
    return grid.argmin(1) + np.arange(len(grid)), blocks


def _index(docs: DataFrame) -> DataFrame:
    """``anchor, doc, tag, pos`` of all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in slices(batches):
            keys, at, sizes, tags = [], [], [], []
            for text in texts(batch.column(1)):
                starts, blocks = anchors_of(hashes.of(text.split()))
                starts = np.unique(starts)
                keys.append(blocks[starts])
                at.append(starts)
                sizes.append(len(starts))
                tags.append(_tag(text))
            yield pa.record_batch(
                {
                    "anchor": pa.array(np.concatenate(keys).view(np.int64)),
                    "doc": pa.array(np.repeat(batch.column(2).to_numpy(), sizes)),
                    "tag": pa.array(np.repeat(np.array(tags, np.int32), sizes)),
                    "pos": pa.array(np.concatenate(at).astype(np.int32)),
                }
            )

    return _own(docs).mapInArrow(run, "anchor long, doc long, tag int, pos int")


def _pointers(index: DataFrame) -> DataFrame:
    """Per document ``found``: the anchors that occur earlier too, with their earliest place."""
    earliest = index.groupBy("anchor").agg(F.min(F.struct("doc", "pos", "tag")).alias("ref"), F.count("*").alias("times"))
    met = index.join(earliest.where("times > 1").select("anchor", "ref"), "anchor").where(F.struct("doc", "pos", "tag") != F.col("ref"))
    place = F.struct("pos", F.col("ref.doc").alias("ref_doc"), F.col("ref.tag").alias("ref_tag"), F.col("ref.pos").alias("ref_pos"))
    return met.groupBy("doc", "tag").agg(F.collect_set(place).alias("found"))  # repeated rows add nothing


def factors(pos: np.ndarray, doc: np.ndarray, tag: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (in words) of the maximal runs of pointers into one place without a gap."""
    shift = pos - at
    order = np.lexsort((pos, shift, tag, doc))
    pos, doc, tag, shift = pos[order], doc[order], tag[order], shift[order]
    new = np.ones(len(pos), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1]) | (shift[1:] != shift[:-1]) | (pos[1:] - pos[:-1] > BLOCK)
    firsts = np.flatnonzero(new)
    lasts = np.append(firsts[1:], len(pos)) - 1 if len(pos) else firsts
    return pos[firsts], pos[lasts] + BLOCK


def _within(at: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """Which anchors have all windows around them inside one of the disjoint-start, sorted ``spans``."""
    if not len(spans):
        return np.zeros(len(at), bool)
    first, last = np.maximum(at - GRID + 1, 0), at + WINDOW
    stops = np.maximum.accumulate(spans[:, 1])
    before = np.searchsorted(spans[:, 0], first, "right")
    return (before > 0) & (stops[np.maximum(before, 1) - 1] >= last)


def _parsed(found: DataFrame) -> DataFrame:
    """Per document its factors, packed, and the open anchors with their earliest places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            lists = batch.column(2)
            ends = lists.offsets.to_numpy()
            flat = lists.flatten()
            pos, doc, tag, at = (flat.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4))
            open_, sizes, out = [], [], []
            for i in range(batch.num_rows):
                part = slice(ends[i] - ends[0], ends[i + 1] - ends[0])
                earlier = (doc[part] != batch.column(0)[i].as_py()) | (at[part] < pos[part])
                starts, stops = factors(*(x[part][earlier] for x in (pos, doc, tag, at)))
                held = np.column_stack([starts, stops])[stops - starts >= WINDOW]
                held = held[np.argsort(held[:, 0], kind="stable")]
                out.append(held.astype(np.int32).tobytes())
                left = np.flatnonzero(~_within(pos[part], held)) + part.start
                open_.append(left)
                sizes.append(len(left))
            chosen = flat.take(pa.array(np.concatenate(open_)))
            offsets = pa.array(np.cumsum([0, *sizes]).astype(np.int32))
            yield pa.record_batch({"doc": batch.column(0), "tag": batch.column(1), "factors": out_binary(out), "open": pa.ListArray.from_arrays(offsets, chosen)})

    place = "struct<pos:int,ref_doc:long,ref_tag:int,ref_pos:int>"
    return found.mapInArrow(run, f"doc long, tag int, factors binary, open array<{place}>")


def _checked(parsed: DataFrame) -> DataFrame:
    """``doc, tag, met, factors``: the anchors whose windows are to be hashed, packed, and the document's factors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            met = [packed(np.array(sorted(at), np.int64)) for at in batch.column(2).to_pylist()]
            yield pa.record_batch({"doc": batch.column(0), "tag": batch.column(1), "met": out_binary(met)})

    places = parsed.select("doc", "tag", F.explode("open").alias("p"))
    wanted = places.select("doc", "tag", "p.pos").unionByName(
        places.select(F.col("p.ref_doc").alias("doc"), F.col("p.ref_tag").alias("tag"), F.col("p.ref_pos").alias("pos")).distinct()
    )
    met = wanted.groupBy("doc", "tag").agg(F.collect_set("pos").alias("at")).mapInArrow(run, "doc long, tag int, met binary")
    return met.join(parsed.select("doc", "tag", "factors"), ["doc", "tag"], "left").withColumn("factors", F.coalesce("factors", F.lit(b"")))


def packed(positions: np.ndarray) -> bytes:
    """Increasing positions as compressed steps."""
    return zlib.compress(np.diff(positions, prepend=0).astype(np.int32).tobytes(), 1)


def unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zlib.decompress(data), np.int32))


def out_binary(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary())


def _with_text(docs: DataFrame, small: DataFrame, size: str, how: str) -> DataFrame:
    """Documents with what is known of them; beyond a checked size both sides are shuffled."""
    tagged = _own(docs).mapInArrow(_add_tag, "doc_id long, text string, doc long, tag int")
    held = small.agg(F.sum(F.expr(size) + 64)).first()[0] or 0
    return tagged.join(F.broadcast(small) if held <= BROADCAST_BYTES else small, ["doc", "tag"], how)


def _add_tag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        yield batch.append_column("tag", pa.array([_tag(t) for t in texts(batch.column(1))], pa.int32()))


def _open_windows(docs: DataFrame, checked: DataFrame) -> DataFrame:
    """``doc, tag, start, h1, h2`` of the windows outside factors that have one of the anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in slices(batches):
            docs_, tags, starts, first, second = [], [], [], [], []
            for text, doc, tag, met, held in zip(texts(batch.column(0)), *(batch.column(i).to_pylist() for i in range(1, 5)), strict=True):
                own = hashes.of(text.split())
                anchor, _ = anchors_of(own)
                open_ = np.zeros(len(own) + 1, bool)
                open_[unpacked(met)] = True
                open_ = open_[anchor]
                for start, stop in np.frombuffer(held, np.int32).reshape(-1, 2):
                    open_[start : stop - WINDOW + 1] = False
                at = np.flatnonzero(open_)
                if len(at):
                    docs_.append(np.full(len(at), doc))
                    tags.append(np.full(len(at), tag, np.int32))
                    starts.append(at.astype(np.int32))
                    first.append(spans(running(own), at, WINDOW))
                    second.append(spans(running(mixed(own ^ np.uint64(WINDOW))), at, WINDOW))
            if starts:
                yield pa.record_batch(
                    {
                        "doc": pa.array(np.concatenate(docs_)),
                        "tag": pa.array(np.concatenate(tags)),
                        "start": pa.array(np.concatenate(starts)),
                        "h1": pa.array(np.concatenate(first).view(np.int64)),
                        "h2": pa.array(np.concatenate(second).view(np.int64)),
                    }
                )

    joined = _with_text(docs, checked, "length(met) + length(factors)", "inner")
    return joined.select("text", "doc", "tag", "met", "factors").mapInArrow(run, "doc long, tag int, start int, h1 long, h2 long")


def duplicate_windows(windows: DataFrame) -> DataFrame:
    """``doc, tag, starts``: the windows whose words start earlier too."""
    earliest = windows.groupBy("h1", "h2").agg(F.min(F.struct("doc", "start")).alias("ref"), F.count("*").alias("times")).where("times > 1")
    later = windows.join(earliest, ["h1", "h2"]).where(F.struct("doc", "start") > F.col("ref"))
    return later.groupBy("doc", "tag").agg(F.collect_set("start").alias("starts"))


def _spans(parsed: DataFrame, windows: DataFrame) -> DataFrame:
    """``doc, tag, spans``: starts and ends of the words to remove, disjoint and in order, packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = []
            for held, starts in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                pairs = np.frombuffer(held or b"", np.int32).reshape(-1, 2).astype(np.int64)
                alone = np.array(starts or [], np.int64)
                pairs = np.concatenate([pairs, np.column_stack([alone, alone + WINDOW])])
                out.append(merged(pairs).astype(np.int32).tobytes())
            yield pa.record_batch({"doc": batch.column(0), "tag": batch.column(1), "spans": out_binary(out)})

    both = parsed.where("length(factors) > 0").select("doc", "tag", "factors").join(windows, ["doc", "tag"], "full")
    return both.select("doc", "tag", "factors", "starts").mapInArrow(run, "doc long, tag int, spans binary")


def merged(pairs: np.ndarray) -> np.ndarray:
    """Disjoint intervals that cover the same words."""
    if not len(pairs):
        return pairs
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
    stops = np.maximum.accumulate(pairs[:, 1])
    new = np.append(True, pairs[1:, 0] > stops[:-1])
    return np.column_stack([pairs[new, 0], stops[np.append(np.flatnonzero(new)[1:], len(pairs)) - 1]])


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        sizes, removed, kept = [], [], []
        for text, held in zip(texts(batch.column(1)), batch.column(2).to_pylist(), strict=True):
            words = text.split()
            pairs = np.frombuffer(held or b"", np.int32).reshape(-1, 2)
            parts, at = [], 0
            for start, stop in pairs:
                parts += words[at:start]
                at = stop
            parts += words[at:]
            sizes.append(len(words))
            removed.append(len(words) - len(parts))
            kept.append(b" ".join(parts).decode())
        yield pa.record_batch(
            {"doc_id": batch.column(0), "n_words": pa.array(sizes, pa.int64()), "n_removed": pa.array(removed, pa.int64()), "kept": pa.array(kept, pa.string())}
        )


def without_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_removed, kept`` per row of ``docs``; ``kept`` joins the kept words by blanks."""
    index = materialise(_index(docs), "anchors")
    parsed = materialise(_parsed(_pointers(index)), "parsed")
    discard(index)
    checked = materialise(_checked(parsed), "checked")
    windows = materialise(_open_windows(docs, checked), "windows")
    discard(checked)
    removed = materialise(_spans(parsed, duplicate_windows(windows)), "removed")
    discard(windows)
    discard(parsed)
    found = _with_text(docs, removed, "length(spans)", "left")
    return found.select("doc_id", "text", "spans").mapInArrow(_kept, "doc_id long, n_words long, n_removed long, kept string")
