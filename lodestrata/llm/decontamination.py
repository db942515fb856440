"""Benchmark decontamination by winnowed fingerprints.

Words are runs of digits, letters and characters beyond ASCII, ``A-Z`` lower-cased. A window is ``size``
consecutive words of a benchmark item, or the whole item if it has fewer words, but not none. A word of a
document is hit if it lies in an occurrence of a window.

1. **Winnow.** Of each run of ``size - gram + 1`` consecutive hashes of ``gram`` words the least one (the
   last of equal ones) is kept, on both sides. Two texts that share ``size`` words share all hashes of
   such a run, so they keep the same one: no shared window is missed. An item that is one short window is
   its own fingerprint, and the documents are read for whole runs of its length.
2. **Join.** Fingerprints of items set bits in a map of ``MAP_BITS`` bits, which goes to all tasks; a
   document's fingerprints that miss it are dropped in the task that made them. What is left is joined with the
   items' fingerprints: the map saves rows, the join decides.
3. **Extend.** A fingerprint that is met is extended to all windows that hold it, which are joined with the items'
   windows by 128-bit digests. Hit words are the union of their spans.

Texts stay where they are: one pass over them, then narrow rows only. Results belong to a text, so copies
are gathered to one before the joins. A task holds a few arrays as long as its longest text; the driver holds the
bit map (4 MB) and the lengths of short items (fewer than ``size``).

Defined results: null and empty texts have no words and no hits; equal rows get equal results, each row its
own; rows of items that share an item_id are one item; an item whose item_id is null marks hits but is not
counted or listed; items without words have no window. Without items nothing is hit; without documents
there are no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.llm.small import joined
from lodestrata.llm.words import WordHashes, running, slices, spans, texts
from lodestrata.sources.workspace import discard, materialise

SIZE = 10
GRAM = 5
MAP_BITS = 1 << 25
_KEPT = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256)).lower()


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_KEPT).split()


def winnowed(grams: np.ndarray, run: int) -> np.ndarray:
    """Places of the least hash of every ``run`` consecutive ones, the last of equal ones."""
    n = len(grams) - run + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    least, at = grams[:n].copy(), np.arange(n)
    first = at.copy()
    for j in range(1, run):
        later = grams[j : n + j]
        below = later <= least
        least[below] = later[below]
        at[below] = first[below] + j
    return at[np.append(True, at[1:] != at[:-1])]


def fingerprints(hashes: np.ndarray, size: int, gram: int, short: list[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(window length, places, fingerprints)``: the winnowed ones of whole windows, all runs of the ``short`` lengths."""
    sums = running(hashes)
    if len(hashes) >= size:
        grams = spans(sums, np.arange(len(hashes) - gram + 1), gram)
        at = winnowed(grams, size - gram + 1)
        yield size, at, grams[at]
    for length in short:
        if len(hashes) >= length:
            at = np.arange(len(hashes) - length + 1)
            yield length, at, spans(sums, at, length)


def digest(words: list[bytes]) -> bytes:
    return hashlib.md5(b" ".join(words)).digest()


def _item_parts(items: DataFrame, size: int, gram: int) -> DataFrame:
    """``item_id, length, print, window``: fingerprints (window null) and windows (print null) of the items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = WordHashes()
        for batch in slices(batches, 256):
            out: list[tuple[str | None, int, int | None, bytes | None]] = []
            for item, text in zip(batch.column(0).to_pylist(), texts(batch.column(1))):
                words = words_of(text)
                length = min(len(words), size)
                if not length:
                    continue
                hashes = hashed.of(words)
                for _, _, prints in fingerprints(hashes, size, gram, [length] if length < size else []):
                    out += [(item, length, p, None) for p in prints.view(np.int64).tolist()]
                out += [(item, length, None, digest(words[i : i + length])) for i in range(len(words) - length + 1)]
            columns = list(zip(*out)) or [(), (), (), ()]
            types = (pa.string(), pa.int32(), pa.int64(), pa.binary())
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], ["item_id", "length", "print", "window"])

    own = items.select(F.col("item_id").cast("string").alias("item_id"), "text")
    return own.mapInArrow(run, "item_id string, length int, print long, window binary")


def _bit_map(prints: DataFrame) -> np.ndarray:
    """The bits of all fingerprints: at most ``MAP_BITS / 32768`` rows of 4 KB come to the driver."""
    bit = F.col("print").bitwiseAND(F.lit(MAP_BITS - 1).cast("long")) + 1  # buckets count from bit 1
    parts = prints.groupBy(F.bitmap_bucket_number(bit).alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits"))
    out = np.zeros(MAP_BITS // 8, np.uint8)
    for row in parts.collect():
        start = (row["part"] - 1) * 4096
        out[start : start + 4096] = np.frombuffer(bytes(row["bits"]), np.uint8)
    return out


def _may_hold(bits: np.ndarray, prints: np.ndarray) -> np.ndarray:
    at = prints & np.uint64(MAP_BITS - 1)
    return (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0


_SPANS = "array<struct<start:int,end:int>>"
_FOUND = "doc_id long, n_words long, text_key binary, found array<struct<print:long,starts:array<int>,length:int,windows:array<binary>>>"
_FOUND_TYPE = pa.list_(
    pa.struct([("print", pa.int64()), ("starts", pa.list_(pa.int32())), ("length", pa.int32()), ("windows", pa.list_(pa.binary()))])
)


def _document_parts(docs: DataFrame, size: int, gram: int, short: list[int], bits: np.ndarray) -> DataFrame:
    """Per row its words' number and the fingerprints that the map holds, each with the windows around it."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed, held = WordHashes(), shared.value
        for batch in slices(batches, 256):
            counts, keys, found = [], [], []
            for text in texts(batch.column(1)):
                words = words_of(text)
                met = []
                if words:
                    for length, at, prints in fingerprints(hashed.of(words), size, gram, short):
                        for i in np.flatnonzero(_may_hold(held, prints)).tolist():
                            place = int(at[i])
                            first = max(0, place + gram - size) if length == size else place
                            last = min(place, len(words) - size) if length == size else place
                            starts = range(first, last + 1)
                            met.append(
                                {
                                    "print": int(prints[i].view(np.int64)),
                                    "starts": list(starts),
                                    "length": length,
                                    "windows": [digest(words[s : s + length]) for s in starts],
                                }
                            )
                counts.append(len(words))
                keys.append(hashlib.md5(text).digest() if met else None)
                found.append(met)
            yield pa.record_batch(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(keys, pa.binary()), pa.array(found, _FOUND_TYPE)],
                ["doc_id", "n_words", "text_key", "found"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _FOUND)


def _met(docs: DataFrame, items: DataFrame, size: int, gram: int) -> tuple[DataFrame, DataFrame]:
    """``doc_id, n_words, text_key`` of all rows (key null: surely nothing hit), and ``text_key, items, hits`` of hit texts."""
    parts = materialise(_item_parts(items, size, gram), "items")
    prints = materialise(parts.where("print IS NOT NULL").select("print").distinct(), "prints")
    windows = materialise(parts.where("window IS NOT NULL").select("window", "item_id").distinct(), "windows")
    short = sorted(r["length"] for r in parts.where(F.col("length") < size).select("length").distinct().collect())
    rows = materialise(_document_parts(docs, size, gram, short, _bit_map(prints)), "rows")
    # one row per text, then fingerprint against fingerprint, then window against window
    single = rows.where("text_key IS NOT NULL").groupBy("text_key").agg(F.first("found").alias("found"))
    marks = single.select("text_key", F.explode("found").alias("mark")).select("text_key", "mark.*")
    shared = joined(marks, prints, "print", "left_semi", 24)
    around = shared.select("text_key", "length", F.explode(F.arrays_zip("starts", "windows")).alias("at"))
    around = around.select("text_key", "length", F.col("at.starts").alias("start"), F.col("at.windows").alias("window")).distinct()
    hits = joined(around, windows, "window", "inner", 64)
    span = F.struct(F.col("start").alias("start"), (F.col("start") + F.col("length")).alias("end"))
    per_text = hits.groupBy("text_key").agg(F.sort_array(F.collect_set("item_id")).alias("items"), _union(F.collect_set(span)).alias("hits"))
    per_text = materialise(per_text, "texts")
    for table in (parts, prints, windows):
        discard(table)
    return rows.drop("found"), per_text


def _union(found: Column) -> Column:
    """Overlapping and touching spans joined, in order."""

    def add(done: Column, span: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        grown = F.struct(last["start"].alias("start"), F.greatest(last["end"], span["end"]).alias("end"))
        before = F.slice(done, F.lit(1), F.size(done) - 1)
        return F.when(last["end"] >= span["start"], F.concat(before, F.array(grown))).otherwise(F.concat(done, F.array(span)))

    return F.aggregate(F.sort_array(found), F.lit([]).cast(_SPANS), add)


def contamination(docs: DataFrame, items: DataFrame, size: int = SIZE, gram: int = GRAM) -> DataFrame:
    """``doc_id, n_words, n_hit, items, hits`` per row of ``docs``: the sorted ids of items met (as text), and the spans
    of hit words, end exclusive, in order."""
    rows, per_text = _met(docs, items, size, gram)
    width = F.octet_length(F.array_join("items", ",")) + 16 * F.size("items") + 8 * F.size("hits") + 48
    widest = per_text.agg(F.max(width)).first()[0] or 0
    found = joined(rows.where("text_key IS NOT NULL"), per_text, "text_key", "left", widest)
    none = [F.lit(None).cast("array<string>").alias("items"), F.lit(None).cast(_SPANS).alias("hits")]
    out = found.unionByName(rows.where("text_key IS NULL").select("*", *none))
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return out.select(
        "doc_id",
        "n_words",
        F.coalesce(n_hit, F.lit(0)).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("hits", F.lit([]).cast(_SPANS)).alias("hits"),
    )


def clean_documents(docs: DataFrame, items: DataFrame, size: int = SIZE, gram: int = GRAM) -> DataFrame:
    """The rows of ``docs`` whose text holds no window, with all their columns."""
    _, per_text = _met(docs.select(F.lit(0).alias("doc_id"), "text"), items, size, gram)
    own = F.unhex(F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")))
    return joined(docs, per_text.select("text_key"), own == F.col("text_key"), "left_anti", 48)


def digests(docs: DataFrame, items: DataFrame, size: int = SIZE, gram: int = GRAM) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` per row of ``docs``."""
    return contamination(docs, items, size, gram).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
