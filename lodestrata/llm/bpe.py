"""Byte-level BPE encoding and decoding with the ranks of a public vocabulary file.

A piece (a match of the split pattern) is encoded by a fold of Spark higher-order functions: its bytes
are parts, each step joins the first pair whose bytes have the lowest rank, and ranks come from a literal
map, cut into buckets by CRC so that a look-up reads a handful of entries. A piece that is a token as a
whole is that token. Decoding concatenates the tokens' bytes.

Distinct words are encoded, not occurrences: the most frequent ones, at most ``DICTIONARY_WORDS``, once for
the whole corpus, as a packed dictionary of bounded size that goes to all tasks; the rest by the same
fold in the row where they stand, once per document. Texts are not shuffled; only distinct words are, with
their counts. Pieces of over ``LONG_BYTES`` bytes, for which a fold would take quadratic time, are merged by
a heap over linked parts, which gives the same ids in about linear time.

With the pattern of the vocabulary files texts are cut at blanks first, since a blank followed by no other white space
always starts a piece. A text with a blank before other white space, and any text under another pattern, is split by the
pattern as a whole. The texts of a slice of rows are worked on at once: their distinct words are split and looked up, and the
ids of all words are gathered by array operations.

The dictionary is searched by 64-bit hashes; an entry counts only if its ids decode to the word, so a word that
shares the hash of another is folded like a rare one.

Defined results: null and empty texts have no tokens and decode to nothing; equal rows get equal results;
special tokens are ordinary text. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import json
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.llm.words import slices
from lodestrata.sources.workspace import discard, materialise

DICTIONARY_WORDS = 1 << 21
LONG_BYTES = 96
TABLE = 16_384
NONE = (1 << 31) - 1
# letters of the first Unicode blocks, which the pattern of the vocabulary files never splits
_LETTERS_ONLY = "^[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017f]+$"
_LETTERS = re.compile(_LETTERS_ONLY[1:-1]).fullmatch
COUNTED_BYTES = 8 << 20
SLICE_ROWS = 256


def load_ranks(path: str) -> dict[bytes, int]:
    """A vocabulary file: lines of a base64 token and its rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def rank_table(ranks: dict[bytes, int]) -> Column:
    """The literal map from a token's bytes in hex to its rank, in ``TABLE`` buckets."""
    buckets: list[dict[str, int]] = [{} for _ in range(TABLE)]
    for token, rank in ranks.items():
        key = token.hex().upper()
        buckets[zlib.crc32(key.encode()) % TABLE][key] = rank
    return F.from_json(F.lit(json.dumps(buckets)), "array<map<string,int>>")


def fold(word: Column, table: Column) -> Column:
    """Token ids of one piece, given as text."""
    empty = F.array().cast("array<int>")

    def with_table(ranks: Column) -> Column:
        def rank(key: Column) -> Column:
            bucket = F.get(ranks, F.crc32(key.cast("binary")).bitwiseAND(F.lit(TABLE - 1).cast("long")).cast("int"))
            return F.coalesce(F.try_element_at(bucket, key), F.lit(NONE))

        def merge(state: Column) -> Callable[[Column], Column]:
            parts, pairs = state["parts"], state["pairs"]

            def at(i: Column) -> Column:  # 1-based place of the pair
                def joined(token: Column) -> Column:
                    left = F.when(i > 1, F.concat(F.slice(pairs, F.lit(1), i - 2), F.array(rank(F.concat(F.get(parts, i - 2), token)))))
                    right = F.when(
                        i < F.size(pairs), F.concat(F.array(rank(F.concat(token, F.get(parts, i + 1)))), F.slice(pairs, i + 2, F.size(pairs)))
                    )
                    return F.struct(
                        F.concat(F.slice(parts, F.lit(1), i - 1), F.array(token), F.slice(parts, i + 2, F.size(parts))).alias("parts"),
                        F.concat(left.otherwise(empty), right.otherwise(empty)).alias("pairs"),
                    )

                return bound(F.concat(F.get(parts, i - 1), F.get(parts, i)), joined)

            return at

        def step(state: Column, _: Column) -> Column:
            return bound(
                F.coalesce(F.array_min(state["pairs"]), F.lit(NONE)),
                lambda least: F.when(least < NONE, bound(F.array_position(state["pairs"], least).cast("int"), merge(state))).otherwise(state),
            )

        def merged(parts: Column) -> Column:
            pairs = F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda i: rank(F.concat(F.get(parts, i - 1), F.get(parts, i))))
            start = F.struct(parts.alias("parts"), F.when(F.size(parts) > 1, pairs).otherwise(empty).alias("pairs"))
            return F.aggregate(F.sequence(F.lit(1), F.size(parts)), start, step, lambda end: F.transform(end["parts"], rank))

        def whole(key: Column) -> Column:
            letters = F.transform(F.sequence(F.lit(1), F.length(key), F.lit(2)), lambda i: F.substr(key, i, F.lit(2)))
            return bound(rank(key), lambda own: F.when(own < NONE, F.array(own)).otherwise(bound(letters, merged)))

        return bound(F.hex(word.cast("binary")), whole)

    return bound(table, with_table)


def merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges for a long piece: a heap of pairs over linked parts."""
    if piece in ranks:
        return [ranks[piece]]
    n = len(piece)
    end, before = list(range(1, n + 1)), list(range(-1, n - 1))  # the part that starts at i, and the one before it
    live = [True] * n
    heap = []

    def push(i: int) -> None:
        if i >= 0 and end[i] < n:
            rank = ranks.get(piece[i : end[end[i]]])
            if rank is not None:
                heapq.heappush(heap, (rank, i, end[end[i]]))

    for i in range(n - 1):
        push(i)
    while heap:
        _, i, stop = heapq.heappop(heap)
        if not live[i] or end[i] >= n or end[end[i]] != stop or end[i] == stop:
            continue
        live[end[i]] = False
        end[i] = stop
        if stop < n:
            before[stop] = i
        push(i)
        push(before[i])
    return [ranks[piece[i : end[i]]] for i in range(n) if live[i]]


class Splitter:
    """Texts to words (at blanks) and words to pieces."""

    def __init__(self, pattern: str):
        self.find = regex.compile(pattern).findall
        self.at_blanks = pattern == public_tokenizers.PATTERN

    def words(self, texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
        """Where each text's words begin, and the words; all but the first of a text follow a blank. A text that may
        not be cut is one word."""
        if not self.at_blanks:
            return np.arange(len(texts) + 1), texts
        lists = pc.split_pattern(texts, " ")
        offsets = lists.offsets.to_numpy()
        return offsets - offsets[0], lists.flatten()

    def pieces(self, word: str, led: bool) -> list[str]:
        """The pieces of a word, its blank included."""
        whole = f" {word}" if led else word
        return [whole] if self.at_blanks and _LETTERS(word) else self.find(whole)

    def plain(self, words: pa.Array) -> pa.Array:
        """Which words are letters only, and so one piece."""
        return pc.match_substring_regex(words, _LETTERS_ONLY) if self.at_blanks else pa.array(np.zeros(len(words), bool))

    @staticmethod
    def is_glued(word: str) -> bool:
        """Whether white space follows the blank before a word, so the text may not be cut there."""
        return not word or word[0].isspace()


def texts_of(column: pa.Array) -> pa.Array:
    """Texts, null as empty."""
    return pc.fill_null(column.cast(pa.string()), "")


def _word_batch(words: pa.Array, times: pa.Array) -> pa.RecordBatch:
    return pa.record_batch([words.cast(pa.string()), times.cast(pa.int64())], ["word", "times"])


def word_counts(docs: DataFrame, pattern: str) -> DataFrame:
    """``word, times`` of pieces but long ones, as cut at blanks; counted per slice of rows first."""

    def counted(texts: pa.Array, splitter: Splitter) -> Iterator[pa.RecordBatch]:
        starts, words = splitter.words(texts)
        first = np.zeros(len(words), bool)
        first[starts[:-1]] = True
        others: Counter = Counter()
        for own, led in ((words.filter(pa.array(~first)), True), (words.filter(pa.array(first)), False)):
            found = pc.value_counts(own)
            values, times = found.field(0), found.field(1)
            plain = pc.and_(splitter.plain(values), pc.less(pc.binary_length(values), LONG_BYTES))
            letters = values.filter(plain)
            yield _word_batch(pc.binary_join_element_wise("", letters, " ") if led else letters, times.filter(plain))
            rest = pc.invert(plain)
            for word, n in zip(values.filter(rest).to_pylist(), times.filter(rest).to_pylist()):
                for piece in splitter.pieces(word, led):
                    others[piece] += n
        short = {w: n for w, n in others.items() if len(w) <= LONG_BYTES and len(w.encode()) <= LONG_BYTES}
        yield _word_batch(pa.array(list(short), pa.string()), pa.array(list(short.values()), pa.int64()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter, held, size = Splitter(pattern), [], 0
        for batch in slices(batches):
            held.append(texts_of(batch.column(0)))
            size += held[-1].nbytes
            if size > COUNTED_BYTES:
                yield from counted(pa.concat_arrays(held), splitter)
                held, size = [], 0
                pa.default_memory_pool().release_unused()
        if held:
            yield from counted(pa.concat_arrays(held), splitter)

    return docs.select("text").mapInArrow(run, "word string, times long").groupBy("word").agg(F.sum("times").alias("times"))


def runs(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers ``start, start + 1, ...`` of every run, one run after another."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


class Tokens:
    """The vocabulary as arrays: bytes and decimal numbers of ids."""

    def __init__(self, ranks: dict[bytes, int]):
        tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        self.sizes = np.array(list(map(len, tokens)), np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        numbers = [f"{i} ".encode() for i in range(len(tokens))]
        self.digits = np.array(list(map(len, numbers)), np.int64)
        self.numbers = np.array(numbers, f"S{self.digits.max(initial=1)}").view(np.uint8).reshape(len(tokens), -1)

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all ids, and how many bytes each has: binary pieces, concatenated."""
        sizes = self.sizes[ids]
        return self.bytes[runs(self.starts[ids], sizes)], sizes

    def decimals(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids in decimal digits, a blank behind each, and how many characters each has."""
        padded = self.numbers[ids].ravel()
        return padded[padded > 0], self.digits[ids]


class Dictionary:
    """Encoded words as sorted hashes with their ids, packed."""

    def __init__(self, hashes: np.ndarray, sizes: np.ndarray, ids: np.ndarray):
        order, sizes = np.argsort(hashes), sizes.astype(np.int64)
        starts = np.cumsum(sizes) - sizes
        self.hashes, sizes = hashes[order], sizes[order]
        self.ends = np.cumsum(sizes)
        places = np.repeat(starts[order] - (self.ends - sizes), sizes) + np.arange(sizes.sum())
        self.ids = ids[places]
        self.ends = self.ends.astype(np.int32)

    def places(self, words: list[bytes], tokens: Tokens) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of each word begin in ``ids``, and how many they are; none for a word without entry."""
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
        if not len(self.hashes):
            return np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        starts = np.where(at > 0, self.ends[at - 1], 0).astype(np.int64)
        sizes = np.where(self.hashes[at] == hashes, self.ends[at] - starts, 0)
        decoded, lengths = tokens.decode(self.ids[runs(starts, sizes)])
        of_ids = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], np.cumsum(sizes)])]
        data, found = decoded.tobytes(), np.flatnonzero(sizes).tolist()
        if data != b"".join([words[i] for i in found]) or (np.diff(of_ids)[found] != [len(words[i]) for i in found]).any():
            for i in found:
                if data[of_ids[i] : of_ids[i + 1]] != words[i]:
                    sizes[i] = 0
        return starts, sizes


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        words = batch.column(0).cast(pa.binary()).to_pylist()
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
        sizes = np.diff(batch.column(1).offsets.to_numpy()).astype(np.uint8)
        ids = batch.column(1).flatten().to_numpy().astype(np.int32)
        yield pa.record_batch({n: pa.array([a.tobytes()], pa.binary()) for n, a in (("hashes", hashes), ("sizes", sizes), ("ids", ids))})


def dictionary(docs: DataFrame, pattern: str, table: Column, limit: int) -> Dictionary:
    """The most frequent words with their ids: all words of a count level and above, ``limit`` at most."""
    words = materialise(word_counts(docs, pattern), "words")
    level = F.floor(F.log2("times") * 8).cast("int")
    levels = {r["level"]: r["count"] for r in words.groupBy(level.alias("level")).count().collect()}  # some hundred at most
    least, held = None, 0
    for at in sorted(levels, reverse=True):
        held += levels[at]
        if held > limit:
            break
        least = at
    chosen = words.where(level >= least) if least is not None else words.limit(0)
    encoded = chosen.select("word", fold(F.col("word"), table).alias("ids")).mapInArrow(_pack, "hashes binary, sizes binary, ids binary")
    rows = encoded.toArrow()
    discard(words)
    joined = [np.frombuffer(b"".join(rows.column(n).to_pylist()), t) for n, t in (("hashes", np.uint64), ("sizes", np.uint8), ("ids", np.int32))]
    del rows
    pa.default_memory_pool().release_unused()
    return Dictionary(*joined)


class Encoder:
    """Slices of texts to ids; a rare word has the negative of its place in ``rare``, counted from 1."""

    def __init__(self, known: Dictionary, ranks: dict[bytes, int], pattern: str):
        self.known, self.ranks, self.tokens, self.splitter = known, ranks, Tokens(ranks), Splitter(pattern)

    def _pool(self, pieces: list[list[str]], rare: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of words given as pieces, one after another, and each word's start and size among them."""
        flat = [p.encode() for word in pieces for p in word]
        starts, sizes = self.known.places(flat, self.tokens)
        own = {}
        for i in np.flatnonzero(sizes == 0).tolist():
            if len(flat[i]) > LONG_BYTES:
                own[i] = np.array(merge_long(flat[i], self.ranks), np.int32)
            else:
                rare.append(flat[i].decode())
                own[i] = np.array([-len(rare)], np.int32)
        found = self.known.ids[runs(starts, sizes)] if len(self.known.ids) else np.zeros(0, np.int32)
        filled = sizes.copy()
        for i, ids in own.items():
            filled[i] = len(ids)
        pool = np.empty(filled.sum(), np.int32)
        is_own = np.repeat(sizes == 0, filled)
        pool[~is_own] = found
        if own:
            pool[is_own] = np.concatenate(list(own.values()))
        ends = np.concatenate([[0], np.cumsum(filled)])[np.concatenate([[0], np.cumsum(list(map(len, pieces)), dtype=np.int64)])]
        return pool, ends[:-1], np.diff(ends)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """The ids of all texts, one after another, where each text's begin (and the end), and the rare words."""
        column = texts_of(column)
        starts, words = self.splitter.words(column)
        coded = words.dictionary_encode()
        code = coded.indices.to_numpy().astype(np.int64)
        names, plain = coded.dictionary.to_pylist(), self.splitter.plain(coded.dictionary).to_pylist()
        glued = np.array([not ok and self.splitter.at_blanks and self.splitter.is_glued(w) for w, ok in zip(names, plain)], bool)
        firsts = starts[:-1]
        bare, of_first = np.unique(code[firsts], return_inverse=True)
        follows = np.ones(len(code), bool)
        follows[firsts] = False
        whole = np.add.reduceat((glued[code] & follows).astype(np.int64), firsts) > 0 if len(firsts) else np.zeros(0, bool)
        rare: list[str] = []
        pieces = [[f" {w}"] if ok else self.splitter.pieces(w, True) for w, ok in zip(names, plain)]
        pieces += [self.splitter.pieces(names[i], False) for i in bare]
        at_whole = np.flatnonzero(whole)
        pieces += [self.splitter.find(column[i].as_py()) for i in at_whole]
        pool, begin, size = self._pool(pieces, rare)
        code[firsts] = len(names) + of_first
        # a text that may not be cut is one word in place of its words
        keep = np.ones(len(code), bool)
        for at, i in enumerate(at_whole):
            code[starts[i]] = len(names) + len(bare) + at
            keep[starts[i] + 1 : starts[i + 1]] = False
        sizes = np.where(keep, size[code], 0)
        ids = pool[runs(begin[code], sizes)]
        return ids, np.concatenate([[0], np.cumsum(sizes)])[starts], rare


def packed_rows(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """A binary column from the 32-bit integers of all rows and where each row's begin."""
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer((ends * 4).astype(np.int32)), pa.py_buffer(values.astype(np.int32))])


def unpacked_rows(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All rows' integers and where each row's begin."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1] // 4
    values = np.frombuffer(column.buffers()[2] or b"", np.int32)[offsets[0] : offsets[-1]]
    return values, (offsets - offsets[0]).astype(np.int64)


def _half_encoded(docs: DataFrame, known: Broadcast, ranks: Broadcast, pattern: str) -> DataFrame:
    """Per row ``known``, its packed ids with a negative number for each rare word, and those words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(known.value, ranks.value, pattern)
        for batch in slices(batches, SLICE_ROWS):
            ids, ends, names = encoder.encode(batch.column(1))
            missing = []
            for start, stop in zip(ends[:-1], ends[1:]):
                own = ids[start:stop]
                open_ = np.flatnonzero(own < 0)
                words, which = np.unique(own[open_], return_inverse=True)
                own[open_] = -1 - which
                missing.append([names[-i - 1] for i in words])
            yield pa.record_batch([batch.column(0), packed_rows(ids, ends), pa.array(missing, pa.list_(pa.string()))], ["doc_id", "known", "rare"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, known binary, rare array<string>")


def _filled(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all rows and where each row's begin, the folded rare words put in."""
    ids, ends = unpacked_rows(batch.column(1))
    open_ = np.flatnonzero(ids < 0)
    if not len(open_):
        return ids, ends
    folded = batch.column(2).to_pylist()
    rows = np.searchsorted(ends, open_, "right") - 1
    own = [folded[row][-1 - i] for row, i in zip(rows.tolist(), ids[open_].tolist())]
    sizes = np.ones(len(ids), np.int64)
    sizes[open_] = list(map(len, own))
    out = np.repeat(ids, sizes)
    out[np.repeat(ids < 0, sizes)] = np.concatenate([np.array(x, np.int32) for x in own])
    return out, np.concatenate([[0], np.cumsum(sizes)])[ends]


def _encoded(docs: DataFrame, path: str, pattern: str, words: int) -> tuple[DataFrame, Broadcast, Broadcast]:
    """``doc_id, known, folded`` per row: rare words are folded where they stand; the dictionary and the ranks, apart, since
    who decodes needs no dictionary."""
    ranks = load_ranks(path)
    table = rank_table(ranks)
    session = docs.sparkSession.sparkContext
    known, shared = session.broadcast(dictionary(docs, pattern, table, words)), session.broadcast(ranks)
    half = _half_encoded(docs, known, shared, pattern)
    return half.select("doc_id", "known", F.transform("rare", lambda w: fold(w, table)).alias("folded")), known, shared


def round_trip(docs: DataFrame, path: str, pattern: str, words: int = DICTIONARY_WORDS) -> DataFrame:
    """``doc_id, ids, decoded`` per row of ``docs``."""
    encoded, _, ranks = _encoded(docs, path, pattern, words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens(ranks.value)
        for batch in slices(batches, SLICE_ROWS):
            ids, ends = _filled(batch)
            data, sizes = tokens.decode(ids)
            at = np.concatenate([[0], np.cumsum(sizes)])[ends]
            decoded = [data[a:b].tobytes() for a, b in zip(at[:-1], at[1:])]
            lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids, pa.int32()))
            yield pa.record_batch([batch.column(0), lists, pa.array(decoded, pa.binary())], ["doc_id", "ids", "decoded"])

    return encoded.mapInArrow(run, "doc_id long, ids array<int>, decoded binary")


def encode(docs: DataFrame, path: str, pattern: str, words: int = DICTIONARY_WORDS) -> DataFrame:
    """``doc_id, ids`` per row of ``docs``."""
    return round_trip(docs, path, pattern, words).drop("decoded")


def digests(docs: DataFrame, path: str, pattern: str, words: int = DICTIONARY_WORDS) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` per row of ``docs``, as a written table."""
    encoded, known, ranks = _encoded(docs, path, pattern, words)

    def hashed(data: np.ndarray, sizes: np.ndarray, ends: np.ndarray, drop: int) -> pa.Array:
        """Digests of each row's bytes, without the last ``drop`` ones."""
        at, view = np.concatenate([[0], np.cumsum(sizes)])[ends].tolist(), memoryview(data)
        return pa.array([hashlib.sha256(view[a : max(a, b - drop)]).hexdigest() for a, b in zip(at, at[1:])], pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens(ranks.value)
        for batch in slices(batches, SLICE_ROWS):
            ids, ends = _filled(batch)
            columns = [batch.column(0), pa.array(np.diff(ends)), hashed(*tokens.decimals(ids), ends, 1), hashed(*tokens.decode(ids), ends, 0)]
            yield pa.record_batch(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    out = materialise(encoded.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"), "digests")
    known.destroy()
    ranks.destroy()
    return out
