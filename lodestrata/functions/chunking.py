"""Section-aware, size-bounded chunking of one document's elements as a native fold.

The fold keeps only positions: a chunk is ``first`` and ``n`` into the element array, so merging or
growing a chunk never copies text. Texts are joined once, when the fold is finished. It runs per
row with no shuffle and no Python worker.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.functions.elements import (
    ATOMIC_LIST,
    BREAK_LIST,
    DEFAULT_SECTION,
    render_variant_sql,
    section_label_sql,
)
from lodestrata.functions.sizes import chars_div_4_sql

CHUNK_TYPE = "array<struct<content:string,section:string,chunk_type:string>>"

# A small chunk joins the chunk before it when that one has one of these types.
MERGE_INTO = ("section_based", "size_limited", "final", "small_section", "merged")


@dataclass(frozen=True)
class ChunkOptions:
    """Size limits in units of the measure; ``measure`` maps texts to sizes (default: native)."""

    max_size: int = 4000
    min_size: int = 400
    measure: Callable[[Column], Column] | None = None

    def __post_init__(self) -> None:
        if not 0 <= self.min_size <= self.max_size:
            raise ValueError(f"need 0 <= min_size <= max_size, got {self.min_size}, {self.max_size}")


MIN_BLOCK = 64  # elements per inner fold of a short document

_SPAN = "struct<first:int,n:int,label:int,kind:string>"
_STATE = f"struct<done:array<{_SPAN}>,last:{_SPAN},first:int,n:int,label:int,size:bigint>"


def _close(keep: str, small: str, min_size: int) -> str:
    """``done`` and ``last`` after the running chunk of state ``s`` is closed.

    ``last`` stays outside ``done`` so that a later merge only replaces one small struct.
    """
    types = ", ".join(f"'{t}'" for t in MERGE_INTO)

    def span(kind: str) -> str:
        return f"named_struct('first', s.first, 'n', s.n, 'label', s.label, 'kind', '{kind}')"

    merge = f"s.size < {min_size} AND s.last.kind IN ({types})"
    done = (
        f"IF(s.n = 0 OR s.last IS NULL OR coalesce({merge}, false), s.done, "
        "concat(s.done, array(s.last)))"
    )
    last = (
        f"CASE WHEN s.n = 0 THEN s.last WHEN s.size >= {min_size} THEN {span(keep)} "
        f"WHEN {merge} THEN named_struct('first', s.last.first, 'n', s.last.n + s.n, "
        f"'label', s.last.label, 'kind', 'merged') ELSE {span(small)} END"
    )
    return f"'done', {done}, 'last', {last}"


def fold_sql(elements: str, options: ChunkOptions) -> str:
    """SQL over rendered elements with sizes (``kind, text, size``) -> array of chunk structs.

    Two levels: an inner fold over a block of about sqrt(n) elements, an outer one over the blocks
    that carries the state along. Adding to an array copies it, so a single fold over a document of
    very many elements would copy its long list of spans at every step.
    """
    start = (
        f"CAST(named_struct('done', array(), 'last', NULL, 'first', 0, 'n', 0, 'label', -1, "
        f"'size', 0L) AS {_STATE})"
    )
    at = "s.first + s.n"
    by_section = (
        f"named_struct({_close('section_based', 'small_section', options.min_size)}, "
        f"'first', {at}, 'n', 1, 'label', {at}, 'size', e.size)"
    )
    by_size = (
        f"named_struct({_close('size_limited', 'small_size', options.min_size)}, "
        f"'first', {at}, 'n', 1, 'label', s.label, 'size', e.size)"
    )
    grown = (
        "named_struct('done', s.done, 'last', s.last, 'first', s.first, 'n', s.n + 1, "
        "'label', s.label, 'size', s.size + e.size)"
    )
    step = (
        f"CASE WHEN e.kind IN ({BREAK_LIST}) THEN {by_section} "
        f"WHEN s.size + e.size > {options.max_size} AND s.n > 0 AND e.kind NOT IN ({ATOMIC_LIST}) "
        f"THEN {by_size} ELSE {grown} END"
    )
    rest = ", ".join(f"'{f}', {{0}}.{f}" for f in ("last", "first", "n", "label", "size"))
    opened = f"CAST(named_struct('done', array(), {rest.format('o')}) AS {_STATE})"
    block = "IF(size(x) <= b, x, slice(x, k * b + 1, b))"
    joined = f"named_struct('done', concat(o.done, t.done), {rest.format('t')})"
    outer = f"transform(array(aggregate({block}, {opened}, (s, e) -> {step}, s -> s)), t -> {joined})[0]"
    finish = f"named_struct({_close('final', 'small_final', options.min_size)})"
    folded = (
        f"transform(array(greatest({MIN_BLOCK}, CAST(sqrt(size(x)) AS INT))), b -> "
        f"aggregate(sequence(0, (size(x) - 1) div b), {start}, (o, k) -> {outer}, s -> {finish}))[0]"
    )
    # after the last close every span is in ``done`` or ``last``
    spans = "IF(c.last IS NULL, c.done, concat(c.done, array(c.last)))"
    label = section_label_sql("x[p.label].kind", "x[p.label].text")
    texts = "transform(sequence(p.first, p.first + p.n - 1), i -> x[i].text)"
    chunk = (
        f"named_struct('content', array_join({texts}, '\\n\\n'), "
        f"'section', IF(p.label < 0, '{DEFAULT_SECTION}', {label}), 'chunk_type', p.kind)"
    )
    # transform(array(...))[0] binds a value once instead of repeating its expression
    body = f"transform(transform(array({folded}), c -> {spans})[0], p -> {chunk})"
    checked = (
        f"IF(size(x) = 0 OR exists(x, e -> e.text IS NULL), CAST(array() AS {CHUNK_TYPE}), "
        f"CAST({body} AS {CHUNK_TYPE}))"
    )
    return f"transform(array({elements}), x -> {checked})[0]"


def sized_sql(elements: str) -> str:
    """Rendered elements with the default size measure added."""
    return (
        f"transform({elements}, e -> named_struct('kind', e.kind, 'text', e.text, "
        f"'size', {chars_div_4_sql('e.text')}))"
    )


def with_chunks(df: DataFrame, elements: str, options: ChunkOptions, into: str = "chunks") -> DataFrame:
    """Add the array of chunks of the rendered-element column ``elements``."""
    if options.measure is None:
        return df.withColumn(into, F.expr(fold_sql(sized_sql(elements), options)))
    # a measure of the caller's runs over the texts of a document first, then the fold reads its sizes
    sizes = options.measure(F.transform(elements, lambda e: e["text"]))
    sized = df.withColumn("_sizes", sizes).withColumn(
        "_sized",
        F.expr(f"transform({elements}, (e, i) -> named_struct('kind', e.kind, 'text', e.text, 'size', _sizes[i]))"),
    )
    return sized.withColumn(into, F.expr(fold_sql("_sized", options))).drop("_sizes", "_sized")


def json_chunks(json: str, options: ChunkOptions) -> Column:
    """Chunks of a JSON text column in any container shape; bad input gives an empty array."""
    return F.expr(json_chunks_sql(json, options))


def json_chunks_sql(json: str, options: ChunkOptions) -> str:
    return fold_sql(sized_sql(render_variant_sql(f"try_parse_json({json})")), options)


def register_chunk_function(
    spark: SparkSession, options: ChunkOptions, name: str = "chunk_elements"
) -> None:
    """Make ``name(json)`` callable from SQL as a temporary function with the same native plan."""
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(doc STRING) RETURNS {CHUNK_TYPE} "
        f"RETURN {json_chunks_sql('doc', options)}"
    )


def explode_chunks(df: DataFrame, chunks: str = "chunks") -> DataFrame:
    """One row per chunk with position, columns and content id; a document without chunks gives none.

    The outer generator with a filter behind it gives the rows of the plain one, but keeps the
    optimizer from adding a ``size(chunks) > 0`` filter below, which would run the fold again.
    """
    others = [c for c in df.columns if c != chunks]
    flat = df.select(*others, F.posexplode_outer(chunks).alias("chunk_pos", "_chunk")).filter(
        F.col("chunk_pos").isNotNull()
    )
    return flat.select(
        *others,
        "chunk_pos",
        F.col("_chunk.content").alias("chunk_content"),
        F.col("_chunk.section").alias("chunk_section"),
        F.col("_chunk.chunk_type").alias("chunk_type"),
        F.md5(F.col("_chunk.content").cast("binary")).alias("chunk_id"),
    )


def section_labels(elements: str) -> Column:
    """Per element: label of the nearest heading at or before it, else the default label.

    Works on one document's array: each heading opens a run, and its label is repeated over the
    run. Linear in the number of elements, with no shuffle or sort.
    """
    label = section_label_sql("x[p].kind", "x[p].text")
    starts = f"filter(transform(x, (e, i) -> IF(i = 0 OR e.kind IN ({BREAK_LIST}), i, -1)), i -> i >= 0)"
    runs = (
        f"flatten(transform(starts, (p, i) -> array_repeat(IF(x[p].kind IN ({BREAK_LIST}), {label}, "
        f"'{DEFAULT_SECTION}'), coalesce(get(starts, i + 1), size(x)) - p)))"
    )
    return F.expr(
        f"transform(array({elements}), x -> transform(array({starts}), starts -> {runs})[0])[0]"
    )
