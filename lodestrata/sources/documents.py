"""Document parsers: raw content -> typed elements, as native expressions or a supplied function.

A parser is ``DataFrame -> DataFrame`` and adds the column ``elements`` of type
``array<struct<type,content,description>>``, or, when it has JSON output already, the text column
``parsed``. The text and HTML parsers stay inside the JVM. Other formats come in as a batch function
through :func:`batch_parser`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestrata.functions.elements import ELEMENT_FIELDS

Parser = Callable[[DataFrame], DataFrame]

# Line rules of the text parser, tag and entity tables of the HTML parser.
TITLE_MAX_CHARS = 200
HEADER_MAX_CHARS = 60
CELL_MARK = " | "
BLOCK_TAGS = "h1|h2|h3|h4|h5|h6|p|li|table|figure|nav|footer|div|script|style"
KEPT_TAGS = "h1|h2|h3|h4|h5|h6|p|li|div|table|figure"
DROPPED_TAGS = ("nav", "footer", "script", "style")
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))
BLOCK_MARK = "\u0001"


def line_type(line: Column, position: Column) -> Column:
    """Element type of one line of plain text."""
    mark = F.lit(CELL_MARK)
    after = F.position(mark, line) + len(CELL_MARK)
    cells = line.contains(CELL_MARK) & (F.position(mark, line, after) > 0)
    heading = line.startswith("#") & line.rlike("^#{1,6} ")
    return (
        F.when(cells, "table")
        .when((position == 0) & _at_most(line, TITLE_MAX_CHARS), "title")
        .when(heading | _at_most(line, HEADER_MAX_CHARS), "section_header")
        .otherwise("text")
    )


def _at_most(text: Column, chars: int) -> Column:
    """Length check that counts characters only where the number of bytes leaves it open."""
    size = F.octet_length(text)
    return (size <= chars) | ((size <= 4 * chars) & (F.length(text) <= chars))


def text_elements(text: Column) -> Column:
    """Plain text -> one element per line."""
    return F.transform(
        F.split(text, "\n"),
        lambda line, i: F.struct(
            line_type(line, i).alias("type"),
            line.alias("content"),
            F.lit(None).cast("string").alias("description"),
        ),
    )


def html_elements(html: Column) -> Column:
    """HTML -> headings, paragraphs, list items, tables, figures and text of ``div`` in page order.

    Navigation, footers, scripts and styles go first, with all they hold. The rest is cut in front
    of every block tag, so unclosed tags do no harm; blocks of other tags are dropped, inner tags are
    stripped and blank results are left out.
    """
    clean = F.regexp_replace(html, "(?s)<!--.*?-->", "")
    for dropped in DROPPED_TAGS:
        clean = F.regexp_replace(clean, f"(?is)<{dropped}[ \\t\\r\\n>].*?</{dropped}[ \\t\\r\\n]*>", " ")
    marked = F.regexp_replace(clean, f"(?i)<({BLOCK_TAGS})([ \\t\\r\\n>])", f"{BLOCK_MARK}<$1$2")
    pieces = F.filter(
        F.split(marked, BLOCK_MARK), lambda b: b.rlike(f"(?i)^<({KEPT_TAGS})[ \\t\\r\\n>]")
    )

    def element(block: Column) -> Column:
        tag = F.lower(F.regexp_extract(block, "^<([a-zA-Z0-9]+)", 1))
        plain = F.regexp_replace(block, "<[^>]*>", " ")
        for entity, char in ENTITIES:
            plain = F.replace(plain, F.lit(entity), F.lit(char))
        plain = F.trim(F.regexp_replace(plain, "[ \\t\\r\\n]+", " "))
        kind = (
            F.when(tag == "h1", "title")
            .when(tag.startswith("h"), "section_header")
            .when(tag.isin("p", "li", "div"), "text")
            .otherwise(tag)
        )
        return F.struct(
            kind.alias("type"), plain.alias("content"), F.lit(None).cast("string").alias("description")
        )

    return F.filter(F.transform(pieces, element), lambda e: e["content"] != "")


def text_parser(df: DataFrame) -> DataFrame:
    return df.withColumn("elements", text_elements(F.col("content").cast("string")))


def html_parser(df: DataFrame) -> DataFrame:
    return df.withColumn("elements", html_elements(F.col("content").cast("string")))


def json_parser(df: DataFrame) -> DataFrame:
    """For content that is parser output already: ``{"document": {"elements": ...}, ...}``."""
    return df.withColumn("parsed", F.col("content").cast("string"))


def batch_parser(
    parse: Callable[[bytes, dict[str, str]], list[dict]], options: dict[str, str] | None = None
) -> Parser:
    """Parser from a function (content bytes, options) -> list of element dicts, run per Arrow batch."""
    settings = dict(options or {})

    def parser(df: DataFrame) -> DataFrame:
        elements = T.ArrayType(T.StructType([T.StructField(f, T.StringType()) for f in ELEMENT_FIELDS]))
        schema = T.StructType([*df.schema.fields, T.StructField("elements", elements)])
        arrow_type = pa.list_(
            pa.struct([(f, pa.string()) for f in ELEMENT_FIELDS])
        )

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                parsed = [
                    None if c is None else parse(c, settings)
                    for c in batch.column("content").to_pylist()
                ]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(parsed, arrow_type)], [*batch.schema.names, "elements"]
                )

        return df.mapInArrow(run, schema)

    return parser


def parse_documents(df: DataFrame, parser: Parser) -> DataFrame:
    """Add parser output as JSON text: ``{"document": {"elements": [...]}, "error_status", "metadata"}``.

    ``content`` is dropped here; it is the widest column and nothing later reads it.
    """
    parsed = parser(df)
    if "parsed" in parsed.columns:
        return parsed.drop("content")
    out = F.to_json(
        F.struct(
            F.struct(F.col("elements")).alias("document"),
            F.when(F.col("elements").isNull(), "no elements").alias("error_status"),
            F.struct(F.size("elements").cast("string").alias("n_elements")).alias("metadata"),
        )
    )
    return parsed.withColumn("parsed", out).drop("content", "elements")
