"""Size measures for element text (how many units a text adds to a chunk)."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Whitespace as a Unicode-aware ``strip`` sees it: the White_Space property plus the four
# ASCII separators that the property leaves out.
BLANK_PATTERN = r"(?U)^[\s\x1c-\x1f]*$"


def blank_sql(text: str) -> str:
    """SQL test for blank text; a visible ASCII character at the start settles it without the pattern."""
    return f"(({text} < '!' OR {text} >= '\\u007f') AND {text} RLIKE r'{BLANK_PATTERN}')"


def chars_div_4_sql(text: str) -> str:
    """SQL for the default measure: 0 for NULL or blank text, else characters div 4.

    Text of under four bytes measures 0 either way, so nothing is counted or matched for it.
    """
    return (
        f"CASE WHEN {text} IS NULL OR octet_length({text}) < 4 OR {blank_sql(text)} "
        f"THEN 0L ELSE length({text}) div 4 END"
    )


def chars_div_4(text: Column) -> Column:
    """Column form of :func:`chars_div_4_sql`."""
    blank = ((text < "!") | (text >= "\x7f")) & text.rlike(BLANK_PATTERN)
    return F.when(text.isNull() | (F.octet_length(text) < 4) | blank, F.lit(0).cast("bigint")).otherwise(
        F.floor(F.length(text) / 4).cast("bigint")
    )


def tokenizer_sizes(load_tokenizer: Callable[[], Callable[[str], int]]) -> Callable[[Column], Column]:
    """Size measure from a real tokenizer, for ``array<string>`` columns.

    ``load_tokenizer`` returns a function text -> token count. It runs once per task and serves all
    batches of that task. Blank text measures 0. The result maps a column of element texts to a
    column of sizes and goes into ``ChunkOptions.measure``.
    """

    def sizes(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        count = load_tokenizer()
        for texts in batches:
            out = [
                None if row is None else [count(t) if t is not None and t.strip() else 0 for t in row]
                for row in texts.to_pylist()
            ]
            yield pa.array(out, pa.list_(pa.int64()))

    return F.arrow_udf(sizes, T.ArrayType(T.LongType()))


# Embedding models with a tokenizer of their own, and that tokenizer's name.
MODEL_TOKENIZERS = {
    "gte-large-en-v1.5": "Alibaba-NLP/gte-large-en-v1.5",
    "bge-large-en-v1.5": "BAAI/bge-large-en-v1.5",
    "bge_large_en_v1_5": "BAAI/bge-large-en-v1.5",
}


def model_sizes(model: str, folder: str) -> Callable[[Column], Column] | None:
    """Size measure for an embedding model; None stands for the default measure.

    The tokenizer file is ``<folder>/<tokenizer name>/tokenizer.json`` on the driver and every executor. A
    model without an entry, or whose file the driver does not have, is measured by characters in the
    whole job; a file that exists but cannot be read is an error, on the driver or in an executor's task,
    so one table never holds two measures.
    """
    if model not in MODEL_TOKENIZERS:
        return None
    path = f"{folder}/{MODEL_TOKENIZERS[model]}/tokenizer.json"

    def load_tokenizer() -> Callable[[str], int]:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        return lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids)

    if not os.path.exists(path):
        return None
    load_tokenizer()
    return tokenizer_sizes(load_tokenizer)
