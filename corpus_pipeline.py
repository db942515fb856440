"""The corpus pipeline: quality rules, near duplicates, personal data, mixing, tokens.

Each stage takes ``(spark, docs, sf_dir)``, works on all rows that its predecessor left, and returns a
DataFrame that is written as Parquet and read again as the next stage's ``docs``. All stages but the last
return the columns of ``documents``.

1. ``quality``: documents that the base rules or the isolation forest reject go.
2. ``near_duplicates``: of each component of linked documents (five-word shingles, similarity of 0.8 or
   more) the one with the smallest doc_id stays; documents without words stay.
3. ``personal_data``: spans are replaced by their kind, ``n_chars`` follows.
4. ``mixing``: documents are repeated or left out as the target weights ask; the document at the cut of a
   source is cut to the words taken of it.
5. ``tokens``: ``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every document.

Null columns pass through; empty tables give empty results; extra columns are dropped. Rows that repeat a
doc_id are kept or dropped together in stage 2, where one row of equal ones stays.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lodestrata.llm import bpe, jaccard, mixing, pii, quality_rules
from lodestrata.sources.tables import load
from lodestrata.sources.workspace import materialise


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.kept_documents(docs, load(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.distinct_documents(docs, jaccard.Similarity(words=5, share=80, per=100))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redacted_documents(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.digests(docs, vocabulary, public_tokenizers.PATTERN)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mixing", mixed),
    ("tokens", tokens),
]

# SQL can express neither the isolation forest nor the random field; tests compare each stage with plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
