"""Small text expressions shared by search, rerank and scoring."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestrata.functions.sizes import BLANK_PATTERN

TOKEN_SEPARATOR = r"[^\p{L}\p{N}]+"


def file_name(path: Column) -> Column:
    """Last path segment; ``''`` when the path ends in a slash."""
    return F.regexp_extract(path, "([^/]+)$", 1)


def tokens(text: Column) -> Column:
    """Lower-case runs of letters and digits, in order, with repeats."""
    return F.filter(F.split(F.lower(text), TOKEN_SEPARATOR), lambda t: t != "")


def first_sentence(text: Column) -> Column:
    """Text up to the first ``.``, ``!``, ``?`` or line end, mark included."""
    return F.regexp_extract(text, r"^[^.!?\n]*[.!?]?", 0)


def is_blank(text: Column) -> Column:
    """True for NULL, empty or whitespace-only text."""
    return F.coalesce(text.rlike(BLANK_PATTERN), F.lit(True))
