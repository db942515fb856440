"""Named expectations: count violations beside the rows, or drop them, or fail the job."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Expectation:
    name: str
    predicate: str

    def holds(self) -> Column:
        """The predicate, with NULL counted as a violation."""
        return F.coalesce(F.expr(self.predicate), F.lit(False))


VALID_CONTENT = Expectation("valid_content", "elements IS NOT NULL")
VALID_PATH = Expectation("valid_path", "path IS NOT NULL")
VALID_CHUNK = Expectation("valid_chunk", "chunk_content IS NOT NULL")
VALID_CHUNK_ID = Expectation("valid_chunk_id", "chunk_id IS NOT NULL")


def _counts(rules: list[Expectation]) -> list[Column]:
    return [F.count_if(~r.holds()).alias(r.name) for r in rules] + [F.count(F.lit(1)).alias("rows")]


def expect(
    df: DataFrame, rules: list[Expectation], mode: str = "warn", observation: Observation | str = "expectations"
) -> DataFrame:
    """``warn`` counts violations on the way, ``drop`` also filters them, ``fail`` stops the job.

    ``observation`` is an ``Observation`` for batch jobs; a name works for streams as well, whose
    progress then carries the counts.
    """
    if mode not in ("warn", "drop", "fail"):
        raise ValueError(f"unknown mode {mode!r}")
    out = df.observe(observation, *_counts(rules))
    for rule in rules:
        if mode == "drop":
            out = out.filter(rule.holds())
        elif mode == "fail":
            out = out.filter(
                F.when(rule.holds(), True).otherwise(
                    F.raise_error(F.lit(f"expectation {rule.name} violated: {rule.predicate}")).cast("boolean")
                )
            )
    return out


def expectation_report(df: DataFrame, rules: list[Expectation]) -> DataFrame:
    """One row per rule: ``rule, passed, failed``; one pass, counted in the map tasks."""
    totals = df.agg(*_counts(rules))
    pairs = ", ".join(f"'{r.name}', `{r.name}`" for r in rules)
    return totals.selectExpr("`rows`", f"stack({len(rules)}, {pairs}) AS (rule, failed)").select(
        "rule", (F.col("rows") - F.col("failed")).alias("passed"), "failed"
    )
