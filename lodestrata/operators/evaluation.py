"""Scoring of answer programs: examples, splits, judge, token F1, means, grid, demonstrations."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodestrata.functions.text import is_blank, tokens
from lodestrata.operators.answers import Predictor, answer
from lodestrata.operators.ordering import best_per_group, hash_positions, seeded_hash

TRAIN_SHARE = 0.7
TEST_MODE_ROWS = 3
DIGITS = 6


def qa_examples(pairs: DataFrame) -> DataFrame:
    """Every question and answer as ``example_id, question, response, messages``.

    The id is ``conversation:turn`` of the question.
    """
    return pairs.select(
        F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("example_id"),
        "question",
        "response",
        F.array(F.struct(F.lit("user").alias("role"), F.col("question").alias("content"))).alias("messages"),
    )


def split_examples(examples: DataFrame, seed: int = 0, share: float = TRAIN_SHARE) -> DataFrame:
    """Add ``position`` in the seeded order and ``split``: train below ``int(total * share)``, else test."""
    placed = hash_positions(examples, "example_id", seed)
    cut = F.floor(F.col("total") * F.lit(share))
    return placed.withColumn("split", F.when(F.col("position") < cut, "train").otherwise("test")).drop("total")


def split_test_mode(examples: DataFrame, seed: int = 0, rows: int = TEST_MODE_ROWS) -> DataFrame:
    """The quick split: the first ``rows`` examples train, the next ``rows`` test, the rest unused.

    Each task keeps its first ``2 * rows`` examples; only that many are ranked.
    """
    order = [seeded_hash("example_id", seed), F.col("example_id")]
    first = examples.orderBy(*order).limit(2 * rows)
    placed = first.withColumn("position", F.row_number().over(W.orderBy(*order)).cast("bigint") - 1)
    return placed.withColumn("split", F.when(F.col("position") < rows, "train").otherwise("test"))


def eval_grid(inputs: DataFrame, programs: Mapping[str, Predictor]) -> DataFrame:
    """Every program on every example: ``program, response`` added to each input row.

    The programs are given by the caller and become one array per row, so nothing is joined.
    """
    made = inputs
    for name, program in programs.items():
        made = answer(made, program, into=f"_made_{name}")
    runs = F.array(*[F.struct(F.lit(n).alias("program"), F.col(f"_made_{n}").alias("response")) for n in programs])
    return made.select(*inputs.columns, F.explode(runs).alias("_run")).select(
        *inputs.columns, "_run.program", "_run.response"
    )


def token_f1(runs: DataFrame, keys: list[str], response: str = "response", expected: str = "expected") -> DataFrame:
    """``keys, precision, recall, f1`` over the bags of tokens of ``response`` and ``expected``.

    Tokens are counted per key and token, partly in the map tasks; the second aggregate adds the
    common counts. Texts of any length spread over tasks.
    """
    def tagged(text: str, a: int, b: int) -> Column:
        return F.transform(
            F.coalesce(tokens(F.col(text)), F.array().cast("array<string>")),
            lambda t: F.struct(t.alias("t"), F.lit(a).alias("a"), F.lit(b).alias("b")),
        )

    bag = F.concat(tagged(response, 1, 0), tagged(expected, 0, 1))
    rows = runs.select(*keys, F.explode_outer(bag).alias("w")).select(*keys, "w.t", "w.a", "w.b")
    counted = rows.groupBy(*keys, "t").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    known = F.col("t").isNotNull()
    sums = counted.groupBy(*keys).agg(
        F.sum(F.when(known, F.least("a", "b")).otherwise(0)).alias("both"),
        F.sum(F.when(known, F.col("a")).otherwise(0)).alias("a"),
        F.sum(F.when(known, F.col("b")).otherwise(0)).alias("b"),
    )
    return sums.select(*keys, *f1_columns(F.col("both"), F.col("a"), F.col("b")))


def f1_columns(both: Column, made: Column, want: Column) -> list[Column]:
    """Precision, recall and F1 from token counts; 0 where a side is empty."""
    zero = F.lit(0.0)
    precision = F.when(made > 0, both / made).otherwise(zero)
    found = F.when(want > 0, both / want).otherwise(zero)
    f1 = F.when(both > 0, 2.0 * both / (made + want)).otherwise(zero)
    return [
        F.round(precision, DIGITS).alias("precision"),
        F.round(found, DIGITS).alias("recall"),
        F.round(f1, DIGITS).alias("f1"),
    ]


def f1_score(precision: Column, recall: Column) -> Column:
    """F1 of a precision and a recall that a caller supplies, such as a model-based metric."""
    total = precision + recall
    return F.round(F.when(total > 0, 2.0 * precision * recall / total).otherwise(F.lit(0.0)), DIGITS)


Judge = Callable[[Column, Column, Column], Column]


def overlap_judge(threshold: float = 0.5) -> Judge:
    """Offline judge: ``yes`` when enough of the expected tokens occur in the response.

    Returns ``struct<value,rationale>``; no verdict where either text is blank.
    """

    def judge(question: Column, response: Column, expected: Column) -> Column:
        want = F.array_distinct(tokens(expected))
        found = F.size(F.array_intersect(want, F.array_distinct(tokens(response))))
        enough = found >= F.size(want) * F.lit(threshold)
        told = F.format_string("%d of %d expected tokens found", found, F.size(want))
        return F.when(
            ~is_blank(response) & ~is_blank(expected),
            F.struct(F.when(enough, "yes").otherwise("no").alias("value"), told.alias("rationale")),
        )

    return judge


def judge_score(runs: DataFrame, judge: Judge, response: str = "response", expected: str = "expected") -> DataFrame:
    """Add ``score`` (1 for a ``yes``; without a verdict 1 for equal texts) and ``feedback``."""
    verdict = runs.withColumn("_v", judge(F.col("question"), F.col(response), F.col(expected)))
    equal = F.coalesce(F.col(response) == F.col(expected), F.lit(False))
    # an empty verdict or rationale counts as none
    value, told = F.nullif(F.col("_v.value"), F.lit("")), F.nullif(F.col("_v.rationale"), F.lit(""))
    score = F.when(value.isNotNull(), value == "yes").otherwise(equal).cast("int")
    return verdict.withColumn("score", score).withColumn("feedback", told).drop("_v")


def mean_scores(scores: DataFrame, keys: list[str], score: str = "score") -> DataFrame:
    """Mean score per run: ``keys, accuracy, n_examples``; summed in the map tasks first."""
    return scores.groupBy(*keys).agg(
        F.round(F.avg(F.col(score).cast("double")), DIGITS).alias("accuracy"), F.count(F.lit(1)).alias("n_examples")
    )


def select_demos(
    scores: DataFrame,
    train: DataFrame,
    programs: list[str],
    threshold: float,
    bootstrapped: int = 2,
    labelled: int = 2,
) -> DataFrame:
    """``program, kind, rank, example_id``: per program the first passing and the first labelled examples.

    ``scores`` holds ``program, example_id, position, score`` of train examples, ``train`` holds
    ``example_id, position``. Order is the seeded position. Each task keeps only the first few.
    """
    passing = best_per_group(
        scores.filter(F.col("score") >= threshold).select("program", "example_id", "position"),
        ["program"],
        [F.asc("position")],
        bootstrapped,
    ).select("program", F.lit("bootstrapped").alias("kind"), "rank", "example_id")
    # positions of the train part start at 0, so the first ones need no sort
    first = train.filter(F.col("position") < labelled).select(
        F.explode(F.array(*[F.lit(p) for p in programs])).alias("program"),
        F.lit("labelled").alias("kind"),
        (F.col("position") + 1).cast("int").alias("rank"),
        "example_id",
    )
    return passing.unionByName(first)
