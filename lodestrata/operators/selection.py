"""Comparison and promotion of runs: gains, leaderboard, champion gate, registry, run metrics.

Inputs here are one row per run, already averaged, so they are as small as the number of programs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodestrata.operators.evaluation import DIGITS


def _accuracy_of(program: str) -> Column:
    return F.max(F.when(F.col("program") == program, F.col("accuracy")))


def baseline_gain(means: DataFrame, program: str, small: str, large: str, by: list[str]) -> DataFrame:
    """Accuracy of ``program`` and of two baselines, and the gain over each."""
    wide = means.groupBy(*by).agg(
        _accuracy_of(program).alias("accuracy"),
        _accuracy_of(small).alias("baseline_small_accuracy"),
        _accuracy_of(large).alias("baseline_large_accuracy"),
    )
    return wide.withColumn(
        "improvement_over_small", F.round(F.col("accuracy") - F.col("baseline_small_accuracy"), DIGITS)
    ).withColumn("improvement_over_large", F.round(F.col("accuracy") - F.col("baseline_large_accuracy"), DIGITS))


def leaderboard(runs: DataFrame, by: list[str]) -> DataFrame:
    """Runs ranked by accuracy, the earlier ``position`` first on a tie, with winner and runner-up gain.

    ``runner_up_accuracy`` is the next run's accuracy, 0.0 for the last one.
    """
    order = W.partitionBy(*by).orderBy(F.desc("accuracy"), F.asc("position"))
    return (
        runs.withColumn("rank", F.row_number().over(order))
        .withColumn("runner_up_accuracy", F.lead("accuracy", 1, 0.0).over(order))
        .withColumn("is_winner", F.col("rank") == 1)
        .withColumn("gain", F.round(F.col("accuracy") - F.col("runner_up_accuracy"), DIGITS))
    )


def leaderboard_summary(runs: DataFrame, by: list[str]) -> DataFrame:
    """Per comparison: winner, best and runner-up accuracy, names and run ids joined by comma."""
    listed = F.array_sort(F.collect_list(F.struct("position", "metric_name", "run_id", "program")))
    board = leaderboard(runs, by)
    best = F.when(F.col("is_winner"), F.col("accuracy"))
    return (
        board.groupBy(*by)
        .agg(
            listed.alias("l"),
            F.max(F.when(F.col("is_winner"), F.col("program"))).alias("winner"),
            F.max(F.when(F.col("is_winner"), F.col("run_id"))).alias("best_run_id"),
            F.max(best).alias("best_accuracy"),
            F.max(F.when(F.col("is_winner"), F.col("runner_up_accuracy"))).alias("runner_up_accuracy"),
            F.count(F.lit(1)).alias("num_models_compared"),
        )
        .select(
            *by,
            "winner",
            "best_run_id",
            "best_accuracy",
            "runner_up_accuracy",
            F.round(F.col("best_accuracy") - F.col("runner_up_accuracy"), DIGITS).alias("accuracy_improvement"),
            "num_models_compared",
            F.array_join(F.transform("l", lambda r: r["metric_name"]), ",").alias("metrics_compared"),
            F.array_join(F.transform("l", lambda r: r["run_id"]), ",").alias("all_run_ids"),
        )
    )


def champion_challenger(means: DataFrame, champion: str, challenger: str, by: list[str]) -> DataFrame:
    """Both accuracies and the winner; the challenger wins only if strictly better."""
    wide = means.groupBy(*by).agg(
        _accuracy_of(champion).alias("champion_accuracy"), _accuracy_of(challenger).alias("challenger_accuracy")
    )
    better = F.col("challenger_accuracy") > F.col("champion_accuracy")
    return wide.withColumn("winner", F.when(better, "challenger").otherwise("champion"))


def version_by_alias(registry: DataFrame, wanted: DataFrame) -> DataFrame:
    """``model, alias`` -> ``version`` through the registry ``model, alias, version``."""
    return wanted.join(registry, ["model", "alias"]).select("model", "alias", "version")


def upsert_aliases(registry: DataFrame, changes: DataFrame) -> DataFrame:
    """The registry with ``changes`` put in place of rows of the same model and alias."""
    keys = ["model", "alias"]
    kept = registry.join(changes.select(*keys), keys, "left_anti")
    return kept.select(*keys, "version").unionByName(changes.select(*keys, "version"))


def promote(registry: DataFrame, gate: DataFrame) -> DataFrame:
    """Move alias ``champion`` to the challenger's version for each model whose challenger won."""
    won = gate.filter("winner = 'challenger'").select("model", F.lit("challenger").alias("alias"))
    moved = version_by_alias(registry, won).withColumn("alias", F.lit("champion"))
    return upsert_aliases(registry, moved)


REGISTRY = "model string, alias string, version int"
VERSIONS = "model string, version int, run_id string"
TAGS = "model string, version int, key string, value string"


def new_versions(versions: DataFrame, best: DataFrame) -> DataFrame:
    """``model, version, run_id``: the next version of each model for its run in ``best`` (``model, run_id``)."""
    latest = versions.groupBy("model").agg(F.max("version").alias("_v"))
    return best.join(latest, "model", "left").select("model", (F.coalesce("_v", F.lit(0)) + 1).cast("int").alias("version"), "run_id")


def version_tags(versions: DataFrame, tags: dict[str, Column]) -> DataFrame:
    """``model, version, key, value``: a row per tag of each version."""
    entries = F.array(*[F.struct(F.lit(k).alias("key"), v.cast("string").alias("value")) for k, v in tags.items()])
    return versions.select("model", "version", F.explode(entries).alias("e")).select("model", "version", "e.key", "e.value")


def register_best(registry: DataFrame, best: DataFrame, alias: str = "challenger") -> DataFrame:
    """Give each model's best run the next version and point ``alias`` at it.

    ``best`` is ``model, run_id``; the result is the new registry.
    """
    latest = registry.groupBy("model").agg(F.max("version").alias("_v"))
    fresh = best.join(latest, "model", "left").select(
        "model", F.lit(alias).alias("alias"), (F.coalesce("_v", F.lit(0)) + 1).cast("int").alias("version")
    )
    return upsert_aliases(registry, fresh)


def run_metrics(means: DataFrame, run_id: Column, metrics: list[str], params: list[str], tags: list[str]) -> DataFrame:
    """Long form ``run_id, kind, key, value`` of the metrics, parameters and tags of each run."""
    kinds = [("metric", c) for c in metrics] + [("param", c) for c in params] + [("tag", c) for c in tags]
    entries = F.array(
        *[
            F.struct(F.lit(kind).alias("kind"), F.lit(c).alias("key"), F.col(c).cast("string").alias("value"))
            for kind, c in kinds
        ]
    )
    return means.select(run_id.alias("run_id"), F.explode(entries).alias("e")).select(
        "run_id", "e.kind", "e.key", "e.value"
    )
