import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lodestrata.functions.text import tokens
from lodestrata.operators import evaluation, ordering, selection


def seeded(keys, seed=0):
    return sorted(keys, key=lambda k: hashlib.md5(f"{seed}:{k}".encode()).hexdigest())


@pytest.mark.parametrize("seed", [0, 7])
def test_positions_equal_a_global_sort(spark, seed):
    keys = list(range(300))
    df = spark.createDataFrame([(k,) for k in keys], "example_id bigint")
    rows = ordering.hash_positions(df, "example_id", seed).orderBy("position").collect()
    assert [r["example_id"] for r in rows] == seeded(keys, seed)
    assert [r["position"] for r in rows] == keys and {r["total"] for r in rows} == {300}


def test_split_41(spark):
    df = spark.createDataFrame([(k,) for k in range(41)], "example_id bigint")
    parts = Counter(r["split"] for r in evaluation.split_examples(df).collect())
    assert parts == {"train": 28, "test": 13}
    quick = {r["example_id"]: r["split"] for r in evaluation.split_test_mode(df).collect()}
    order = seeded(range(41))
    assert quick == {k: "train" if i < 3 else "test" for i, k in enumerate(order[:6])}


def test_examples(spark):
    pairs = spark.createDataFrame([(1, 4, "q2", "r2"), (1, 0, "q1", "r1"), (2, 2, "x", "y")], "conv_id int, turn int, question string, response string")
    rows = evaluation.qa_examples(pairs).orderBy("example_id").collect()
    assert [(r["example_id"], r["question"], r["response"]) for r in rows] == [("1:0", "q1", "r1"), ("1:4", "q2", "r2"), ("2:2", "x", "y")]
    assert [tuple(m) for m in rows[0]["messages"]] == [("user", "q1")]


def test_token_f1(spark):
    cases = [("a b b c", "b b d"), ("", "x"), ("x", ""), ("", ""), ("Same TEXT", "same text"), ("a", None)]
    df = spark.createDataFrame([(i, r, e) for i, (r, e) in enumerate(cases)], "id int, response string, expected string")
    got = {r["id"]: (r["precision"], r["recall"], r["f1"]) for r in evaluation.token_f1(df, ["id"]).collect()}
    for i, (made, want) in enumerate(cases):
        a, b = Counter((made or "").lower().split()), Counter((want or "").lower().split())
        n = sum((a & b).values())
        p, r = n / max(1, sum(a.values())), n / max(1, sum(b.values()))
        assert got[i] == (round(p, 6), round(r, 6), round(2 * p * r / (p + r), 6) if n else 0.0)


def test_supplied_precision_and_recall(spark):
    df = spark.createDataFrame([(0.5, 1.0), (0.0, 0.0)], "p double, r double")
    assert [r["f"] for r in df.select(evaluation.f1_score(F.col("p"), F.col("r")).alias("f")).collect()] == [0.666667, 0.0]


def test_judge(spark):
    df = spark.createDataFrame(
        [(1, "q", "a b c d", "a b"), (2, "q", "x", "a b"), (3, "q", "", ""), (4, "q", " ", "a"), (5, "q", None, "a")],
        "id int, question string, response string, expected string",
    )
    got = {r["id"]: (r["score"], r["feedback"]) for r in evaluation.judge_score(df, evaluation.overlap_judge(0.5)).collect()}
    assert got == {1: (1, "2 of 2 expected tokens found"), 2: (0, "0 of 2 expected tokens found"), 3: (1, None), 4: (0, None), 5: (0, None)}

    def silent(question, response, expected):
        return F.struct(F.lit("").alias("value"), F.lit(None).cast("string").alias("rationale"))

    assert {r["id"]: (r["score"], r["feedback"]) for r in evaluation.judge_score(df, silent).collect()}[1] == (0, None)


def test_demos(spark):
    scores = spark.createDataFrame([("a", 5, 3, 1.0), ("a", 6, 1, 1.0), ("a", 7, 2, 1.0), ("b", 5, 3, 0.0)], "program string, example_id int, position int, score double")
    train = spark.createDataFrame([(9, 0), (6, 1), (7, 2), (5, 3)], "example_id int, position int")
    got = {tuple(r) for r in evaluation.select_demos(scores, train, ["a", "b"], 1.0).collect()}
    assert got == {
        ("a", "bootstrapped", 1, 6), ("a", "bootstrapped", 2, 7),
        ("a", "labelled", 1, 9), ("a", "labelled", 2, 6), ("b", "labelled", 1, 9), ("b", "labelled", 2, 6),
    }


RUNS = [("g", "p1", 0.5, 1, "r1", "m1"), ("g", "p2", 0.9, 2, "r2", "m2"), ("g", "p3", 0.9, 3, "r3", "m3"), ("h", "p1", 0.2, 1, "r4", "m1")]
RUN_SCHEMA = "grp string, program string, accuracy double, position int, run_id string, metric_name string"


def test_leaderboard(spark):
    board = selection.leaderboard(spark.createDataFrame(RUNS, RUN_SCHEMA), ["grp"]).orderBy("grp", "rank").collect()
    assert [(r["grp"], r["program"], r["rank"], r["runner_up_accuracy"], r["is_winner"], r["gain"]) for r in board] == [
        ("g", "p2", 1, 0.9, True, 0.0),
        ("g", "p3", 2, 0.5, False, 0.4),
        ("g", "p1", 3, 0.0, False, 0.5),
        ("h", "p1", 1, 0.0, True, 0.2),
    ]
    summary = selection.leaderboard_summary(spark.createDataFrame(RUNS, RUN_SCHEMA), ["grp"]).orderBy("grp").first()
    assert (summary["winner"], summary["metrics_compared"], summary["all_run_ids"]) == ("p2", "m1,m2,m3", "r1,r2,r3")


def test_gate_is_strict_and_promotes(spark, tmp_path):
    from lodestrata.sources.tables import read_state, write_state

    means = spark.createDataFrame(
        [("m1", "old", 0.5), ("m1", "new", 0.6), ("m2", "old", 0.5), ("m2", "new", 0.5)], "model string, program string, accuracy double"
    )
    gate = selection.champion_challenger(means, "old", "new", ["model"])
    assert {r["model"]: r["winner"] for r in gate.collect()} == {"m1": "challenger", "m2": "champion"}
    registry = spark.createDataFrame(
        [(m, a, v) for m in ("m1", "m2") for a, v in (("champion", 3), ("challenger", 4))], "model string, alias string, version int"
    )
    root = str(tmp_path / "registry")
    write_state(registry, root)
    write_state(selection.promote(read_state(spark, root), gate), root)
    after = {(r["model"], r["alias"]): r["version"] for r in read_state(spark, root).collect()}
    assert after == {("m1", "champion"): 4, ("m1", "challenger"): 4, ("m2", "champion"): 3, ("m2", "challenger"): 4}
    best = spark.createDataFrame([("m1", "r"), ("m9", "s")], "model string, run_id string")
    fresh = {(r["model"], r["alias"]): r["version"] for r in selection.register_best(registry, best).collect()}
    assert fresh[("m1", "challenger")] == 5 and fresh[("m9", "challenger")] == 1 and fresh[("m2", "champion")] == 3


def test_gains_and_metrics(spark):
    means = spark.createDataFrame([("j", "s", 0.1), ("j", "l", 0.3), ("j", "x", 0.6)], "metric string, program string, accuracy double")
    row = selection.baseline_gain(means, "x", "s", "l", ["metric"]).first()
    assert (row["improvement_over_small"], row["improvement_over_large"]) == (0.5, 0.3)
    long = selection.run_metrics(means, F.col("program"), ["accuracy"], ["metric"], [])
    assert {tuple(r) for r in long.filter("run_id = 's'").collect()} == {("s", "metric", "accuracy", "0.1"), ("s", "param", "metric", "j")}


def test_first_per_group_limits_before_the_shuffle(spark):
    df = spark.range(1000).select(F.when(F.col("id") > 3, "hot").otherwise("cold").alias("g"), F.col("id"))
    plan = ordering.best_per_group(df, ["g"], [F.asc("id")], 2)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_tokens(spark):
    row = spark.createDataFrame([("Éa-b_c  9x!",)], "t string").select(tokens(F.col("t")).alias("x")).first()
    assert row["x"] == ["éa", "b", "c", "9x"]
