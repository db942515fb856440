import random

import pytest
from pyspark.sql import functions as F

from lodestrata.operators import answers, dialog

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def model_pairs(messages):
    """Neighbours user, assistant, both with text, among the messages before the last one."""
    return [
        (question, reply)
        for (asker, question), (replier, reply) in zip(messages[:-1], messages[1:-1])
        if (asker, replier) == ("user", "assistant") and question and reply
    ]


def conversations(spark, seed=1, n=60):
    rng = random.Random(seed)
    talks = {
        c: [(rng.choice(["user", "assistant", "user", "assistant", "system"]), rng.choice(["", "a", "b", "c d"])) for _ in range(rng.randint(1, 12))]
        for c in range(n)
    }
    rows = [(c, t, role, text) for c, m in talks.items() for t, (role, text) in enumerate(m)]
    return talks, spark.createDataFrame(rows, SCHEMA)


def test_pairs_equal_model(spark):
    talks, df = conversations(spark)
    got = {}
    for r in dialog.history_pairs(df).orderBy("conv_id", "turn").collect():
        got.setdefault(r["conv_id"], []).append((r["question"], r["response"]))
    assert got == {c: p for c, m in talks.items() if (p := model_pairs(m))}


def test_nested_history(spark):
    talks, df = conversations(spark, 2)
    for n in (1, 3):
        got = {r["conv_id"]: [tuple(p) for p in r["history"]] for r in dialog.nested_history(df, n).collect()}
        assert got == {c: model_pairs(m)[-n:] for c, m in talks.items()}
    off = dialog.nested_history(df, 3, enabled=False).collect()
    assert len(off) == len(talks) and all(r["history"] == [] for r in off)


def test_nesting_asks_for_a_bound(spark):
    _, df = conversations(spark, 2)
    for bound in (None, 0, -2):
        with pytest.raises(ValueError, match="history_pairs"):
            dialog.nested_history(df, bound)


def test_pairs_do_not_depend_on_turn_numbers(spark):
    talks, df = conversations(spark, 5)
    gaps = df.withColumn("turn", F.col("turn") * F.col("turn") * 3 + 7)
    got = {}
    for r in dialog.history_pairs(gaps).orderBy("conv_id", "turn").collect():
        got.setdefault(r["conv_id"], []).append((r["question"], r["response"]))
    assert got == {c: p for c, m in talks.items() if (p := model_pairs(m))}


def test_all_pairs_for_no_bound(spark):
    _, df = conversations(spark, 3)
    pairs = dialog.history_pairs(df)
    for bound in (None, 0, -1):
        assert dialog.recent_history(pairs, bound).count() == pairs.count()


def test_pairs_plan_has_no_window_over_a_conversation(spark):
    _, df = conversations(spark)
    plan = dialog.history_pairs(df)._jdf.queryExecution().executedPlan().toString()
    tree = plan[: plan.index("Initial Plan")] if "Initial Plan" in plan else plan
    lines = tree.splitlines()
    windows = [i for i, line in enumerate(lines) if "Window [" in line]
    along = [i for i in windows if "_slice" not in lines[i].rsplit("], [", 2)[-2]]
    assert len(windows) > len(along) > 0
    for i in along:  # only the first and last two rows of each slice reach a window over a conversation
        below = "".join(lines[i : min(j for j in windows if j > i)])
        assert "<= 2) OR isnull(_after" in below
    recent = dialog.recent_history(dialog.history_pairs(df), 2)._jdf.queryExecution().executedPlan().toString()
    assert recent.count("WindowGroupLimit") == 2


@pytest.mark.parametrize("span", [1, 2, 3, 1000])
def test_pairs_do_not_depend_on_slices(spark, monkeypatch, span):
    rows = [(c, t * (c + 1), ("user", "assistant")[(t + c) % 2] if t % 5 else "system", f"{c}.{t}" if t % 7 else "") for c in range(4) for t in range(23)]
    df = spark.createDataFrame([*rows, (None, 1, "user", "x"), (1, None, "user", "y")], "conv_id long, turn long, role string, text string")
    want = []
    for c in range(4):
        own = [r for r in rows if r[0] == c]
        want += [(c, a[1], a[3], b[3]) for a, b, _ in zip(own, own[1:], own[2:]) if a[2] == "user" and b[2] == "assistant" and a[3] and b[3]]
    monkeypatch.setattr(dialog, "TURN_SPAN", span)
    assert sorted(tuple(r) for r in dialog.history_pairs(df).collect()) == sorted(want)


def test_turns_with_gaps(spark, monkeypatch):
    monkeypatch.setattr(dialog, "TURN_SPAN", 5)
    talks, df = conversations(spark, 4)
    gaps = df.withColumn("turn", F.col("turn") * F.col("turn") * 3 + 7)
    fixed = dialog.dense_turns(gaps)
    assert fixed.columns == gaps.columns and fixed.exceptAll(df).count() == 0 and fixed.count() == df.count()


def test_four_question_history(spark):
    rows = []
    for i in range(3):
        rows += [(1, 2 * i, "user", f"q{i}"), (1, 2 * i + 1, "assistant", f"a{i}")]
    rows.append((1, 6, "user", "q3"))
    df = spark.createDataFrame(rows, SCHEMA)
    assert [tuple(p) for p in dialog.nested_history(df, 9).first()["history"]] == [("q0", "a0"), ("q1", "a1"), ("q2", "a2")]
    assert dialog.current_question(df).first()["question"] == "q3"


def test_request_checks(spark):
    df = spark.createDataFrame([(1, 0, "user", ""), (2, 0, "user", "   "), (3, 0, "user", "x"), (3, 1, "assistant", "hi")], SCHEMA)
    requests = spark.createDataFrame([(i,) for i in range(4)], "conv_id bigint")
    got = {r["conv_id"]: (r["n_messages"], r["status"], r["reply"]) for r in dialog.validate_requests(requests, df).collect()}
    assert got == {
        0: (0, "no_messages", "Messages list cannot be empty"),
        1: (1, "empty", "I received an empty message. Could you please rephrase your question?"),
        2: (1, "empty", "I received an empty message. Could you please rephrase your question?"),
        3: (2, "ok", None),
    }


def test_plain_questions(spark):
    df = spark.createDataFrame([(7, "why")], "k bigint, t string")
    one = dialog.as_conversations(df, "k", "t")
    assert dialog.current_question(one).first()["question"] == "why"
    assert dialog.nested_history(one, 2).first()["history"] == []


def test_answers_and_fallback(spark):
    hits = spark.createDataFrame([(1, 2, "Second."), (1, 1, "First. More"), (3, 1, " \n ")], "conv_id bigint, rank int, chunk_content string")
    asked = spark.createDataFrame([(1, "q"), (2, "r"), (3, "s")], "conv_id bigint, question string")
    none = spark.createDataFrame([], "conv_id bigint, history string")
    inputs = answers.prompt_inputs(asked, answers.assemble_context(hits, "conv_id"), none)

    def made(program):
        return {r["conv_id"]: r["response"] for r in answers.answer(inputs, program).collect()}

    fixed = answers.NOT_ENOUGH_INFO
    assert made(answers.top_passage) == {1: "First. More", 2: fixed, 3: fixed}
    assert made(answers.leading_sentence) == {1: "First.", 2: fixed, 3: fixed}
    assert made(answers.all_passages) == {1: "First. More\n\nSecond.", 2: fixed, 3: fixed}
    slot = answers.batch_predictor(lambda passages, question, history: f"{question}:{len(passages)}:{history}")
    assert made(slot) == {1: "q:2:", 2: fixed, 3: "s:1:"}
    assert {r["conv_id"]: r["c"] for r in inputs.select("conv_id", answers.context_text(F.col("passages")).alias("c")).collect()}[2] == ""


def test_coerce_response(spark):
    raw = ['{"response": "a"}', '"b"', "plain c", '{"other": 1}', '{"response": null}', ""]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(raw)], "id int, r string")
    got = [r["x"] for r in df.select("id", answers.coerce_response(F.col("r")).alias("x")).orderBy("id").collect()]
    assert got[:4] == ["a", "b", "plain c", '{"other":1}'] and got[5] == ""
